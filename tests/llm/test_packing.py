from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from words_alike import ALIKE

from trailperks.llm import encoding, packing

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def reference_ids(text):
    tokenizer = Tokenizer.from_file(PATH)
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check(docs, pieces, capacity=2048):
    """Every id of every row lies in one piece; sequences are gapless, within capacity and nearly without padding."""
    expected = {row.doc_id: reference_ids(row.text) for row in docs.collect()}
    found, sequences = {}, {}
    for row in pieces.collect():
        ids = np.frombuffer(row.ids, "<u4").tolist()
        assert len(ids) == row.length and row.doc_tokens == len(expected[row.doc_id])
        found.setdefault(row.doc_id, {})[row.start] = ids
        sequences.setdefault(row.sequence_id, {})[row.offset] = row.length
    assert found.keys() == expected.keys()
    for doc, parts in found.items():
        assert sum((parts[start] for start in sorted(parts)), []) == expected[doc]
        assert sorted(parts) == [sum(len(parts[y]) for y in parts if y < x) for x in sorted(parts)]
    padding = 0
    for parts in sequences.values():
        assert sorted(parts) == [sum(parts[y] for y in parts if y < x) for x in sorted(parts)]
        used = sum(parts.values())
        assert 0 < used <= capacity
        padding += 0 if used & (used - 1) == 0 else capacity - used
    assert padding == 0


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    check(docs, packing.pack(docs, PATH, end_id=1))


def test_hard_texts(documents):
    texts = [
        None, "", " ", "  ", "a", "a  b", " a", "a ", "a \n b", "a\n\nb c", "don't I'm x  y", "<|endoftext|> x <|endoftext|>",
        "a <|endoftext|> b", "a<|endoftext|>b", "<|endoftext|>", "<|endoftext| >", *ALIKE,
        "你好 \U0001f600 é", "1 22 333  4444", "tab\there \t there", "x" * 30000, "the word " * 5000, "the word " * 5000,
    ]
    docs = documents([(n, text) for n, text in enumerate(texts)])
    check(docs, packing.pack(docs.withColumn("length", F.lit("clash")).withColumn("ids", F.lit(1)), PATH, end_id=1))


def test_null_and_repeated_ids_and_empty_table(spark, documents):
    docs = documents([(None, "one two"), (3, "same"), (3, "same"), (None, None)])
    rows = packing.pack(docs, PATH, end_id=1).collect()
    assert sorted(str(r.doc_id) for r in rows if r.start == 0) == ["3", "3", "None", "None"]
    assert packing.pack(docs.where("false"), PATH, end_id=1).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_group(seed):
    random = np.random.default_rng(seed)
    lengths = random.integers(1, 5000, random.integers(1, 200)).tolist()
    sequences = packing.pack_group(lengths, 2048)
    covered = sorted(piece for sequence in sequences for piece in sequence)
    for document, length in enumerate(lengths):
        at = 0
        for _, start, size in (piece for piece in covered if piece[0] == document):
            assert start == at and size > 0
            at += size
        assert at == length
    sizes = [sum(piece[2] for piece in sequence) for sequence in sequences]
    assert all(size == 2048 or size & (size - 1) == 0 for size in sizes)


def test_first_fit_decreasing_against_plain_search():
    random = np.random.default_rng(1)
    pieces = [(n, 0, int(size)) for n, size in enumerate(sorted(random.integers(1, 100, 300), reverse=True))]
    bins, free = [], []
    for piece in pieces:
        at = next((n for n, room in enumerate(free) if room >= piece[2]), len(free))
        if at == len(free):
            bins.append([])
            free.append(100)
        bins[at].append(piece)
        free[at] -= piece[2]
    assert packing.first_fit_decreasing(pieces, 100) == bins


@pytest.mark.parametrize("limit", [2, 6, 10**6])
def test_remembered_words(monkeypatch, limit):
    monkeypatch.setattr(encoding, "CACHED_WORDS", limit)
    encode = packing.encoder.__wrapped__(PATH, 1).encode
    odd = ["a\n", "\na", "a \nb", "a\n\nb", "a\u00a0 b", "x\ty z", "\x85 a"]
    for texts in [["one two three four", "four five six"], ["one two"], ["", " ", "six\nseven eight.\nNine ten"], odd] * 3:
        assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == [reference_ids(t) for t in texts]


def test_digest_matches_crc(spark):
    ids = np.array([1, 2, 3], "<u4").tobytes()
    assert spark.createDataFrame([(bytearray(ids),)], "ids binary").select(F.crc32("ids")).first()[0] == zlib.crc32(ids)
