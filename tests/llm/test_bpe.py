from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from words_alike import ALIKE

from trailperks.llm import bpe
from trailperks.llm.queries import op7

SMALL = "/root/testdata/sf0.001"
PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
ORACLE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.ranks_of(PATH), special_tokens={})


def digest(data):
    return hashlib.sha256(data).hexdigest()


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in op7(spark, SMALL).collect()}
    assert rows.keys() == texts.keys()
    for doc, text in texts.items():
        ids = ORACLE.encode_ordinary(text)
        row = rows[doc]
        assert (row.n_tokens, row.ids_sha256) == (len(ids), digest(np.array(ids, "<u4").tobytes()))
        assert row.decoded_sha256 == digest(text.encode())


HARD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "a\n\nb c", "tab\there \t there", "don't I'm we'll 'tis x's", "1 22 333  4444",
    "你好世界 \U0001f600\U0001f600 é ñ", "<|endoftext|> x <|endoftext|>", "x" * 3000, "ab" * 700 + " end", "the word " * 20000, "!?" * 500,
    "  a b", "a\x1cb \x1d c", "\x85 x y", "　　 z", "Ünïcödé " * 50, "a\r\nb\r\n", "﻿bom", "٣٤٥ १२३",
    *ALIKE,
]


def test_hard_texts(documents):
    docs = documents([(n, t) for n, t in enumerate(HARD)] + [(None, "no id"), (3, "twice"), (3, "twice")])
    docs = docs.withColumn("bucket", F.lit("clash")).withColumn("ids", F.lit(1)).withColumn("row", F.lit(2))
    decoded = bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH).collect()
    assert len(decoded) == len(HARD) + 3
    for r in decoded:
        text = r["row"]["row"]["text"] or ""
        assert np.frombuffer(r["row"]["ids"], "<u4").tolist() == ORACLE.encode_ordinary(text), text[:40]
        assert r["decoded"] == text.encode()


def test_buckets_move_squeezed_and_come_back_whole(documents, monkeypatch):
    """Many small buckets of each task, the first one's among them; what moves is a squeezed bucket, no text as it is."""
    monkeypatch.setattr(bpe, "BUCKET_BYTES", 400)
    monkeypatch.setattr(bpe, "SLICE_BYTES", 100)
    texts = [*HARD, *(f"{n} some more words, and  odd spaces\n {n * n}" for n in range(40)), *HARD]
    encoded = bpe.encode(documents(list(enumerate(texts))).coalesce(2), PATH, PATTERN)
    rows = encoded.select("row.doc_id", "row.text", "ids").collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    for r in rows:
        assert r.text == texts[r.doc_id]
        assert np.frombuffer(r.ids, "<u4").tolist() == ORACLE.encode_ordinary(r.text or "")
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "MapInArrow pack(" in plan and "hashpartitioning(bucket" in plan


def test_units_of_a_bucket():
    texts = ["a b a", "", "b\nb c", "two  blanks a", " a", "a b a"]
    units = bpe.Units(texts, bpe.regex.compile(PATTERN))
    words = units.words()
    assert units.hashes.tolist() == sorted(units.hashes.tolist()) and len(words) == len(units.hashes)
    found = iter([words[n].decode() for n in units.places.tolist()])
    assert ["".join(next(found) for _ in range(count)) for count in units.counts.tolist()] == texts


def test_no_rows(documents):
    empty = documents([(1, "a")]).where("false")
    assert bpe.decode(bpe.encode(empty, PATH, PATTERN), PATH).count() == 0


def test_fold_against_plain_merging(spark):
    """The fold and the heap give what merging the best pair of a list, again and again, gives."""
    ranks, pick = bpe.ranks_of(PATH), random.Random(5)

    def plain(word):
        if word in ranks:
            return [ranks[word]]
        pieces = [word[n : n + 1] for n in range(len(word))]
        while True:
            found = [(ranks.get(a + b, 10**9), n) for n, (a, b) in enumerate(zip(pieces, pieces[1:]))]
            if not found or min(found)[0] == 10**9:
                return [ranks[p] for p in pieces]
            n = min(found)[1]
            pieces[n : n + 2] = [pieces[n] + pieces[n + 1]]

    pieces = list(ranks)
    words = [bytes(pick.randrange(256) for _ in range(pick.randrange(1, 20))) for _ in range(150)]
    words += [b"".join(pick.choice(pieces) for _ in range(4))[: bpe.LONG_WORD] for _ in range(150)]
    frame = spark.createDataFrame([(bytearray(w),) for w in words], "word binary")
    got = frame.select("word", bpe.fold(bpe.rank_map(PATH), F.col("word")).alias("ids")).collect()
    assert all(list(r.ids) == plain(bytes(r.word)) == bpe.merge_with_heap(bytes(r.word), ranks) for r in got)
