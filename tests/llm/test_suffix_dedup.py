from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailperks.llm import suffix_dedup
from trailperks.llm.queries import op12
from trailperks.llm.suffix_arrays import suffix_arrays

SMALL = "/root/testdata/sf0.001"


def plain(texts, window):
    """(bytes, removed, spans, kept) of each text, by counting every window in a dictionary."""
    data = [(text or "").encode() for text in texts]
    counts = Counter(d[at : at + window] for d in data for at in range(len(d) - window + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for at in range(len(d) - window + 1):
            if counts[d[at : at + window]] > 1:
                gone[at : at + window] = b"\x01" * window
        spans = sum(len(part) > 0 for part in bytes(gone).split(b"\0"))
        out.append((len(d), sum(gone), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def found(docs, window):
    rows = suffix_dedup.remove_repeated(docs, window).collect()
    return sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows)


@pytest.mark.parametrize("letters", [1, 2, 3, 30])
def test_suffix_arrays(letters):
    """Many texts at once, of very different lengths, against sorting."""
    pick = random.Random(letters)
    for _ in range(40):
        texts = []
        for _ in range(pick.randrange(1, 30)):
            text = [pick.randrange(1, letters + 1) for _ in range(pick.choice([0, 1, 2, 5, 20, 90]))]
            texts.append(text * pick.choice([1, 1, 3]) + [0])
        ends = np.cumsum([len(text) for text in texts])
        got = suffix_arrays(np.array(sum(texts, []), np.uint16), ends).tolist()
        expected = [end - len(t) + at for t, end in zip(texts, ends.tolist()) for at in sorted(range(len(t)), key=lambda at: t[at:])]
        assert got == expected


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    texts = [r.text for r in docs.collect()]
    assert found(docs, 200) == sorted(plain(texts, 200))
    assert op12(spark, SMALL).count() == len(texts)


@pytest.mark.parametrize("window", [49, 64, 100])
@pytest.mark.parametrize("seed", [0, 1])
def test_passages_at_every_place(documents, window, seed):
    """Passages of window - 2 .. window + 90 bytes at random places, some cut, some inside others, in one text and many."""
    pick = random.Random(seed)
    noise = lambda count: "".join(pick.choice("abcdefgh é€") for _ in range(count))
    passages = [noise(window + extra) for extra in (-2, -1, 0, 1, 2, 5, 40, 90)]
    texts = []
    for _ in range(150):
        text = noise(pick.randrange(80))
        for _ in range(pick.randrange(4)):
            passage = pick.choice(passages)
            text += passage[pick.choice([0, 0, 7]) :] + noise(pick.randrange(30))
        texts.append(text)
    assert found(documents(list(enumerate(texts))), window) == sorted(plain(texts, window))


def test_one_passage_in_every_document(documents):
    """A family of many distinct strings is dealt to several suffix arrays; some go on alike for a few bytes."""
    pick = random.Random(5)
    word = lambda: "".join(pick.choice("ab") for _ in range(6)) + "".join(pick.choice("cdefgh") for _ in range(40))
    shared = "".join(pick.choice("klmnop") for _ in range(130))
    texts = [word() + shared + word() for _ in range(400)] + [word()[::-1] + shared[:99] + word() for _ in range(100)]
    assert found(documents(list(enumerate(texts))), 100) == sorted(plain(texts, 100))
    assert found(documents(list(enumerate(texts))), 140) == sorted(plain(texts, 140))


def test_hard_texts(documents):
    pick = random.Random(9)
    line = "".join(pick.choice("abcdefgh") for _ in range(300))
    texts = [
        None, "", "a", "x" * 199, "y" * 200, "y" * 200, "z" * 201, "w" * 5000, "ab" * 400, "abc" * 100, line, "q" + line, line * 3,
        "é" * 100, "é" * 99 + "e", "€" * 150, "\0" * 250, "\0" * 100 + "\1" * 150, line[:150], line[100:], "\x01\x00" * 150,
    ]
    rows = list(enumerate(texts)) + [(None, line[::-1]), (3, None), (3, line[::-1]), (None, None)]
    docs = documents(rows)
    for name in ("bucket", "part", "row", "n_bytes", "kept"):
        docs = docs.withColumn(name, F.lit(1))
    assert found(docs, 200) == sorted(plain([text for _, text in rows], 200))


def test_a_very_long_text(documents):
    """Windows across the slices of a text of several megabytes."""
    pick = random.Random(2)
    words = ["".join(pick.choice("abcdefghij") for _ in range(pick.randrange(3, 9))) for _ in range(3000)]
    text = " ".join(pick.choice(words) for _ in range(400_000))
    cut = 2**20 - 150
    rows = [(0, text), (1, "begin " + text[cut : cut + 300] + " end"), (2, text[1000:1500])]
    got = {r.row.doc_id: r for r in suffix_dedup.remove_repeated(documents(rows), 200).collect()}
    assert (got[0].n_removed, got[0].n_spans, bytes(got[0].kept)) == (
        800, 2, (text[:1000] + text[1500:cut] + text[cut + 300 :]).encode(),
    )
    assert bytes(got[1].kept) == b"begin  end" and bytes(got[2].kept) == b""


def test_rows_under_one_id_spread(spark):
    """A third of all rows under one id and a third under none, of few texts: still every row, and equal texts go."""
    pick = random.Random(4)
    texts = ["".join(pick.choice("abcdefgh") for _ in range(250)) for _ in range(40)]
    rows = [((1, None, n)[n % 3], texts[n % 38] if n < 900 else texts[38 + n % 2] + str(n)) for n in range(902)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs, 200) == sorted(plain([text for _, text in rows], 200))


def test_extra_columns_and_no_rows(documents):
    docs = documents([(1, "a b c", "fr")])
    assert suffix_dedup.remove_repeated(docs).first()["row"]["lang"] == "fr"
    assert suffix_dedup.remove_repeated(docs.where("false")).count() == 0
