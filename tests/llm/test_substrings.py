from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F
from words_alike import ALIKE

from trailperks.llm import substrings
from trailperks.llm.queries import op10

SMALL = "/root/testdata/sf0.001"


def plain(rows, window):
    """(id, text) rows: words, removed and kept text, by looking up every window in a dictionary."""
    last = 2**63 - 1
    split = [(last if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for doc, words in split:
        for start in range(len(words) - window + 1):
            key = tuple(words[start : start + window])
            first[key] = min(first.get(key, (doc, start)), (doc, start))
    out = []
    for doc, words in split:
        gone = set()
        for start in range(len(words) - window + 1):
            if first[tuple(words[start : start + window])] < (doc, start):
                gone.update(range(start, start + window))
        out.append((len(words), len(gone), " ".join(w for n, w in enumerate(words) if n not in gone)))
    return sorted(out)


def found(docs, window):
    return sorted((r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeated(docs, window).collect())


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs, 20) == plain(rows, 20)
    assert op10(spark, SMALL).count() == len(rows)


@pytest.mark.parametrize("window", [14, 20, 33])
@pytest.mark.parametrize("seed", [0, 1])
def test_passages_at_every_phase(documents, window, seed):
    """Passages of window - 1 .. window + 5 words at random places, inside documents and across them."""
    pick = random.Random(seed)
    word = lambda: f"w{pick.randrange(10**6)}"
    passages = [[word() for _ in range(window + extra)] for extra in range(-1, 6)]
    rows = []
    for doc in range(120):
        words = [word() for _ in range(pick.randrange(40))]
        for _ in range(pick.randrange(4)):
            words += pick.choice(passages) + [word() for _ in range(pick.randrange(15))]
        rows.append((doc, pick.choice([" ", "\n", " \t"]).join(words)))
    assert found(documents(rows), window) == plain(rows, window)


def test_hard_texts(documents):
    thirty = " ".join(f"x{n}" for n in range(30))
    rows = [
        (0, None), (1, ""), (2, " \n"), (3, "a b"), (4, "same " * 100), (5, thirty), (6, thirty), (6, thirty), (7, "y " + thirty + "\n"),
        (None, thirty), (8, "é " * 25), (9, "\x1c".join("abcdefghijklmnopqrstuvwxyz")), (10, "long" * 300000), (11, thirty * 3),
        (12, "z " * 30000),
    ]
    docs = documents(rows).withColumn("bucket", F.lit("clash")).withColumn("id", F.lit(1)).withColumn("row", F.lit(2))
    assert found(docs, 20) == plain(rows, 20)


def test_rows_with_one_id(documents):
    a, b = (" ".join(f"{x}{n}" for n in range(25)) for x in "ab")
    rows = [(1, a), (1, a), (1, "q " + a), (1, b), (2, b), (2, b + " " + b)]
    assert found(documents(rows), 20) == plain(rows, 20)


def test_extra_columns_and_no_rows(documents):
    docs = documents([(1, "a b c", "fr")])
    assert substrings.remove_repeated(docs).first()["row"]["lang"] == "fr"
    assert substrings.remove_repeated(docs.where("false")).count() == 0


def test_different_words_that_look_alike(documents):
    """After 19 equal words comes one that a polynomial hash takes for the other; nothing repeats."""
    same = " ".join(f"w{n}" for n in range(19))
    rows = [(n, f"{same} {word}") for n, word in enumerate(ALIKE)]
    assert found(documents(rows), 20) == plain(rows, 20) == sorted((20, 0, text) for _, text in rows)


def test_a_third_of_the_rows_under_one_id_and_a_third_without(documents):
    pick = random.Random(3)
    texts = [" ".join(f"t{pick.randrange(10**6)}" for _ in range(30)) for _ in range(50)]
    rows = [((1, None, n)[n % 3], texts[n % 50]) for n in range(600)]
    assert found(documents(rows), 20) == plain(rows, 20)
