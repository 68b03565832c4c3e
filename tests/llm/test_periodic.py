from __future__ import annotations

import random
import re
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailperks.llm import periodic
from trailperks.llm.queries import op13

SMALL = "/root/testdata/sf0.001"


def plain_runs(words, least):
    """All runs, by looking at every period and every stretch of equal words."""
    found = {}
    for period in range(1, len(words) // 3 + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end + period - at >= max(least, 3 * period):
                found.setdefault((at, end + period), period)
            at = end + 1
    return sorted((begin, end - begin, period) for (begin, end), period in found.items())


def plain_kept(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def plain(text, least=24):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = plain_runs(words, least)
    return len(words), [(s, n, q) for s, n, q in sorted(runs, key=lambda r: (r[0], r[2]))], plain_kept(words, runs)


def direct(texts, least=24):
    """The function of a batch, without Spark."""
    out = periodic.judged([(text or "").encode() for text in texts], least)
    return [
        (n, [(r["start"], r["length"], r["period"]) for r in runs], kept)
        for n, runs, kept in zip(*(out[name].to_pylist() for name in ("n_words", "runs", "collapsed")))
    ]


def found(docs, least=24):
    rows = periodic.find_runs(docs, least).collect()
    return sorted((r.row.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in rows)


def fibonacci(count):
    a, b = "a", "a b"
    while len(b.split()) < count:
        a, b = b, f"{b} {a}"
    return b


def periodic_text(pick, words):
    """Random words between repetitions of every kind: cut, nested, and with one word changed."""
    out = []
    while len(out) < words:
        unit = [f"w{pick.randrange(pick.choice([2, 5, 1000]))}" for _ in range(pick.choice([1, 2, 3, 7, 11, 12, 13, 25, 60, 130]))]
        if pick.random() < 0.3:  # highly periodic inside its period
            unit = unit[:3] * pick.randrange(2, 15) + unit
        stretch = unit * pick.choice([1, 2, 3, 4, 9])
        stretch = stretch[: len(stretch) - pick.randrange(len(unit))]
        if pick.random() < 0.3:
            stretch[pick.randrange(len(stretch))] = "odd"
        out += stretch + [f"x{pick.randrange(10**6)}" for _ in range(pick.choice([0, 0, 3]))]
    return pick.choice([" ", "\n", " \t"]).join(out)


@pytest.mark.parametrize("seed", range(6))
def test_repetitions_of_every_kind(seed):
    pick = random.Random(seed)
    texts = [periodic_text(pick, pick.choice([10, 60, 400, 1500])) for _ in range(25)]
    assert direct(texts) == [plain(text) for text in texts]


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_few_different_words(letters):
    pick = random.Random(letters)
    texts = [" ".join(pick.choice("abc"[:letters]) for _ in range(pick.randrange(300))) for _ in range(150)]
    assert direct(texts, 9) == [plain(text, 9) for text in texts]


def test_texts_with_structure():
    thue = "a"
    for _ in range(10):
        thue = thue + thue.translate(str.maketrans("ab", "ba"))
    texts = [fibonacci(900), " ".join(thue), " ".join(thue * 3), " ".join("ab" * 500), fibonacci(100) + " " + fibonacci(700)]
    nested = " ".join(["x"] * 40 + ["y"]) + " "
    texts += [nested * 3, nested * 10, (nested * 4 + "z ") * 5]
    assert direct(texts, 9) == [plain(text, 9) for text in texts]


@pytest.mark.parametrize("bits", [1, 4, 9])
def test_wrong_hashes_cost_time_only(monkeypatch, bits):
    """Hashes of few bits agree for different words; the result is the same."""
    right = periodic.mixed
    monkeypatch.setattr(periodic, "mixed", lambda values: right(values) & np.uint64(2**bits - 1))
    pick = random.Random(bits)
    texts = [periodic_text(pick, 300) for _ in range(8)]
    for text, (n, runs, kept) in zip(texts, direct(texts)):
        # With such hashes a begin or end may be passed over in the choice of places, but no run is wrong.
        assert set(runs) <= set(plain(text)[1]) and n == plain(text)[0] and kept == plain_kept(text.split(), runs)


def test_hard_rows(documents):
    line = " ".join(f"l{n}" for n in range(30))
    texts = [
        None, "", " \n\t", "a", "a " * 23, "a " * 24, "a " * 25, f"{line} " * 3, f"{line} " * 2, f"q {line} {line} {line} q",
        "é ü " * 30, "\x1c".join("ab" * 30), "long" * 300_000, "word " * 4_000, line + " " + "z " * 40,
    ]
    rows = [(n, text) for n, text in enumerate(texts)] + [(None, "a " * 30), (7, f"{line} " * 3), (None, None)]
    docs = documents(rows).withColumn("row", F.lit(1)).withColumn("runs", F.lit("clash")).withColumn("n_words", F.lit(2))
    expected = sorted(((n, *plain(text)) for n, text in rows), key=repr)
    assert sorted(((r[0], r[1], r[2], r[3]) for r in (
        (r.row.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.find_runs(docs).collect()
    )), key=repr) == expected
    assert periodic.find_runs(docs.where("false")).count() == 0
    assert periodic.find_runs(documents([(1, "a b", "fr")])).first()["row"]["lang"] == "fr"


def contract_text(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    checksum = crc32(str(doc_id).encode())
    if checksum % 10 == 0 and words:
        n, g = len(words), checksum // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return " ".join(words)


def test_query_on_the_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op13(spark, SMALL).collect()
    assert {r.doc_id for r in rows} == docs.keys()
    digest = lambda text: sha256(text.encode()).hexdigest()
    for r in rows:
        _, runs, kept = plain(contract_text(r.doc_id, docs[r.doc_id]))
        assert r.n_runs == len(runs) and r.collapsed_sha256 == digest(kept)
        assert r.runs_sha256 == digest("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        best = max(runs, key=lambda run: (run[1] / run[2], -run[0], -run[2]), default=None)
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
    assert sum(r.n_runs > 0 for r in rows) >= 10


def test_strongest_is_exact(spark):
    runs = [(0, 10**9 + 1, 10**7), (5, 10**9, 10**7 - 1), (9, 30, 10), (4, 30, 10)]
    kind = "runs array<struct<start: long, length: long, period: long>>"
    frame = spark.createDataFrame([(runs,), (runs[2:],), ([],), (None,)], kind)
    assert [r[0] and tuple(r[0]) for r in frame.select(periodic.strongest(F.col("runs"))).collect()] == [
        (5, 10**9, 10**7 - 1), (9, 30, 10), None, None,
    ]
