from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailperks.llm import weighted_sampling as cws
from trailperks.llm.queries import op9

SMALL = "/root/testdata/sf0.001"


def weights(text):
    """Words between ASCII blanks; a text without any is the empty word."""
    return Counter(re.findall(r"[^\x20\x09-\x0D]+", text or "") or [""])


def jaccard(a, b):
    a, b = weights(a), weights(b)
    return sum((a & b).values()) / sum((a | b).values())


def edited(rows):
    """(id, text) without repeated ids: the contract's edited text and next text."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for n, (doc, text) in enumerate(order):
        text, following = text or "", order[(n + 1) % len(order)][1] or ""
        cut = len(text) // 2
        out[doc] = (text[: len(text) - cut] + following[:cut], following)
    return out


def check(docs, rows):
    expected, texts = edited(rows), dict(rows)
    got = {r.doc_id: r for r in cws.fingerprints(docs).collect()}
    assert got.keys() == texts.keys()
    for doc, row in got.items():
        assert row.n_chars == len(texts[doc] or "")
        assert row.edited_sha256 == hashlib.sha256(expected[doc][0].encode()).hexdigest()
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        if weights(texts[doc]) == weights(expected[doc][0]):
            assert row.near_edited == 1.0
        if weights(texts[doc]) == weights(expected[doc][1]):
            assert row.near_next == 1.0
    return got, expected


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got, expected = check(docs, rows)
    texts = dict(rows)
    for column, other in (("near_edited", 0), ("near_next", 1)):
        errors = [got[d][column] - jaccard(texts[d], expected[d][other]) for d in texts]
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.15
    same = {}
    for doc, text in rows:
        assert same.setdefault(text, got[doc].fingerprint) == got[doc].fingerprint
    assert op9(spark, SMALL).count() == len(rows)


def test_hard_texts(documents):
    texts = [None, "", " \n", "a", "a a a", "é\U0001f600 x", "same words", "same words", "w " * 40000, "x", "\x1c a", "long" * 50000]
    rows = [(n, t) for n, t in enumerate(texts)] + [(None, "no id"), (-5, "below")]
    docs = documents(rows).withColumn("ord", F.lit("clash")).withColumn("mark", F.lit(1)).withColumn("version", F.lit(2))
    got, _ = check(docs, rows)
    assert got[0].fingerprint == got[1].fingerprint == got[2].fingerprint and got[6].fingerprint == got[7].fingerprint


def test_single_repeated_and_no_rows(documents):
    one = cws.fingerprints(documents([(7, "only one here")])).first()
    assert one.near_next == 1.0
    rows = cws.fingerprints(documents([(1, "a b c d"), (1, "a b c d"), (1, "other"), (2, "z")])).collect()
    assert sorted((r.doc_id, r.n_chars) for r in rows) == [(1, 5), (1, 7), (1, 7), (2, 1)]
    assert len({r.edited_sha256 for r in rows if r.n_chars == 7}) == 1
    assert cws.fingerprints(documents([(1, "a")]).where("false")).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_collisions_estimate_generalised_jaccard(spark, monkeypatch, seed):
    """With many samples the share of collisions comes close to the weighted similarity."""
    monkeypatch.setattr(cws, "SAMPLES", 400)
    pick = random.Random(seed)
    texts = [" ".join(pick.choice("abcdefghij") * pick.randrange(1, 3) for _ in range(pick.randrange(5, 60))) for _ in range(2)]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    a, b = (np.array(r.samples) for r in cws.signatures(rows, ["k"]).orderBy("k").collect())
    assert abs((a == b).mean() - jaccard(*texts)) < 0.09


def test_words_stay_in_their_partition(spark):
    """Counting words needs no shuffle of its own: no exchange is keyed by the term."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = docs.select("doc_id", "text").repartition(4, "doc_id")
    plan = cws.signatures(texts, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan
