from __future__ import annotations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from trailperks.llm import simhash

SMALL = "/root/testdata/sf0.001"


def plain_fingerprint(text, shingle=3):
    """Word by word and bit by bit, with Python's regular expressions."""
    import re

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[n : n + shingle]) for n in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(fingerprints, max_bits):
    """Smallest id reachable, by comparing every two fingerprints."""
    root = {doc: doc for doc in fingerprints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    docs = sorted(fingerprints)
    for n, a in enumerate(docs):
        for b in docs[:n]:
            if (fingerprints[a] ^ fingerprints[b]).bit_count() <= max_bits:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {doc: find(doc) for doc in docs}


def found(docs, **how):
    return {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs, **how).collect()}


@pytest.mark.parametrize("max_bits", [1, 2])
def test_whole_table(spark, max_bits):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    fingerprints = {r.doc_id: plain_fingerprint(r.text) for r in docs.collect()}
    expected = plain_components(fingerprints, max_bits)
    assert found(docs, max_bits=max_bits) == {d: (fingerprints[d], expected[d]) for d in fingerprints}


def test_hard_texts(documents):
    texts = [None, "", " \t", "one", "one two", "ONE two", "a b c", "a b c a b c", "É é", "x " * 20000, "a b c", "a\x1cb c", " a b"]
    docs = documents([(n, t) for n, t in enumerate(texts)]).withColumn("fp", F.lit("clash")).withColumn("key", F.lit(0))
    fingerprints = {n: plain_fingerprint(t) for n, t in enumerate(texts)}
    expected = plain_components(fingerprints, 2)
    assert found(docs) == {n: (fingerprints[n], expected[n]) for n in fingerprints}


def test_null_repeated_and_no_rows(documents):
    docs = documents([(None, "only here at home"), (None, "shared words of text"), (9, "shared words of text"), (9, "shared words of text")])
    rows = sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_duplicates(docs).collect())
    assert rows == [("9", "9"), ("9", "9"), ("None", "9"), ("None", "None")]
    assert simhash.near_duplicates(docs.where("false")).count() == 0


def near_cluster(size, seed):
    """Fingerprints around a few centres, within a few bits."""
    random = np.random.default_rng(seed)
    centres = random.integers(0, 2**63, 3)
    out = set()
    while len(out) < size:
        value = int(random.choice(centres))
        for bit in random.choice(64, random.integers(0, 5), replace=False):
            value ^= 1 << int(bit)
        out.add(value)
    return sorted(out)


@pytest.mark.parametrize("max_bits", [1, 2])
@pytest.mark.parametrize("bucket", [2, 256])
def test_crowded_buckets(spark, monkeypatch, bucket, max_bits):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    values = near_cluster(300, max_bits)
    distinct = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fp long")
    edges = simhash.links(distinct, max_bits).collect()
    assert all(((e.a ^ e.b) % 2**64).bit_count() <= max_bits for e in edges)
    roots = {r.node % 2**64: r.root % 2**64 for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = plain_components({v: v for v in values}, max_bits)
    classes = lambda of: {frozenset(v for v in values if of(v) == r) for r in map(of, values)}
    assert classes(lambda v: roots.get(v, v)) == classes(expected.get)


def test_chain_of_links(spark):
    edges = spark.createDataFrame([(n, n + 1) for n in range(200)], "a long, b long")
    assert {r.root for r in simhash.components(edges).collect()} == {0}
    assert simhash.components(edges.where("false")).count() == 0
