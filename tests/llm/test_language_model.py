from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailperks.llm import language_model as lm
from trailperks.llm.queries import op5

SMALL = "/root/testdata/sf0.001"


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + [None]


def plain(rows):
    """(doc_id, text, training): the counts and the base score of each row."""
    counts = Counter(t for _, text, training in rows if training for t in tokens(text))
    total, known = sum(counts.values()), len(counts)
    out = []
    for doc, text, _ in rows:
        words = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (total + known + 1)) for t in words)
        out.append((doc, len(words), sum(counts[t] > 0 for t in words), total, round(base, 5)))
    return sorted(out, key=str)


def test_whole_table(spark):
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in texts}
    rows = op5(spark, SMALL).collect()
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows), key=str)
    assert got == plain([(r.doc_id, r.text, not held[r.doc_id]) for r in texts])
    assert all(r.held_out == held[r.doc_id] and r.score < 0 for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)  # a smaller perplexity on unseen texts


def test_defined_results(documents):
    rows = [(1, "the cat sat on the mat"), (1, "the cat sat on the mat"), (2, None), (3, ""), (None, "THE Dog"), (4, "é\x1cx " * 20000), (5, "long" * 50000)]
    docs = documents(rows).withColumn("bucket", F.lit("clash")).withColumn("training", F.lit(1)).withColumn("row", F.lit(2))
    got = lm.score(docs, F.lit(True)).collect()
    assert sorted(((r["row"]["doc_id"], r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got), key=str) == plain(
        [(d, t, True) for d, t in rows]
    )
    untrained = lm.score(docs, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 and r.score == 0 for r in untrained)
    assert lm.score(docs.where("false"), F.lit(True)).count() == 0


def test_contexts(documents):
    texts = [b"the cat the of dog", b"", b"x Of y"]
    found = lm.Tokens(texts, [b"the", b"of"])
    contexts = [int(found.contexts[p]) for p in found.pairs]
    assert contexts == [0, 1, 1, 1, 2, 2, 0, 0, 0, 2, 2]


@pytest.mark.parametrize("counted", [lm.COUNTED, 7])
def test_a_word_that_leads_nowhere_but_in_all(spark, monkeypatch, counted):
    """In each task more than a thousand words are more frequent than the one that is the most frequent of all."""
    monkeypatch.setattr(lm, "COUNTED", counted)
    texts = [(" ".join([f"W{task}x{n}" for n in range(1200)] * 3 + ["Shared"] * 2),) for task in range(4)]
    frame = spark.createDataFrame(texts, "text string").repartitionByRange(4, "text")
    assert frame.rdd.getNumPartitions() == 4
    expected = Counter(word for text, in texts for word in text.lower().encode().split())
    found = lm.frequent_words(frame)
    assert found[0] == b"shared"
    assert found == sorted(expected, key=lambda w: (-expected[w], w))[: lm.CONTEXTS]


@pytest.mark.parametrize("discount", [0.0, 0.3, 0.8])
def test_stirling_numbers(discount):
    """Against adding up all partitions of up to six customers."""

    def partitions(n):
        if n == 0:
            yield []
            return
        for rest in partitions(n - 1):
            yield [1, *rest]
            for k in range(len(rest)):
                yield [*rest[:k], rest[k] + 1, *rest[k + 1 :]]

    for c in range(1, 7):
        for t in range(1, c + 1):
            weight = sum(math.prod(math.prod(j - discount for j in range(1, size)) for size in p) for p in partitions(c) if len(p) == t)
            assert math.exp(lm.log_stirling(discount)[c, t]) == pytest.approx(weight)


@pytest.mark.parametrize("counts", [[5], [3, 4]])
def test_seats_follow_their_conditional_distribution(counts):
    d, s, others, base = 0.4, 1.5, 3, 0.2
    for c in counts:
        weights = [math.exp(lm.log_stirling(d)[c, t]) * math.prod((s + d * (others + j)) * base for j in range(t)) for t in range(1, c + 1)]
        n = 40000
        drawn = lm.seat(np.full(n, c), np.full(n, base), np.full(n, others), d, s, np.random.default_rng(1))
        shares = np.bincount(drawn, minlength=c + 1)[1:] / n
        assert np.allclose(shares, np.array(weights) / sum(weights), atol=0.01)


def test_many_customers():
    random = np.random.default_rng(2)
    counts = np.array([70, 1000, 10**6, 0, 1])
    tables = lm.seat(counts, np.full(5, 0.1), np.full(5, 10), 0.5, 1.0, random)
    assert tables[3] == 0 and tables[4] == 1 and (tables[:3] >= 1).all() and (tables <= counts).all() and tables[2] > tables[0]


def test_predictive_probabilities_sum_to_one():
    random = np.random.default_rng(3)
    pairs = sorted(set(zip(random.integers(0, 300, 2000).tolist(), random.integers(0, lm.CONTEXTS + 1, 2000).tolist())))
    words, contexts = (np.array(x) for x in zip(*pairs))
    counts = random.zipf(1.6, len(pairs)).clip(0, 500)
    number, at_context = words.max() + 1, np.bincount(contexts, counts, minlength=lm.CONTEXTS + 1)
    for tables, customers, parent_tables in lm.seatings(words, contexts, counts, 1, random):
        uniform = 1 / (number + 1)
        parent = lm.predictive(customers, parent_tables, customers.sum(), parent_tables.sum(), uniform, 0)
        unknown = lm.predictive(0, 0, customers.sum(), parent_tables.sum(), uniform, 0)
        assert parent.sum() + unknown == pytest.approx(1)
        for u in range(lm.CONTEXTS + 1):
            n, t = np.zeros(number), np.zeros(number)
            n[words[contexts == u]], t[words[contexts == u]] = counts[contexts == u], tables[contexts == u]
            chance = lm.predictive(n, t, at_context[u], t.sum(), parent, 1)
            outside = lm.predictive(0, 0, at_context[u], t.sum(), unknown, 1)
            assert chance.sum() + outside == pytest.approx(1)


def test_scores_sum_to_one(documents, monkeypatch):
    """One restaurant: the scores of all one-word texts, the empty text and an unknown word."""
    monkeypatch.setattr(lm, "CONTEXTS", 0)
    words = [f"w{n}" for n in range(12)]
    train = [(n, " ".join(itertools.islice(itertools.cycle(words[: 1 + n % 12]), 5 + n))) for n in range(30)]
    asked = [(100 + n, word) for n, word in enumerate([*words, "unknown", ""])]
    got = {r["row"]["text"]: r.score for r in lm.score(documents(train + asked), F.col("doc_id") < 100).collect() if r["row"]["doc_id"] >= 100}
    end = 10 ** got[""]
    assert sum(10 ** got[word] / end for word in [*words, "unknown"]) + end == pytest.approx(1, rel=1e-5)


@pytest.mark.parametrize("spread", [1, 32, 100])
def test_every_preceding_word_is_a_context(documents, monkeypatch, spread):
    """More words than are spread, each pair once: every seating is certain, so scores follow by hand."""
    monkeypatch.setattr(lm, "CONTEXTS", spread)
    words = [f"w{n:02}" for n in range(60)]
    held_out = ["w05 w06", "w05 w07", "w05", "other w06", "w05 other", ""]
    docs = documents([(1, " ".join(words)), *[(2 + n, text) for n, text in enumerate(held_out)]])
    (d0, d1), known = lm.DISCOUNT, len(words) + 1
    follows = dict(zip(["", *words], [*words, None]))

    def parent(word):
        return ((1 - d0) * (word in follows.values()) + (1 + d0 * known) / (known + 1)) / (1 + known)

    def plain(text):
        pairs = zip(["", *text.split()], [*text.split(), None])
        return sum(
            math.log10(((1 - d1) * (follows[u] == w) + (1 + d1) * parent(w)) / 2 if u in follows else parent(w)) for u, w in pairs
        )

    got = {r["row"]["text"]: r.score for r in lm.score(docs, F.col("doc_id") == 1).collect()}
    assert got == pytest.approx({text: plain(text) for text in [" ".join(words), *held_out]}, rel=1e-6)


def test_texts_sum_to_one(documents):
    """All texts of two known words and an unknown one, up to six words."""
    train = ["a", "b a", "", "b", "b a", "a b"] * 20 + ["a"] * 100
    asked = [" ".join(text) for length in range(7) for text in itertools.product("abz", repeat=length)]
    docs = documents([(n, text) for n, text in enumerate(train)] + [(1000 + n, text) for n, text in enumerate(asked)])
    got = [r.score for r in lm.score(docs, F.col("doc_id") < 1000).collect() if r["row"]["doc_id"] >= 1000]
    assert len(got) == len(asked) and 0.97 < sum(10**x for x in got) < 1 + 1e-6


def test_contexts_are_the_preceding_words():
    texts = [b"the cat The dog", b"", b"x the"]
    found = lm.Tokens(texts)
    before = [None, "the", "cat", "the", "dog", None, None, "x", "the"]
    after = ["the", "cat", "the", "dog", None, None, "x", "the", None]

    def hashes(words):
        return [0 if w is None else int(lm.hash_joined(w.encode())[0]) for w in words]

    assert [int(found.contexts[p]) for p in found.pairs] == hashes(before)
    assert [int(found.words[p]) for p in found.pairs] == hashes(after)
    assert len(found.words) == len(set(zip(before, after)))


def test_seats_of_parts():
    """Restaurants dealt to eight parts, with the totals of all parts told in rounds, seat about as many as in one part."""
    random = np.random.default_rng(4)
    words, contexts = (np.minimum(random.zipf(1.4, 200000), 2000) - 1 for _ in range(2))
    pairs, counts = np.unique(contexts * 2000 + words, return_counts=True)
    words, contexts = pairs % 2000, pairs // 2000
    known, tables = len(np.unique(words)), np.ones(len(pairs), np.int64)
    for sweeps in lm.ROUNDS:
        customers = np.bincount(words, tables, minlength=2000).astype(np.int64)
        parent, sampled = lm.parent_seatings(customers, known, random), np.zeros((lm.SAMPLES, len(pairs)), np.int64)
        for part in range(8):
            mine = contexts % 8 == part
            (names, numbers), (_, places) = (np.unique(x[mine], return_inverse=True) for x in (words, contexts))
            outside = lm.Outside(customers[names], parent[names], customers.sum(), parent.sum(), known, np.zeros(places.max() + 1, np.int64))
            kept = lm.seatings(numbers, places, counts[mine], 8, random, outside, tables[mine], sweeps)
            for s, (found, _, _) in enumerate(kept):
                sampled[s, mine] = found
        tables = sampled[len(kept) - 1]
    assert (sampled >= 1).all() and (sampled <= counts).all()
    whole = sum(found.sum() for found, _, _ in lm.seatings(words, contexts, counts, 1, random))
    assert sampled.sum() == pytest.approx(whole, rel=0.03)
