from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailperks.llm import topk
from trailperks.llm.queries import op8

SMALL = "/root/testdata/sf0.001"


def plain(rows, k, modulus, scale):
    """(query_id, rank, vec_id, score) by sorting all scores."""
    sound = [
        (i, [math.floor(x * scale) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    queries = {}
    for i, v in sound:
        if i % modulus == 0:
            queries[i] = max(queries.get(i, v), v)
    out = []
    for q, a in queries.items():
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in sound if i != q)
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def found(spark, rows, k=5, modulus=2, scale=256):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    frame = frame.withColumn("id", F.lit("clash")).withColumn("v", F.lit(1)).withColumn("block", F.lit(2))
    return sorted(tuple(r) for r in topk.search(frame, k, modulus, scale).collect())


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in op8(spark, SMALL).collect()) == plain(rows, 5, 50, 256)


def random_rows(seed, count, width, spread):
    random = np.random.default_rng(seed)
    return [(int(n), (random.integers(-spread, spread + 1, width) / 7).tolist()) for n in range(count)]


@pytest.mark.parametrize("spread", [1, 3, 400])
def test_ties_and_refinement(spark, monkeypatch, spread):
    """Few bins make many rounds; few different components make many ties."""
    monkeypatch.setattr(topk, "BINS", 8)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 16)
    rows = random_rows(spread, 90, 4, spread)
    assert found(spark, rows, k=4, modulus=3, scale=20) == plain(rows, 4, 3, 20)


def test_hot_vector(spark):
    rows = [(n, [0.5, 0.5]) for n in range(300)] + random_rows(1, 100, 2, 5)[0:0] + [(n, [0.1 * n, -0.5]) for n in range(300, 340)]
    assert found(spark, rows, modulus=50) == plain(rows, 5, 50, 256)


def test_defined_results(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, []), (6, [3.0]), (7, [0.0, -1.0, 4.0]),
        (None, [9.0, 9.0]), (8, [1.0, 2.0]), (8, [2.0, 0.0]), (9, [1.0, 1.0]), (9, [1.0, 1.0]), (10, [-0.001, 0.001]),
    ]
    assert found(spark, rows) == plain(rows, 5, 2, 256)
    assert found(spark, rows[:1]) == [] and found(spark, [(1, [1.0])]) == []
    assert found(spark, rows[:1] + [(1, [1.0])]) == plain(rows[:1] + [(1, [1.0])], 5, 2, 256)
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert topk.search(empty, 5, 2, 256).count() == 0


def test_scores_that_doubles_cannot_hold(spark):
    """One row far beyond the others, and sums whose last digits a double loses: all scores stay exact."""
    random = np.random.default_rng(4)
    wide = [(n, random.integers(-300, 300, 768).astype(float).tolist()) for n in range(40)]
    wide.append((40, [20000.0 - n / 256 for n in range(768)]))
    assert found(spark, wide, modulus=4) == plain(wide, 5, 4, 256)
    large = [(n, (random.integers(-(10**9), 10**9, 3) / 256).tolist()) for n in range(60)]
    near = [(n, [4e6, 1.0 + n / 256, 3e6]) for n in range(60, 80)]  # differ in the last digit only
    assert found(spark, large + near, modulus=3) == plain(large + near, 5, 3, 256)


def test_components_and_scores_are_cut_at_the_ends(spark):
    rows = [(0, [1e300]), (1, [1.0]), (2, [-1e300]), (3, [2.0])]
    most = topk.FARTHEST
    # Both 2^60 * 256 and 2^60 * 512 lie beyond the range, so these are ties.
    assert found(spark, rows) == [
        (0, 1, 1, most), (0, 2, 3, most), (0, 3, 2, -most), (2, 1, 0, -most), (2, 2, 1, -most), (2, 3, 3, -most),
    ]


@pytest.mark.parametrize("peak", [2**20, 2**30, 2**60])
def test_products_against_whole_numbers(peak):
    random = np.random.default_rng(peak % 97)
    left, right = (np.trunc(random.uniform(-1, 1, (5, 9)) * peak) for _ in range(2))
    right[0] = np.trunc(right[0] / peak)
    got = topk.products(left, right)
    for row, one in enumerate(left):
        for column, other in enumerate(right):
            exact = sum(int(x) * int(y) for x, y in zip(one, other))
            if abs(exact) < topk.FARTHEST - 2**20:
                assert got[row, column] == exact
            elif abs(exact) > topk.FARTHEST + 2**20:
                assert got[row, column] == (topk.FARTHEST if exact > 0 else -topk.FARTHEST)
