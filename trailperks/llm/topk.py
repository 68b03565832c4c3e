"""Exact top-k search by inner product with distributed histogram selection.

All scores are computed in blocks of queries and candidates, but never kept. Each round computes them again and
counts, per query, how many fall into each bin of the range in which its kth best score still lies; the counts are
summed over all tasks and the range shrinks to the bin of the kth score, until it is one integer wide. A last pass
keeps the scores above the kth and, of those equal to it, the smallest ids, so that no more than k rows per query
and task are shuffled.

Queries (a stated subset) meet candidates by an equi-join on (query block, salt): a candidate goes once to each
block of queries, a block of queries once to each salt. Blocks and salts are sized from counts, so a task never
holds more than a block of queries and one salt of candidates.

Defined results: vectors that are null, or hold a null or a component that is not finite, and rows with a null id take
no part. Shorter vectors count as padded with zeros. A query given several times with one id is searched once, with its
greatest vector; rows that bear a query's own id are not its candidates; a candidate given several times appears several
times. Ties go to the smaller id. Empty input gives an empty result. Extra columns are ignored. Components count as whole
numbers from -2^60 to 2^60 (beyond, as these), scores as whole numbers from -2^62 to 2^62. Where products of doubles are
not exact, components are split into limbs whose products are, and these are added as integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from trailperks.llm.common import shuffle_partitions
from trailperks.session import cut_lineage

QUERIES_PER_BLOCK = 2048
CANDIDATES_PER_SALT = 16384
BINS = 1024
#: Whole numbers up to here are exact as doubles; components and scores are cut at the others.
EXACT_DOUBLE, LARGEST, FARTHEST = 2**53, 2**60, 2**62
#: The score of a query's own row, which is no candidate.
OWN = -(2**63)


def scaled(vectors: DataFrame, scale: int, id_column: str, vector: str) -> DataFrame:
    """(id, v): the vectors that take part, as whole numbers."""
    doubles = F.col(vector).cast("array<double>")
    sound = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(
        doubles, lambda x: F.least(F.greatest(x * scale, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))
    )
    return vectors.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & sound).select(
        F.col(id_column).cast("long").alias("id"),
        F.transform(whole, lambda x: F.floor(x).cast("double")).alias("v"),
    )


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    arrays = column.combine_chunks()
    lengths = np.diff(arrays.offsets.to_numpy())
    rows = np.repeat(np.arange(len(lengths)), lengths)
    places = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, places] = arrays.flatten().to_numpy(zero_copy_only=False)
    return out


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Parts of whole numbers, of so many bits each, whose sum with growing powers of two they are."""
    out, unit = [], float(2**bits)
    while values.any():
        rest = np.trunc(values / unit)
        out.append(values - rest * unit)
        values = rest
    return out


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers as integers, cut at the farthest ones."""
    peaks = [float(np.abs(x).max(initial=0)) for x in (left, right)]
    width = max(1, left.shape[1])
    if peaks[0] * peaks[1] * width < EXACT_DOUBLE:
        return (left @ right.T).astype(np.int64)
    bits = (EXACT_DOUBLE.bit_length() - 1 - width.bit_length()) // 2
    total = np.zeros((len(left), len(right)), np.int64)
    about = left @ right.T
    for n, one in enumerate(limbs(left, bits)):
        for m, other in enumerate(limbs(right, bits)):
            # Modulo 2^64: what lies in the range of scores comes out right, whatever its parts.
            factor = pow(2, bits * (n + m), 2**64)
            total += ((one @ other.T).astype(np.int64).view(np.uint64) * np.uint64(factor)).view(np.int64)
    total[about >= FARTHEST] = FARTHEST
    total[about <= -FARTHEST] = -FARTHEST
    return total


def score_blocks(queries: pa.Table, candidates: pa.Table, width: int, rows: int = 1024):
    """Scores (queries by candidates) in slices; a query's own row scores ``OWN``."""
    ids, left = queries["id"].to_numpy(), matrix(queries["v"], width)
    for at in range(0, candidates.num_rows, rows):
        part = candidates.slice(at, rows)
        found = part["id"].to_numpy()
        scores = products(left, matrix(part["v"], width))
        scores[ids[:, None] == found[None, :]] = OWN
        yield found, scores


def search(
    vectors: DataFrame, k: int, query_modulus: int, scale: int, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose id is divisible by ``query_modulus``."""
    spark = vectors.sparkSession
    every = scaled(vectors, scale, id_column, vector)
    asked = every.where(F.col("id") % query_modulus == 0).groupBy("id").agg(F.max("v").alias("v"))
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    facts = every.agg(F.count("*"), F.max(F.size("v")), F.max(largest)).first()
    count, width, peak = facts[0], facts[1] or 0, facts[2] or 0.0
    bound = min(int(peak) ** 2 * width, FARTHEST)
    blocks = max(1, -(-asked.count() // QUERIES_PER_BLOCK))
    salts = max(shuffle_partitions(spark), -(-count // CANDIDATES_PER_SALT))
    of_block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    dealt = every.select(
        "id",
        "v",
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(F.xxhash64("id", "v"), F.lit(salts)).cast("int").alias("salt"),
    ).groupBy("block", "salt")
    spread = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))

    # Range [low, low + bins * step) that holds the kth score; above: scores known to lie beyond the range.
    step = 1
    while BINS * step < 2 * bound + 1:
        step *= BINS
    state = cut_lineage(
        asked.select(
            "id", "v", of_block.alias("block"), F.lit(-bound).cast("long").alias("low"), F.lit(0).cast("long").alias("above")
        )
    )
    while True:
        counts = (
            state.withColumn("salt", spread)
            .groupBy("block", "salt")
            .cogroup(dealt)
            .applyInArrow(histogram(width, k, step), "id long, bin int, n long")
            .groupBy("id", "bin")
            .agg(F.sum("n").alias("n"))
        )
        descending = Window.partitionBy("id").orderBy(F.desc("bin"))
        reached = (
            counts.withColumn("so_far", F.sum("n").over(descending))
            .join(state.select("id", "above"), "id")
            .where(F.col("so_far") + F.col("above") >= k)
            .groupBy("id")
            .agg(F.max(F.struct("bin", (F.col("so_far") - F.col("n")).alias("beyond"))).alias("kth"))
        )
        # Queries with fewer than k candidates keep everything: their kth score is the lowest possible.
        state = cut_lineage(
            state.join(reached, "id", "left").select(
                "id",
                "v",
                "block",
                (F.col("low") + F.coalesce(F.col("kth.bin"), F.lit(0)).cast("long") * F.lit(step).cast("long")).alias("low"),
                (F.col("above") + F.coalesce(F.col("kth.beyond"), F.lit(0))).alias("above"),
            )
        )
        if step == 1:
            break
        step //= BINS
    best = (
        state.withColumn("salt", spread)
        .groupBy("block", "salt")
        .cogroup(dealt)
        .applyInArrow(survivors(width, k), "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def histogram(width: int, k: int, step: int):
    """Counts per query and bin; bins below the one that holds the kth of this task cannot matter and are left out."""

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        total = np.zeros((queries.num_rows, BINS), dtype=np.int64)
        if queries.num_rows:
            low = queries["low"].to_numpy()[:, None]
            for _, scores in score_blocks(queries, candidates, width):
                # Compared before subtracting: differences of far scores would not fit a long.
                near = (scores >= low) & (scores != OWN)
                bins = np.where(near, (scores - low).view(np.uint64) // np.uint64(step), np.uint64(BINS))
                rows, places = np.nonzero(bins < BINS)
                flat = rows * BINS + bins[rows, places].astype(np.int64)
                total += np.bincount(flat, minlength=total.size).reshape(total.shape)
        higher = np.cumsum(total[:, ::-1], axis=1)[:, ::-1] - total
        rows, places = np.nonzero((total > 0) & (higher < k))
        ids = queries["id"].to_numpy()[rows] if queries.num_rows else np.empty(0, np.int64)
        return pa.table(
            {"id": pa.array(ids, pa.int64()), "bin": pa.array(places, pa.int32()), "n": pa.array(total[rows, places], pa.int64())}
        )

    return run


def survivors(width: int, k: int):
    """Scores above the kth and, of those equal to it, the smallest ids; at most k rows per query are kept at a time."""

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        kept = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))]
        if queries.num_rows:
            ids, low = queries["id"].to_numpy(), queries["low"].to_numpy()
            for found, scores in score_blocks(queries, candidates, width):
                rows, places = np.nonzero((scores >= low[:, None]) & (scores != OWN))
                joined = [np.concatenate(x) for x in zip(kept[0], (rows, found[places], scores[rows, places]))]
                order = np.lexsort((joined[1], -joined[2], joined[0]))
                joined = [x[order] for x in joined]
                first = np.searchsorted(joined[0], joined[0])
                kept[0] = tuple(x[np.arange(len(first)) - first < k] for x in joined)
        rows, found, scores = kept[0]
        ids = queries["id"].to_numpy()[rows] if queries.num_rows else rows
        return pa.table(
            {
                "query_id": pa.array(ids, pa.int64()),
                "vec_id": pa.array(found, pa.int64()),
                "score": pa.array(scores, pa.int64()),
            }
        )

    return run
