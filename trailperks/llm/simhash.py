"""SimHash near-duplicates with pivot distance tables.

Fingerprint: each bit is set if it is set in over half of the XXH64 hashes (seed 42) of a text's word shingles.
Two fingerprints are linked if they differ in at most ``max_bits`` (1 or 2) bits; linked fingerprints form
components.

Search works on distinct fingerprints, so exact copies cost nothing. For each the Hamming distances to ``PIVOTS``
reference fingerprints are tabulated. Candidates are fingerprints that agree on two of four 16-bit segments, as any
two within two bits must. By the triangle inequality a pair is discarded if any coordinate of its distance tables
differs by more than ``max_bits``; survivors are verified by their bit distance.

Segment buckets over ``BUCKET`` members are not paired: their members are joined through the fingerprints at most one bit
away from each (two fingerprints within two bits share one). That search is exact, linear in the members, and
its groups hold at most 65 fingerprints, however many copies gather.

Defined results: a null text is empty; no word gives fingerprint zero, linked like any other; fewer words than a
shingle form one shingle. Repeated rows keep their rows. A null id belongs to its component but does not name it; a
component of null ids only has a null id. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from trailperks.llm.common import binary_list, slices, small_batches
from trailperks.session import cut_lineage

SEED = 42
PIVOTS = 16
SEGMENT = 16
BUCKET = 256


def fingerprints_of(texts: list[bytes], shingle: int) -> np.ndarray:
    """Fingerprints of UTF-8 texts."""
    digest, hashes, firsts, filled = xxhash.xxh64_intdigest, [], [], []
    for row, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        filled.append(row)
        firsts.append(len(hashes))
        joined = b" ".join(words)
        if len(words) <= shingle:
            hashes.append(digest(joined, SEED))
            continue
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        begins = ends - lengths
        hashes.extend(
            [digest(joined[a:b], SEED) for a, b in zip(begins[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())]
        )
    out = np.zeros(len(texts), np.uint64)
    if filled:
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        totals = np.diff(np.append(firsts, len(hashes)))
        ones = np.add.reduceat(bits, firsts, axis=0, dtype=np.int64)
        out[filled] = np.packbits(2 * ones > totals[:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, mark, fp): a row per document; mark is a hash of its text, fp the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column(1), 2**20):
                part = batch.slice(begin, end - begin)
                found = pa.array(fingerprints_of(binary_list(part.column(1)), shingle).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), found], names=["doc_id", "mark", "fp"])

    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), text_mark(F.col(text)).alias("mark")).mapInArrow(
        run, f"doc_id {kind}, mark long, fp long"
    )


def text_mark(text: Column) -> Column:
    return F.xxhash64(F.lit(5), text)


def reference_fingerprints() -> list[int]:
    return [xxhash.xxh64_intdigest(n.to_bytes(8, "little"), SEED) - 2**63 for n in range(PIVOTS)]


def distance_table(fp: Column) -> Column:
    """Hamming distances to the reference fingerprints."""
    return F.array(*[F.bit_count(fp.bitwiseXOR(F.lit(pivot))).cast("byte") for pivot in reference_fingerprints()])


def segment_keys(fp: Column) -> Column:
    """One key for each two of the four segments."""
    mask = (1 << SEGMENT) - 1
    parts = [F.shiftrightunsigned(fp, SEGMENT * n).bitwiseAND(F.lit(mask)) for n in range(4)]
    pairs = [(a, b) for a in range(4) for b in range(a)]
    return F.array(
        *[
            F.shiftleft(parts[a], SEGMENT).bitwiseOR(parts[b]).bitwiseOR(F.lit(n << (2 * SEGMENT)))
            for n, (a, b) in enumerate(pairs)
        ]
    )


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): enough pairs of distinct fingerprints within ``max_bits`` to connect all that are."""
    if max_bits not in (1, 2):
        raise ValueError("links are defined for 1 or 2 differing bits")
    keyed = distinct.select("fp", F.explode(segment_keys(F.col("fp"))).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    members = cut_lineage(keyed.join(shared, "key"))
    usual = members.where(F.col("members") <= BUCKET).select("key", "fp", distance_table(F.col("fp")).alias("table"))
    left = usual.select("key", F.col("fp").alias("a"), F.col("table").alias("table_a"))
    right = usual.select("key", F.col("fp").alias("b"), F.col("table").alias("table_b"))
    apart = F.greatest(*[F.abs(F.col("table_a")[n] - F.col("table_b")[n]) for n in range(PIVOTS)])
    near = (
        left.join(right, "key")
        .where((F.col("a") < F.col("b")) & (apart <= max_bits))
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        .select("a", "b")
    )
    crowded = members.where(F.col("members") > BUCKET).select("fp").distinct()
    around = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit((1 << n) - (1 << 64 if n == 63 else 0))) for n in range(64)])
    balls = crowded.select("fp", F.explode(around).alias("centre")).groupBy("centre").agg(F.collect_set("fp").alias("ball"))
    hub = F.array_min("ball") if max_bits == 2 else F.when(F.array_contains("ball", F.col("centre")), F.col("centre"))
    stars = balls.where(F.size("ball") > 1).select(hub.alias("a"), F.explode("ball").alias("b")).where("a is not null and a <> b")
    return near.union(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, by alternating large and small stars until nothing changes."""

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.union(pairs.select("b", "a")) if large else pairs.select(F.greatest("a", "b"), F.least("a", "b"))
        both = both.toDF("node", "near")
        least = both.groupBy("node").agg(F.min("near").alias("least")).select("node", F.least("node", "least").alias("root"))
        joined = both.join(least, "node")
        if large:
            return joined.where("near > node").select(F.col("near").alias("a"), F.col("root").alias("b")).where("a <> b").distinct()
        spread = joined.select(F.col("near").alias("a"), F.col("root").alias("b"))
        return spread.union(least.select("node", "root")).where("a <> b").distinct()

    state = cut_lineage(edges.select("a", "b").where("a <> b").distinct())
    before = None
    while True:
        summary = state.agg(F.count("*"), F.sum(F.xxhash64(F.greatest("a", "b"), F.least("a", "b")).cast("decimal(38,0)"))).first()
        if summary == before or not summary[0]:
            break
        before = summary
        state = cut_lineage(star(star(state, True), False))
    return state.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, mark, fp, root, component_id): a row per document; root is the smallest fingerprint of its component."""
    found = cut_lineage(fingerprints(docs, shingle, doc_id, text))
    distinct = cut_lineage(found.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    roots = components(links(distinct, max_bits))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = rooted.select("fp", "root").join(named, "root").select("fp", "root", "component_id")
    return found.join(classes, "fp").select("doc_id", "mark", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the smallest id of each component, with all its columns; a null id stays only if all are null."""
    found = near_duplicates(docs, shingle, max_bits, doc_id, text)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")).alias("first")
    kept = found.groupBy("root").agg(first).select(F.col("first.doc_id").alias("kept_id"), F.col("first.mark").alias("kept_mark"))
    matches = docs[doc_id].eqNullSafe(kept["kept_id"]) & (text_mark(docs[text]) == kept["kept_mark"])
    chosen = docs.join(kept, matches, "left_semi")
    # Only rows that agree in id and text can still stand twice.
    repeated = docs.groupBy(F.col(doc_id), text_mark(F.col(text)).alias("mark")).count().where("count > 1").limit(1).count()
    if not repeated:
        return chosen
    rows = chosen.select(F.struct("*").alias("row"), F.col(doc_id).alias("kept_id"), text_mark(F.col(text)).alias("kept_mark"))
    return rows.groupBy("kept_id", "kept_mark").agg(F.first("row").alias("row")).select("row.*")
