"""Document fingerprints by consistent weighted sampling, with built-in functions only.

A document is the multiset of its words, between ASCII white space and unchanged, a word's weight being how often it
occurs. For each of ``SAMPLES`` samples a word with weight w draws, from hashes of the word and the sample's number alone, r and
c from a Gamma(2, 1) and b from a uniform distribution; with t = floor(ln w / r + b), its priority is
ln c - r (t - b) - r, and the word with the smallest priority is sampled together with its t. Two documents draw
the same (word, t) with a probability equal to their generalised Jaccard similarity, the sum of smaller weights over
the sum of larger ones. A sample is held in one long: the priority in the upper bits decides the minimum, a hash of (word,
t) in the lower 32 bits is what is compared. So minima of words are combined by hash aggregation.

The edited text of a document needs the beginning of the next one. Neighbours are found on (id, hash, length) only: rows are
split into ranges, numbered inside each range, and only the first row of each range is compared across ranges. Texts are
shuffled once by their key; the words of a document stay in the partition of its text, so counting them needs no shuffle.

Defined results: a null text is empty; an empty text is a multiset of the empty word, so all empty texts agree. Documents
stand in descending order of id, null ids last, rows with one id in descending order of a hash of their text;
identical rows count as one document for this order and all get its result. A single document is its own next one.
Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from trailperks.llm.common import shuffle_partitions
from trailperks.session import cut_lineage

SAMPLES = 32
BLANKS = " \t\n\x0b\f\r"
#: Bits of a priority, and where its range begins: priorities lie well inside (-64, 64).
FINE, LOWEST = 2.0**24, 64.0
NO_ID = -(2**63)


def uniforms(term: Column, number: int) -> list[Column]:
    """Three numbers in (0, 1) from 63 bits of a hash."""
    bits = F.xxhash64(term, F.lit(number))
    mask = F.lit((1 << 21) - 1)
    return [(F.shiftrightunsigned(bits, 21 * n).bitwiseAND(mask) + F.lit(0.5)) / F.lit(2.0**21) for n in range(3)]


def sample(term: Column, log_weight: Column, number: int) -> Column:
    """Priority (upper bits) and identity (lower 32 bits) of a word in one sample."""
    u = uniforms(term, 2 * number) + uniforms(term, 2 * number + 1)
    r, c, b = -F.ln(u[0] * u[1]), -F.ln(u[2] * u[3]), u[4]
    t = F.floor(log_weight / r + b)
    priority = F.ln(c) - r * (t - b) - r
    place = F.greatest(F.lit(0.0), F.least((priority + F.lit(LOWEST)) * F.lit(FINE), F.lit(2.0**31 - 1))).cast("long")
    identity = F.xxhash64(term, t, F.lit(number)).bitwiseAND(F.lit(2**32 - 1))
    return F.shiftleft(place, 32).bitwiseOR(identity)


def signatures(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, samples): a row per key; ``texts`` has one row per key."""
    words = F.split(F.btrim(F.col(text), F.lit(BLANKS)), r"[\x20\x09-\x0D]+")
    counted = (
        texts.select(*keys, F.explode(words).alias("word"))
        .select(*keys, F.xxhash64("word").alias("term"))
        .groupBy(*keys, "term")
        .agg(F.count("*").alias("weight"))
        .withColumn("log_weight", F.ln(F.col("weight").cast("double")))
    )
    lanes = [
        F.min(sample(F.col("term"), F.col("log_weight"), n)).bitwiseAND(F.lit(2**32 - 1)).alias(f"lane{n}") for n in range(SAMPLES)
    ]
    return counted.groupBy(*keys).agg(*lanes).select(*keys, F.array(*[F.col(f"lane{n}") for n in range(SAMPLES)]).alias("samples"))


def written(samples: Column) -> Column:
    return F.lower(F.array_join(F.transform(samples, lambda lane: F.lpad(F.hex(lane), 8, "0")), ""))


def likeness(left: Column, right: Column) -> Column:
    """The share of equal samples."""
    equal = [(F.element_at(left, n + 1) == F.element_at(right, n + 1)).cast("int") for n in range(SAMPLES)]
    return sum(equal[1:], equal[0]) / F.lit(float(SAMPLES))


def neighbours(keys: DataFrame) -> DataFrame:
    """(ord, mark, next_ord, next_mark) of distinct keys in descending order; after the last comes the first."""
    spark = keys.sparkSession
    ranged = cut_lineage(
        keys.select("ord", "mark")
        .repartitionByRange(shuffle_partitions(spark), F.desc("ord"), F.desc("mark"))
        .withColumn("range", F.spark_partition_id())
    )
    within = Window.partitionBy("range").orderBy(F.desc("ord"), F.desc("mark"))
    following = F.lead(F.struct(F.col("ord"), F.col("mark"))).over(within)
    # One row per range: few, whatever the size of the table.
    firsts = ranged.groupBy("range").agg(F.max(F.struct("ord", "mark")).alias("first"))
    across = Window.partitionBy(F.lit(0)).orderBy("range")
    whole = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select("range", F.coalesce(F.lead("first").over(across), F.first("first").over(whole)).alias("after"))
    return (
        ranged.withColumn("following", following)
        .join(after, "range")
        .withColumn("next", F.coalesce("following", "after"))
        .select("ord", "mark", F.col("next.ord").alias("next_ord"), F.col("next.mark").alias("next_mark"))
    )


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next): a row per document."""
    plain = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("ord"),
        F.xxhash64(F.col(doc_id).isNull(), plain).alias("mark"),
        F.col(doc_id).isNull().alias("no_id"),
        plain.alias("text"),
    )
    keys = cut_lineage(
        source.groupBy("ord", "mark").agg(
            F.count("*").alias("copies"), F.max(F.length("text")).alias("n_chars"), F.max("no_id").alias("no_id")
        )
    )
    texts = source.select("ord", "mark", "text")
    if keys.where("copies > 1").limit(1).count():
        texts = texts.dropDuplicates(["ord", "mark"])
    order = cut_lineage(neighbours(keys).join(keys, ["ord", "mark"]))
    cut = F.floor(F.col("n_chars") / 2).cast("int")
    beginnings = texts.withColumnsRenamed({"ord": "next_ord", "mark": "next_mark", "text": "next_text"}).join(
        order.select("ord", "mark", "next_ord", "next_mark", "n_chars"), ["next_ord", "next_mark"]
    )
    both = texts.join(
        beginnings.select("ord", "mark", "n_chars", F.left(F.col("next_text"), cut).alias("beginning")), ["ord", "mark"]
    ).select(
        "ord", "mark", "text", F.concat(F.left(F.col("text"), F.col("n_chars") - cut), F.col("beginning")).alias("edited")
    )
    versions = both.select(
        "ord",
        "mark",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("version"), F.col("text").alias("body")),
                F.struct(F.lit(1).alias("version"), F.col("edited").alias("body")),
            )
        ).alias("v"),
    ).select("ord", "mark", "v.version", "v.body")
    signed = signatures(versions, ["ord", "mark", "version"], "body")
    paired = signed.groupBy("ord", "mark").agg(
        F.max(F.when(F.col("version") == 0, F.col("samples"))).alias("samples"),
        F.max(F.when(F.col("version") == 1, F.col("samples"))).alias("edited"),
    )
    digests = both.select("ord", "mark", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"))
    signed = cut_lineage(paired.join(digests, ["ord", "mark"]))
    next_ones = signed.select(
        F.col("ord").alias("next_ord"), F.col("mark").alias("next_mark"), F.col("samples").alias("next_samples")
    )
    return (
        order.join(signed, ["ord", "mark"])
        .join(next_ones, ["next_ord", "next_mark"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(
            F.when(~F.col("no_id"), F.col("ord")).alias("doc_id"),
            F.col("n_chars").cast("long").alias("n_chars"),
            "edited_sha256",
            written(F.col("samples")).alias("fingerprint"),
            written(F.col("edited")).alias("edited_fingerprint"),
            likeness(F.col("samples"), F.col("edited")).alias("near_edited"),
            likeness(F.col("samples"), F.col("next_samples")).alias("near_next"),
        )
    )
