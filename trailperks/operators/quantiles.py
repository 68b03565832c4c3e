"""Exact quantiles without a task that sees all values, and sketches that are merged instead of read again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from trailperks.session import written

QUARTILES = (0.25, 0.5, 0.75)


def quantiles(
    rows: DataFrame, values: dict[str, Column], shares: tuple[float, ...] = QUARTILES, keys: tuple[str, ...] = ()
) -> DataFrame:
    """``keys, colonne, q0, q1, …``: exact quantiles of several columns, optionally per group.

    Equal values are counted first. The counts are sorted into ranges, one task each, and the number of rows
    in the ranges before is a sum over one row per range. So every task knows the ranks of its values,
    and those at the two ranks around a quantile are picked and interpolated. Whatever the number
    of distinct values, no task holds more than its range. A column without a value has no row.
    """
    entries = [
        F.struct(F.lit(name).alias("colonne"), value.cast("double").alias("valeur")) for name, value in values.items()
    ]
    long = rows.select(*keys, F.explode(F.array(*entries)).alias("e")).select(*keys, "e.*")
    group = [*keys, "colonne"]
    counted = long.where("valeur IS NOT NULL").groupBy(*group, "valeur").agg(F.count(F.lit(1)).alias("n"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = counted.repartitionByRange(parts, *group, "valeur").sortWithinPartitions(*group, "valeur")
    # The upper bits of this number are the partition, the lower ones the place in it.
    stored = written(ranges.withColumn("place", F.monotonically_increasing_id()), "quantiles")
    placed = stored.withColumn("tranche", F.shiftright("place", 33))

    inside = Window.partitionBy(*group, "tranche").orderBy("place")
    by_range, all_ranges = Window.partitionBy(*group).orderBy("tranche"), Window.partitionBy(*group)
    totals = placed.groupBy(*group, "tranche").agg(F.sum("n").alias("contenu")).select(
        *[F.col(name).alias(f"__{name}") for name in (*group, "tranche")],
        (F.sum("contenu").over(by_range) - F.col("contenu")).alias("avant"),
        F.sum("contenu").over(all_ranges).alias("total"),
    )
    same = reduce(
        lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in (*group, "tranche")]
    )
    ranked = placed.withColumn("jusque", F.sum("n").over(inside)).join(totals, same)
    last = F.col("avant") + F.col("jusque")

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= last - F.col("n")) & (rank < last), F.col("valeur")))

    picked, shown = [], []
    for number, share in enumerate(shares):
        rank = (F.col("total") - 1) * F.lit(share)
        picked += [
            at(F.floor(rank)).alias(f"lo{number}"), at(F.ceil(rank)).alias(f"hi{number}"),
            F.max(rank - F.floor(rank)).alias(f"f{number}"),
        ]
        low, high = F.col(f"lo{number}"), F.col(f"hi{number}")
        shown.append((low + (high - low) * F.col(f"f{number}")).alias(f"q{number}"))
    return ranked.groupBy(*group).agg(*picked).select(*group, *shown)
