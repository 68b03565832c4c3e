"""Join and count helpers that keep hot keys from landing in one task.

No table is broadcast by hint. Spark compares each side with ``spark.sql.autoBroadcastJoinThreshold``
(and, at run time, with its measured size), so a table that has outgrown the limit is shuffled and
adaptive execution splits its skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def null_safe_left_join(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which a NULL key matches a NULL key."""
    renamed = table.withColumnsRenamed({key: f"__{key}" for key in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"__{key}"))
    return rows.join(renamed, condition, "left").drop(*[f"__{key}" for key in keys])


def count_by(rows: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Row counts per key. Partial counts are made before the shuffle, so a hot key costs no more
    than one row per task."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def orphan_counts(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Keys that have no parent, with their number of rows; NULL keys are no orphans.

    Rows are counted per key first, so the anti-join moves one row per key instead of every row.
    """
    per_key = count_by(rows.where(F.col(key).isNotNull()), key)
    known = parents.select(F.col(parent_key).alias(key))
    return per_key.join(known, key, "left_anti")


def duplicate_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows; NULL keys are left out."""
    present = rows.dropna(subset=list(keys))
    return count_by(present, *keys).where(F.col("n") > 1)
