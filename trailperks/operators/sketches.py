"""Sketches of the activities per period, merged at read time instead of reading the activities again.

A period of any size is a few kilobytes: quantile sketches (KLL), a distinct-count sketch (HLL) and a frequent-items
sketch, as binary columns. A report over any periods merges their sketches; only periods that got new
activities are sketched again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trailperks.sources.layers import Layers

SKETCHES = "analytics.activites_croquis"
MEASURES = ("distance_km", "duree_min")
# Size of a quantile sketch, and the share of all ranks by which it may be off (99 of 100 times; twice the
# normalised rank error that the sketch states for one sided queries at this size).
KLL_K, RANK_ERROR = 400, 0.014
# Binary logarithm of the registers of a distinct-count sketch, and three of its standard errors.
HLL_K, DISTINCT_ERROR = 12, 0.05
# Labels that a frequent-items sketch counts; counts are exact up to three quarters of so many labels.
TRACKED = 1024
PERIOD = "periode"


def sketched(activities: DataFrame, period: Column) -> DataFrame:
    """A row of sketches per period."""
    quantile = [F.kll_sketch_agg_double(F.col(m).cast("double"), KLL_K).alias(f"kll_{m}") for m in MEASURES]
    return activities.groupBy(period.alias(PERIOD)).agg(
        F.count(F.lit(1)).alias("n"), *quantile,
        F.hll_sketch_agg("id_salarie", HLL_K).alias("hll_salaries"),
        F.expr(f"approx_top_k_accumulate(type_activite, {TRACKED})").alias("top_types"),
    )


def refresh(layers: Layers, activities: DataFrame, period: Column, changed: Column | None = None) -> None:
    """Sketch the periods for which ``changed`` holds, by default all, and keep the others."""
    if changed is None or layers.version(SKETCHES) is None:
        rows = sketched(activities, period)
    else:
        # A condition on the period skips the month folders of the mart that hold no such period.
        renewed = sketched(activities.withColumn(PERIOD, period).where(changed), F.col(PERIOD))
        rows = layers.read(SKETCHES).where(~changed).unionByName(renewed)
    layers.reload(SKETCHES, rows)


def merged(sketches: DataFrame) -> DataFrame:
    """The sketches of all given periods as one row."""
    quantile = [F.kll_merge_agg_double(f"kll_{m}", KLL_K).alias(f"kll_{m}") for m in MEASURES]
    return sketches.agg(
        F.sum("n").alias("n"), *quantile, F.hll_union_agg("hll_salaries").alias("hll_salaries"),
        F.expr(f"approx_top_k_combine(top_types, {TRACKED})").alias("top_types"),
    )


def quantile_estimates(one: DataFrame, shares: tuple[float, ...]) -> DataFrame:
    """``mesure, part, n, estimation`` per measure and share."""
    entries = []
    for measure in MEASURES:
        sketch = F.col(f"kll_{measure}")
        entries += [
            F.struct(
                F.lit(measure).alias("mesure"), F.lit(share).alias("part"),
                F.kll_sketch_get_n_double(sketch).alias("n"),
                F.kll_sketch_get_quantile_double(sketch, F.lit(share)).alias("estimation"),
            )
            for share in shares
        ]
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def distinct_estimate(one: DataFrame) -> DataFrame:
    return one.select(F.hll_sketch_estimate("hll_salaries").alias("salaries"))


def top_estimates(one: DataFrame, limit: int) -> DataFrame:
    """``type_activite, n`` of the most frequent labels."""
    top = F.expr(f"approx_top_k_estimate(top_types, {limit})")
    return one.select(F.explode(top).alias("t")).select(
        F.col("t.item").alias("type_activite"), F.col("t.count").alias("n")
    )


def within_rank_error(activities: DataFrame, estimates: DataFrame) -> DataFrame:
    """``mesure, part, n, juste``: whether the estimates lie at ranks near enough, by exact counts."""
    long = activities.select(
        F.explode(F.array(*[
            F.struct(F.lit(m).alias("mesure"), F.col(m).cast("double").alias("valeur")) for m in MEASURES
        ])).alias("e")
    ).select("e.*")
    below, upto = F.count_if(F.col("valeur") < F.col("estimation")), F.count_if(F.col("valeur") <= F.col("estimation"))
    ranked = long.join(estimates, "mesure").groupBy("mesure", "part", "n").agg(
        below.alias("sous"), upto.alias("jusque"), F.count("valeur").alias("lignes")
    )
    share, error = F.col("part"), F.lit(RANK_ERROR)
    near = (F.col("sous") <= (share + error) * F.col("lignes")) & (F.col("jusque") >= (share - error) * F.col("lignes"))
    return ranked.select("mesure", "part", "n", (near & (F.col("n") == F.col("lignes"))).alias("juste"))
