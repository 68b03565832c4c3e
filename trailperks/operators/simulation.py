"""Calendars, weighted draws and controlled errors over the stored tables."""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from trailperks import labels as L
from trailperks.functions import text
from trailperks.functions.sampling import uniform

WEEKEND_FACTOR, WEEKDAY_FACTOR = 1.5, 0.8
SEASON_SWING, SEASON_PEAK_MONTH = 0.25, 6
DECLARED_WEIGHT, OTHER_WEIGHT = 4, 1
ABSURD_FACTOR = 100


def _employed(salaries: DataFrame, end: date) -> DataFrame:
    return salaries.where(F.col("date_embauche") <= F.lit(end))


def _days(start: date, end: date) -> Column:
    """The days from the later of ``start`` and hiring to ``end``."""
    return F.sequence(F.greatest(F.lit(start), F.col("date_embauche")), F.lit(end))


def employee_calendar(salaries: DataFrame, start: date, end: date) -> DataFrame:
    """One row per employee and day, from the later of ``start`` and hiring to ``end``."""
    return _employed(salaries, end).select("id_salarie", F.explode(_days(start, end)).alias("jour"))


def activity_calendar(
    salaries: DataFrame, activities: DataFrame, start: date, end: date
) -> DataFrame:
    """Activities per employee and day, days without any included.

    Counts travel to their employee as one map, with an entry per active day at most; the days are
    unfolded after the join, so the full calendar is never shuffled.
    """
    counted = (
        activities.where(F.col("date_activite").between(F.lit(start), F.lit(end)))
        .groupBy("id_salarie", "date_activite")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("id_salarie")
        .agg(F.map_from_entries(F.collect_list(F.struct("date_activite", "n"))).alias("par_jour"))
    )
    joined = _employed(salaries, end).join(counted, "id_salarie", "left")
    unfolded = joined.select("id_salarie", "par_jour", F.explode(_days(start, end)).alias("jour"))
    count = F.coalesce(F.col("par_jour")[F.col("jour")], F.lit(0).cast("long"))
    return unfolded.select("id_salarie", "jour", count.alias("nb_activites"))


def expected_index(day: Column) -> Column:
    """Relative activity expected on a day: more on weekends and in summer."""
    week = F.when(F.weekday(day) >= 5, WEEKEND_FACTOR).otherwise(WEEKDAY_FACTOR)
    phase = 2 * math.pi * (F.month(day) - SEASON_PEAK_MONTH) / 12
    return week * (1 + SEASON_SWING * F.cos(phase))


def weighted_sample(employees: DataFrame, n: int, seed: str) -> DataFrame:
    """``n`` employees without replacement; a declared sport weighs four times as much.

    Each row gets an exponential key of its weight; the smallest keys win. Only ``n`` rows per task
    leave the scan.
    """
    weight = F.when(F.col("sport").isNotNull(), DECLARED_WEIGHT).otherwise(OTHER_WEIGHT)
    key = -F.log(uniform(F.col("id_salarie"), seed)) / weight
    return employees.withColumn("cle", key).orderBy("cle", "id_salarie").limit(n).drop("cle")


def inject_anomalies(activities: DataFrame, rate: float, seed: str) -> DataFrame:
    """Spoil a share of the activities: negative distance, absurd distance or swapped dates.

    Activities without a distance always get swapped dates.
    """
    hit = uniform(F.col("id_activite"), seed) < rate
    kind = F.floor(uniform(F.col("id_activite"), f"{seed}-kind") * 3)
    metres = F.col("distance_m")
    has_distance = F.coalesce(metres != 0, F.lit(False))
    negative = hit & has_distance & (kind == 0)
    absurd = hit & has_distance & (kind == 1)
    swapped = hit & ~negative & ~absurd
    return activities.withColumns({
        "distance_m": F.when(negative, -metres).when(absurd, metres * ABSURD_FACTOR)
        .otherwise(metres),
        "date_debut": F.when(swapped, F.col("date_fin")).otherwise(F.col("date_debut")),
        "date_fin": F.when(swapped, F.col("date_debut")).otherwise(F.col("date_fin")),
    })


def activity_vs_declared_sport(activities: DataFrame, sports: DataFrame) -> DataFrame:
    """Activities per declared sport and recorded type, and whether the type belongs to the sport.

    Activities are counted per employee and type before they meet the declarations.
    """
    counted = activities.groupBy("id_salarie", "type_activite").agg(F.count(F.lit(1)).alias("n"))
    sport = F.nullif(text.strip_blanks(F.col("pratique_sport")), F.lit(""))
    declared = sports.select("id_salarie", sport.alias("sport"))
    kind = F.col("type_activite")
    fits = kind.isin(*L.OCCASIONAL_ACTIVITIES)
    for label, kinds in L.DECLARED_SPORT_ACTIVITIES.items():
        fits = F.when(F.col("sport") == label, kind.isin(*kinds)).otherwise(fits)
    return (
        counted.join(declared, "id_salarie", "left")
        .groupBy("sport", "type_activite", fits.alias("conforme"))
        .agg(F.sum("n").alias("n"))
    )
