"""Report measures and the grouped series behind the report's visuals."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from trailperks import labels as L
from trailperks.functions import rules
from trailperks.functions.numbers import share

TO_VERIFY = (L.SUSPECT, L.NOT_VERIFIED)
NEAR_MISS = 5


def measures(benefits: DataFrame, minimum: int) -> DataFrame:
    """Cost, headcount and eligibility measures over the selected employees, as one row."""
    rows = F.count(F.lit(1))
    bonus, wellness = F.sum("montant_prime"), F.sum("cout_bien_etre")
    eligible = F.count_if("eligible_bien_etre")
    near = (F.col("nb_activites") >= minimum - NEAR_MISS) & (F.col("nb_activites") < minimum)
    return benefits.agg(
        bonus.alias("cout_prime"),
        wellness.alias("cout_bien_etre"),
        (bonus + wellness).alias("cout_total"),
        rows.alias("nb_salaries"),
        F.count_if("pratique_declaree").alias("nb_sportifs_declares"),
        F.count_if("trajet_sportif").alias("nb_trajets_sportifs"),
        F.count_if("eligible_prime").alias("nb_eligibles_prime"),
        eligible.alias("nb_eligibles_bien_etre"),
        share(eligible, rows).alias("part_eligibles_bien_etre"),
        F.count_if(F.col("statut_declaration").isin(*TO_VERIFY)).alias("declarations_a_verifier"),
        F.count_if(near).alias("proches_du_seuil"),
    )


def activity_measures(activities: DataFrame) -> DataFrame:
    """Number and total distance of the valid activities."""
    return activities.where("est_valide").agg(
        F.count(F.lit(1)).alias("nb_activites_valides"),
        F.sum("distance_km").alias("distance_totale_km"),
    )


def monitoring(runs: DataFrame, checks: DataFrame, now: datetime) -> DataFrame:
    """Newest run end, failed steps of the last seven days, open findings of the last check run."""
    newest = checks.agg(F.max("verifie_le")).scalar()
    open_findings = checks.where(
        (F.col("verifie_le") == newest) & (F.col("resultat") != L.CHECK_PASS)
    ).agg(F.count(F.lit(1)))
    recent = F.col("debut") >= F.lit(now - timedelta(days=7))
    return runs.agg(
        F.max("fin").alias("derniere_execution"),
        F.count_if((F.col("statut") == L.RUN_FAILED) & recent).alias("etapes_en_echec"),
    ).withColumn("controles_non_conformes", open_findings.scalar())


def cost_by_unit(benefits: DataFrame) -> DataFrame:
    return benefits.groupBy("bu").agg(
        (F.sum("montant_prime") + F.sum("cout_bien_etre")).alias("cout_total")
    )


def status_by_mode(benefits: DataFrame) -> DataFrame:
    """Employees per travel mode, one column per declaration status."""
    counted = benefits.groupBy("moyen_deplacement").pivot(
        "statut_declaration", list(L.DECLARATION_STATUSES)
    )
    return counted.count().na.fill(0)


def declarations_to_check(benefits: DataFrame) -> DataFrame:
    return benefits.where(F.col("statut_declaration").isin(*TO_VERIFY)).select(
        "id_salarie", "bu", "moyen_deplacement", "distance_km", "seuil_km", "statut_declaration"
    )


def commute_points(benefits: DataFrame) -> DataFrame:
    """Distance and limit of each active commuter."""
    return benefits.where(F.col("statut_declaration") != L.NOT_CONCERNED).select(
        "id_salarie", "distance_km", "seuil_km", "statut_declaration"
    )


def valid_by(activities: DataFrame, *keys: str) -> DataFrame:
    """Valid activities per key combination."""
    counted = activities.where("est_valide").groupBy(*keys)
    return counted.agg(F.count(F.lit(1)).alias("nb_activites_valides"))


def valid_by_weekday(activities: DataFrame) -> DataFrame:
    """Valid activities per weekday, Monday first."""
    return (
        valid_by(activities, "jour_semaine")
        .withColumn("jour", rules.weekday_label(F.col("jour_semaine")))
        .orderBy("jour_semaine")
    )


def employees_by_count(benefits: DataFrame, width: int = 1) -> DataFrame:
    """Employees per number of activities, in bins of ``width``, split by eligibility."""
    lower: Column = F.floor(F.col("nb_activites") / width).cast("long") * width
    return (
        benefits.withColumn("nb_activites_min", lower)
        .groupBy("nb_activites_min", "eligible_bien_etre")
        .agg(F.count(F.lit(1)).alias("nb_salaries"))
    )


def sliced_employees(benefits: DataFrame, **slicers: str) -> DataFrame:
    """Ids of the employees that match the slicers."""
    selected = benefits
    for column, value in slicers.items():
        selected = selected.where(F.col(column) == value)
    return selected.select("id_salarie")


def sliced_activities(activities: DataFrame, benefits: DataFrame, **slicers: str) -> DataFrame:
    """Activities of the employees that match the slicers; the filter flows one way only."""
    return activities.join(sliced_employees(benefits, **slicers), "id_salarie", "left_semi")


def sliced_valid_by(
    activities: DataFrame, benefits: DataFrame, keys: list[str], **slicers: str
) -> DataFrame:
    """Valid activities per key for the selected employees.

    Activities are counted per employee and key before the filter meets them, so rows of single
    activities never move.
    """
    counted = valid_by(activities, "id_salarie", *keys)
    selected = counted.join(sliced_employees(benefits, **slicers), "id_salarie", "left_semi")
    return selected.groupBy(*keys).agg(
        F.sum("nb_activites_valides").alias("nb_activites_valides")
    )
