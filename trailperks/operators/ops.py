"""Operational reports over layer tables, the run log and the check history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from trailperks import labels as L
from trailperks.functions.numbers import round_ratio


def ingestion_volumes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, source file and load time per ingested table; NULL where a table has no such column."""
    parts = []
    for name, table in tables.items():
        file = F.max("fichier_source") if "fichier_source" in table.columns else F.lit(None)
        loaded = F.max("charge_le") if "charge_le" in table.columns else F.lit(None)
        parts.append(
            table.agg(
                F.count(F.lit(1)).alias("lignes"),
                file.cast("string").alias("fichier"),
                loaded.cast("timestamp").alias("charge_le"),
            ).withColumn("objet", F.lit(name))
        )
    return reduce(DataFrame.unionByName, parts)


def layer_volumes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, and valid rows where the table has a validity flag."""
    parts = []
    for name, table in tables.items():
        valid = F.count_if("est_valide") if "est_valide" in table.columns else F.lit(None)
        parts.append(
            table.agg(F.count(F.lit(1)).alias("lignes"), valid.cast("long").alias("valides"))
            .withColumn("objet", F.lit(name))
        )
    return reduce(DataFrame.unionByName, parts)


def distances_by_mode_status(distances: DataFrame) -> DataFrame:
    """Trips, average and longest distance per mode and service status."""
    count, total = F.count("distance_m"), F.sum("distance_m")
    return distances.groupBy("mode_api", "statut").agg(
        F.count(F.lit(1)).alias("trajets"),
        round_ratio(total, count * 1000, 1).alias("km_moyen"),
        round_ratio(F.max("distance_m"), 1000, 1).alias("km_max"),
        F.max("calcule_le").alias("calcule_le"),
    )


def recent_runs(runs: DataFrame, limit: int = 8) -> DataFrame:
    """Newest log rows without the loader's, whose batches would fill the list."""
    return (
        runs.where(F.col("etape") != L.LOADER_STEP)
        .orderBy(F.desc("fin"), F.desc("id_run"))
        .limit(limit)
    )


def recent_findings(checks: DataFrame, limit: int = 10) -> DataFrame:
    """Newest check outcomes that did not pass."""
    return (
        checks.where(F.col("resultat") != L.CHECK_PASS)
        .orderBy(F.desc("verifie_le"), "table_verifiee", "controle", "valeur", "fichier_controle",
                 "resultat")
        .limit(limit)
    )


def runs_summary(runs: DataFrame) -> DataFrame:
    """Executions, rows and newest end per step and status."""
    return runs.groupBy("etape", "statut").agg(
        F.count(F.lit(1)).alias("executions"),
        F.sum("nb_lignes").alias("lignes"),
        F.max("fin").alias("derniere"),
    )


def rows_by_step(runs: DataFrame) -> DataFrame:
    return runs.groupBy("etape").agg(F.sum("nb_lignes").alias("lignes"))
