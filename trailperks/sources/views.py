"""The tables and rules for users of SQL: staging views over the newest version, and the rules as SQL functions.

Everything is temporary, so it lives in the session only and needs no catalog. Functions are expanded into the
plan of a query, like the columns of the package, and a query over the views is planned as one.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from trailperks import labels as L
from trailperks.operators import staging
from trailperks.params import Params

MONEY = "DECIMAL(18,2)"


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _cases(column: str, pairs: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {quoted(k)} THEN {v}" for k, v in pairs.items()) + " END"


def functions(params: Params) -> dict[str, str]:
    """Name -> arguments, type and body of each rule."""
    bands = " ".join(f"WHEN age < {limit} THEN {quoted(label)}" for limit, label in L.AGE_BANDS)
    modes = {mode: quoted(code) for mode, code in L.ROUTE_MODES.items()}
    limits = {"WALK": params.seuil_marche_km, "BICYCLE": params.seuil_velo_km}
    numbers = {code: f"CAST({value} AS DECIMAL(18,6))" for code, value in limits.items()}
    active = ", ".join(quoted(mode) for mode in L.ROUTE_MODES)
    days = f"CAST({params.nb_jours_bien_etre} AS DECIMAL(15,6))"
    worked = f"CAST({params.jours_travailles_an} AS DECIMAL(15,6))"
    return {
        "tranche_age": f"(age INT) RETURNS STRING RETURN CASE {bands} ELSE {quoted(L.AGE_BAND_LAST)} END",
        "trajet_sportif": f"(mode STRING) RETURNS BOOLEAN RETURN mode IN ({active})",
        "mode_api": f"(mode STRING) RETURNS STRING RETURN {_cases('mode', modes)}",
        "seuil_trajet_km": f"(mode_api STRING) RETURNS DECIMAL(18,6) RETURN {_cases('mode_api', numbers)}",
        "statut_declaration": (
            "(sportif BOOLEAN, a_jour BOOLEAN, km DECIMAL(18,1), seuil DECIMAL(18,6)) RETURNS STRING RETURN "
            f"CASE WHEN NOT sportif THEN {quoted(L.NOT_CONCERNED)} WHEN NOT a_jour THEN {quoted(L.NOT_VERIFIED)} "
            f"WHEN km <= seuil THEN {quoted(L.COMPLIANT)} ELSE {quoted(L.SUSPECT)} END"
        ),
        "montant_prime": (
            f"(statut STRING, salaire INT) RETURNS {MONEY} RETURN CASE WHEN statut = {quoted(L.COMPLIANT)} "
            f"THEN round(CAST(salaire AS DECIMAL(12,0)) * CAST({params.taux_prime} AS DECIMAL(21,12)), 2) ELSE 0 END"
        ),
        "bien_etre_acquis": (
            "(activites BIGINT) RETURNS BOOLEAN "
            f"RETURN activites >= CAST({params.nb_activites_min} AS DECIMAL(18,6))"
        ),
        "jours_bien_etre": (
            "(activites BIGINT) RETURNS DECIMAL(18,6) "
            f"RETURN CASE WHEN activites >= CAST({params.nb_activites_min} AS DECIMAL(18,6)) THEN {days} ELSE 0 END"
        ),
        "cout_bien_etre": (
            f"(activites BIGINT, salaire INT) RETURNS {MONEY} RETURN CASE WHEN activites >= "
            f"CAST({params.nb_activites_min} AS DECIMAL(18,6)) "
            f"THEN round(CAST(salaire AS DECIMAL(10,0)) * {days} / {worked}, 2) ELSE 0 END"
        ),
    }


def create_functions(spark: SparkSession, params: Params) -> None:
    """The rules with these parameters as temporary functions of the session."""
    for name, rest in functions(params).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{rest}")


def create_views(raw: dict[str, DataFrame], as_of: date) -> None:
    """Temporary views: the given raw tables as ``raw_<name>``, and their staging models as ``stg_<name>``."""
    models = {
        "salaries": staging.staged_salaries(raw["salaries"], as_of),
        "sports": staging.staged_sports(raw["sports"]),
        "distances": staging.staged_distances(raw["distances"]),
        "activites": staging.staged_activities(raw["activites"], raw["vitesses_max"]),
    }
    for prefix, frames in (("raw", raw), ("stg", models)):
        for name, frame in frames.items():
            frame.createOrReplaceTempView(f"{prefix}_{name}")
