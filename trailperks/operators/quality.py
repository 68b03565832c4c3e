"""Data-quality checks: all aggregate checks of a table share one scan.

A check measures one value and compares it with a fail and a warn limit. ``evaluate`` returns the
outcomes as a DataFrame; ``gate`` decides whether a run may go on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime
from decimal import Decimal
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from trailperks import labels as L
from trailperks.functions import rules
from trailperks.operators.keys import KeyCounts, Measure
from trailperks.params import small_table

Limit = Callable[[Column], Column]
Tables = dict[str, DataFrame]


def above(bound: float) -> Limit:
    return lambda value: value > bound


def below(bound: float) -> Limit:
    return lambda value: value < bound


def other_than(bound: float) -> Limit:
    return lambda value: value != bound


@dataclass(frozen=True)
class Check:
    """One check. ``measure`` builds an aggregate over its table; ``unique`` (a key), ``parent`` (key,
    table, key) and ``same_rows_as`` (a table) are read off the counts that all such checks share.
    ``required`` only looks at the schema."""

    layer: str
    table: str
    name: str
    measure: Callable[[], Column] | None = None
    unique: str | None = None
    parent: tuple[str, str, str] | None = None
    same_rows_as: str | None = None
    required: tuple[str, ...] = ()
    fail: Limit | None = None
    warn: Limit | None = None

    def outcome(self, value: Column) -> Column:
        """fail before warn before pass; a value that could not be measured is an error."""
        result = F.when(value.isNull(), L.CHECK_ERROR)
        if self.fail is not None:
            result = result.when(self.fail(value), L.CHECK_FAIL)
        if self.warn is not None:
            result = result.when(self.warn(value), L.CHECK_WARN)
        return result.otherwise(L.CHECK_PASS)


# --- measures ---------------------------------------------------------------------------------

def row_count() -> Column:
    return F.count(F.lit(1))


def missing(column: str) -> Callable[[], Column]:
    return lambda: F.count_if(F.col(column).isNull())


def smallest(column: str) -> Callable[[], Column]:
    return lambda: F.min(column)


def unlisted(column: str, values: Iterable[str]) -> Callable[[], Column]:
    """Rows with a value outside the list; NULL is missing, not invalid."""
    return lambda: F.count_if(~F.col(column).isin(*values))


def out_of_range(column: str, low: object, high: object) -> Callable[[], Column]:
    return lambda: F.count_if(~F.col(column).between(low, high))


def percent_out_of_range(column: str, low: object, high: object) -> Callable[[], Column]:
    bad = out_of_range(column, low, high)
    return lambda: F.coalesce(
        F.try_divide(F.lit(100.0) * bad(), row_count().cast("double")), F.lit(0.0)
    )


def age_ms(column: str, as_of: datetime) -> Callable[[], Column]:
    """Milliseconds between the newest value and ``as_of``."""
    return lambda: (F.unix_micros(F.lit(as_of)) - F.unix_micros(F.max(column))) / 1000


def inconsistent_dates() -> Column:
    """Activities that end before they start, or last a day or longer."""
    micros = rules.elapsed_us(F.col("date_debut"), F.col("date_fin"))
    return F.count_if((micros <= 0) | (micros >= L.MAX_DURATION_S * 1_000_000))


def implausible_speeds() -> Column:
    """Activities faster than their sport allows, whatever their duration or distance."""
    micros = rules.elapsed_us(F.col("date_debut"), F.col("date_fin"))
    limit = F.col("vitesse_max_kmh")
    moving = (F.col("distance_m") > 0) & (micros > 0) & limit.isNotNull()
    return F.count_if(moving & rules.faster_than(F.col("distance_m"), micros, limit))


DAY_MS = 24 * 3600 * 1000


def standard_checks(as_of: datetime) -> list[Check]:
    """The 35 checks of the three layers."""
    raw, geo, analytics = "raw", "geo", "analytics"
    activities, people, sports = "activites", "salaries", "sports"
    commutes, benefits = "distances_domicile_travail", "avantages_salaries"
    kpi, parameters = "kpi_synthese", "parametres"
    return [
        Check(raw, activities, "table non vide", row_count, fail=below(1)),
        Check(raw, activities, "fraîcheur du chargement", age_ms("charge_le", as_of),
              warn=above(DAY_MS), fail=above(7 * DAY_MS)),
        Check(raw, activities, "id_activite unique", unique="id_activite", fail=above(0)),
        Check(raw, activities, "id_salarie renseigné", missing("id_salarie"), fail=above(0)),
        Check(raw, activities, "salarié connu", parent=("id_salarie", people, "id_salarie"),
              fail=above(0)),
        Check(raw, activities, "% de distances hors bornes",
              percent_out_of_range("distance_m", 0, L.MAX_DISTANCE_M), warn=above(0), fail=above(1)),
        Check(raw, activities, "dates incohérentes", inconsistent_dates,
              warn=above(0), fail=above(50)),
        Check(raw, activities, "vitesses implausibles", implausible_speeds,
              warn=above(0), fail=above(50)),
        Check(raw, activities, "type d'activité inconnu",
              unlisted("type_activite", L.ACTIVITY_TYPES), warn=above(0)),
        Check(raw, people, "table non vide", row_count, fail=below(1)),
        Check(raw, people, "colonnes attendues", required=(
            "id_salarie", "date_embauche", "salaire_brut", "adresse", "moyen_deplacement"),
            fail=above(0)),
        Check(raw, people, "id_salarie unique", unique="id_salarie", fail=above(0)),
        Check(raw, people, "salaire renseigné", missing("salaire_brut"), fail=above(0)),
        Check(raw, people, "plus petit salaire", smallest("salaire_brut"), fail=below(1)),
        Check(raw, people, "adresse renseignée", missing("adresse"), fail=above(0)),
        Check(raw, people, "moyen de déplacement inconnu",
              unlisted("moyen_deplacement", L.TRAVEL_MODES), fail=above(0)),
        Check(raw, people, "type de contrat inconnu",
              unlisted("type_contrat", L.CONTRACT_TYPES), fail=above(0)),
        Check(raw, people, "embauches futures",
              lambda: F.count_if(F.col("date_embauche") > F.lit(as_of.date())), fail=above(0)),
        Check(raw, sports, "autant de lignes que de salariés", same_rows_as=people,
              fail=other_than(0)),
        Check(raw, sports, "id_salarie unique", unique="id_salarie", fail=above(0)),
        Check(geo, commutes, "table non vide", row_count, fail=below(1)),
        Check(geo, commutes, "id_salarie unique", unique="id_salarie", fail=above(0)),
        Check(geo, commutes, "itinéraire non trouvé", unlisted("statut", (L.ROUTE_FOUND,)),
              warn=above(0)),
        Check(geo, commutes, "distance manquante", missing("distance_m"), warn=above(0)),
        Check(geo, commutes, "fraîcheur du calcul", age_ms("calcule_le", as_of),
              warn=above(90 * DAY_MS)),
        Check(analytics, benefits, "autant de lignes que de salariés", same_rows_as=people,
              fail=other_than(0)),
        Check(analytics, benefits, "id_salarie unique", unique="id_salarie", fail=above(0)),
        Check(analytics, benefits, "plus petite prime", smallest("montant_prime"), fail=below(0)),
        Check(analytics, benefits, "plus petit coût bien-être", smallest("cout_bien_etre"),
              fail=below(0)),
        Check(analytics, benefits, "déclarations à vérifier",
              unlisted("statut_declaration", (L.NOT_CONCERNED, L.COMPLIANT)), warn=above(0)),
        Check(analytics, kpi, "une seule ligne", row_count, fail=other_than(1)),
        Check(analytics, kpi, "coût total positif", smallest("cout_total"),
              fail=lambda value: value <= 0),
        Check(analytics, parameters, "une seule ligne", row_count, fail=other_than(1)),
        Check(analytics, parameters, "taux de prime hors bornes",
              out_of_range("taux_prime", 0, Decimal("0.2")), fail=above(0)),
        Check(analytics, parameters, "nombre minimal d'activités hors bornes",
              out_of_range("nb_activites_min", 1, 365), fail=above(0)),
    ]


OUTCOME = T.StructType([
    T.StructField("numero", T.IntegerType()),
    T.StructField("valeur", T.DoubleType()),
    T.StructField("resultat", T.StringType()),
    T.StructField("erreur", T.StringType()),
])


def _error(problem: Exception) -> str:
    missing = not isinstance(problem, AnalysisException)
    said = f"table absente {problem}" if missing else problem.getMessage()
    return L.CHECK_ERROR_TEXT.format(problem=said)


def evaluate(
    spark: SparkSession, tables: Tables, checks: list[Check], with_columns: Tables | None = None
) -> DataFrame:
    """Outcome of every check: ``numero, couche, table_verifiee, controle, resultat, valeur``.

    ``with_columns`` may hold, per table, a wider frame for the fused aggregates (for example the
    activities with their speed limit). A check that does not fit its table becomes an ``erreur``
    row; the others still run.
    """
    wide = tables | (with_columns or {})
    parts: list[DataFrame] = []
    failed: list[tuple] = []
    fused: dict[str, list[tuple[int, Check]]] = {}
    keys, keyed = KeyCounts(tables), []

    for number, check in enumerate(checks, start=1):
        try:
            if check.measure is not None:
                fused.setdefault(check.table, []).append((number, check))
            elif check.required:
                lost = [c for c in check.required if c not in tables[check.table].columns]
                result = L.CHECK_FAIL if lost else L.CHECK_PASS
                failed.append((number, float(len(lost)), result, None))
            else:
                keyed.append((number, check, _key_measure(keys, check)))
        except (AnalysisException, KeyError) as problem:
            failed.append((number, None, L.CHECK_ERROR, _error(problem)))

    for table, numbered in fused.items():
        try:
            parts.append(_fused(wide[table], numbered))
        except (AnalysisException, KeyError):
            # One of them does not fit the table: keep those that are valid on their own.
            valid = []
            for number, check in numbered:
                try:
                    wide[table].agg(check.measure())  # analysis only, no job
                    valid.append((number, check))
                except (AnalysisException, KeyError) as problem:
                    failed.append((number, None, L.CHECK_ERROR, _error(problem)))
            if valid:
                parts.append(_fused(wide[table], valid))
    if keyed:
        measured = keys.counts().agg(*[measure().alias(f"m{number}") for number, _, measure in keyed])
        parts.append(_rows(measured, [(n, check, F.col(f"m{n}")) for n, check, _ in keyed]))
    if failed:
        parts.append(small_table(spark, failed, OUTCOME))
    described = small_table(
        spark,
        [(n, c.layer, c.table, c.name) for n, c in enumerate(checks, start=1)],
        T.StructType([
            T.StructField("numero", T.IntegerType()),
            T.StructField("couche", T.StringType()),
            T.StructField("table_verifiee", T.StringType()),
            T.StructField("controle", T.StringType()),
        ]),
    )
    outcomes = reduce(DataFrame.unionByName, parts)
    broken = F.col("erreur").isNotNull()
    return outcomes.join(described, "numero").select(
        "numero",
        "couche",
        F.when(~broken, F.col("table_verifiee")).alias("table_verifiee"),
        F.coalesce("erreur", "controle").alias("controle"),
        "resultat",
        "valeur",
    )


def _rows(frame: DataFrame, entries: list[tuple[int, Check, Column]]) -> DataFrame:
    structs = [
        F.struct(
            F.lit(number).alias("numero"),
            value.cast("double").alias("valeur"),
            check.outcome(value.cast("double")).alias("resultat"),
            F.lit(None).cast("string").alias("erreur"),
        )
        for number, check, value in entries
    ]
    return frame.select(F.explode(F.array(*structs)).alias("c")).select("c.*")


def _fused(table: DataFrame, numbered: list[tuple[int, Check]]) -> DataFrame:
    """All aggregate checks of one table from a single aggregation."""
    measured = table.agg(*[check.measure().alias(f"m{number}") for number, check in numbered])
    return _rows(measured, [(n, check, F.col(f"m{n}")) for n, check in numbered])


def _key_measure(keys: KeyCounts, check: Check) -> Measure:
    if check.unique:
        return keys.repeated(check.table, check.unique)
    if check.parent:
        return keys.orphans(check.table, *check.parent)
    ours, theirs = keys.rows(check.table), keys.rows(check.same_rows_as)
    return lambda: ours() - theirs()


class QualityGateError(RuntimeError):
    """A layer has failing or broken checks."""


def outcome_counts(rows: list) -> dict[str, int]:
    counts = {L.CHECK_PASS: 0, L.CHECK_WARN: 0, L.CHECK_FAIL: 0, L.CHECK_ERROR: 0}
    for row in rows:
        counts[row["resultat"]] += 1
    return counts


def run_status(counts: dict[str, int]) -> str:
    bad = counts[L.CHECK_FAIL] + counts[L.CHECK_ERROR]
    return L.RUN_FAILED if bad else L.RUN_OK


def run_message(counts: dict[str, int]) -> str:
    said = [L.CHECK_COUNTS_TEXT.format(
        passed=counts[L.CHECK_PASS], warned=counts[L.CHECK_WARN], failed=counts[L.CHECK_FAIL],
    )]
    if counts[L.CHECK_ERROR]:
        said.append(L.CHECK_ERRORS_TEXT.format(broken=counts[L.CHECK_ERROR]))
    return "".join(said)


def stored(outcomes: DataFrame, execution_id: str, checked_at: datetime) -> DataFrame:
    """Outcome rows in the shape of the check history."""
    return outcomes.select(
        F.lit(execution_id).alias("execution_id"),
        F.lit(checked_at).cast("timestamp").alias("verifie_le"),
        F.col("couche").alias("data_source"),
        F.col("couche").alias("fichier_controle"),
        "table_verifiee",
        "controle",
        "resultat",
        "valeur",
    )
