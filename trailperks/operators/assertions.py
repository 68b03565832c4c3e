"""Model tests: each returns the rows that break it."""

from __future__ import annotations

from decimal import Decimal

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from trailperks import labels as L
from trailperks.operators.keys import KeyCounts
from trailperks.params import Params

ERROR, WARN = "error", "warn"


def activities_before_hire(activities: DataFrame, salaries: DataFrame) -> DataFrame:
    """Activities dated before the employee was hired.

    Only employees hired after the first recorded activity can have one, so the activities meet a
    short list instead of the whole HR table.
    """
    first = activities.agg(F.min("date_activite")).scalar()
    hired = salaries.select("id_salarie", "date_embauche").where(F.col("date_embauche") > first)
    return (
        activities.select("id_activite", "id_salarie", "date_activite")
        .join(hired, "id_salarie")
        .where(F.col("date_activite") < F.col("date_embauche"))
    )


def has_unknown_status() -> Column:
    return ~F.col("statut_declaration").isin(*L.DECLARATION_STATUSES)


def unknown_status(benefits: DataFrame) -> DataFrame:
    return benefits.where(has_unknown_status())


def has_incoherent_costs() -> Column:
    """Negative amounts, or amounts without eligibility."""
    bonus, wellness = F.col("montant_prime"), F.col("cout_bien_etre")
    return (
        (bonus < 0)
        | (wellness < 0)
        | (~F.col("eligible_prime") & (bonus > 0))
        | (~F.col("eligible_bien_etre") & (wellness > 0))
    )


def incoherent_costs(benefits: DataFrame) -> DataFrame:
    return benefits.where(has_incoherent_costs())


def detailed_total() -> Column:
    return F.sum("montant_prime") + F.sum("cout_bien_etre")


def contradicts(total: Column) -> Column:
    """Whether the numbers of a summary contradict each other or the total of the detail."""
    return (
        (F.col("nb_eligibles_prime") > F.col("nb_trajets_sportifs"))
        | (F.col("nb_trajets_sportifs") > F.col("nb_salaries"))
        | (F.col("nb_eligibles_bien_etre") > F.col("nb_salaries"))
        | (F.abs(F.col("cout_total") - total) > 0.01)
    )


def incoherent_kpi(kpi: DataFrame, benefits: DataFrame) -> DataFrame:
    """Summary rows that contradict each other or the detail."""
    return kpi.where(contradicts(benefits.agg(detailed_total()).scalar()))


def wrong_bonus(benefits: DataFrame, salaries: DataFrame, params: Params) -> DataFrame:
    """Eligible employees whose bonus is not salary times rate, to the cent."""
    # Whole numbers only, apart from the computation under test: salary times the rate's digits, in cents.
    digits = -min(params.taux_prime.normalize().as_tuple().exponent, 0)
    scaled = F.col("salaire_brut").cast("decimal(38,0)") * F.lit(int(params.taux_prime.scaleb(digits))) * 100
    unit = F.lit(Decimal(10) ** digits).cast("decimal(20,0)")
    cents = F.floor((scaled.cast("decimal(38,0)") * 2 + unit) / (unit * 2))
    expected = (cents.cast("decimal(18,0)") / 100).cast("decimal(18,2)")
    return (
        benefits.where("eligible_prime")
        .select("id_salarie", "montant_prime")
        .join(salaries.select("id_salarie", "salaire_brut"), "id_salarie")
        .withColumn("montant_attendu", expected)
        .where(F.col("montant_prime") != F.col("montant_attendu"))
        .drop("salaire_brut")
    )


def model_tests(
    tables: dict[str, DataFrame], benefits: DataFrame, activity_mart: DataFrame, kpi: DataFrame,
    dated_activities: DataFrame, stg_salaries: DataFrame, params: Params,
) -> DataFrame:
    """All model tests in one frame: ``test, gravite, violations``.

    Keys of all tables are counted in one aggregation, whatever looks at single rows of the benefits in
    another.
    """
    keyed = {
        "salaries": (tables["salaries"], "id_salarie"),
        "sports": (tables["sports"], "id_salarie"),
        "raw_activites": (tables["activites"], "id_activite"),
        "distances": (tables["distances_domicile_travail"], "id_salarie"),
        "avantages_salaries": (benefits, "id_salarie"),
        "activites": (activity_mart, "id_activite"),
        "vitesses_max": (tables["vitesses_max"], "type_activite"),
    }
    keys = KeyCounts({name: table for name, (table, _) in keyed.items()} | {"connus": stg_salaries})
    measures = {}
    for name, (_, key) in keyed.items():
        measures[f"{name}.{key} unique", ERROR] = keys.repeated(name, key)
        measures[f"{name}.{key} renseigné", ERROR] = keys.missing(name, key)
    known = keys.orphans("activites", "id_salarie", "connus", "id_salarie")
    measures["activites salarié connu", WARN] = known
    counted = _results(keys.counts(), {name: measure() for name, measure in measures.items()})

    filled = ("statut_declaration", "montant_prime", "cout_bien_etre")
    detail = {(f"avantages_salaries.{c} renseigné", ERROR): F.count_if(F.col(c).isNull()) for c in filled}
    detail["avantages_salaries statuts connus", ERROR] = F.count_if(has_unknown_status())
    detail["coûts cohérents", ERROR] = F.count_if(has_incoherent_costs())
    row = F.count(F.lit(1))
    others = [
        _results(benefits, detail),
        _results(incoherent_kpi(kpi, benefits), {("synthèse cohérente", ERROR): row}),
        _results(
            activities_before_hire(dated_activities, stg_salaries),
            {("activités avant embauche", WARN): row},
        ),
        _results(wrong_bonus(benefits, stg_salaries, params), {("montant de prime", ERROR): row}),
    ]
    return reduce(DataFrame.unionByName, others, counted)


def _results(rows: DataFrame, measures: dict[tuple[str, str], Column]) -> DataFrame:
    """One row per test, from one aggregation."""
    measured = rows.agg(*[measure.alias(f"m{n}") for n, measure in enumerate(measures.values())])
    entries = [
        F.struct(
            F.lit(test).alias("test"), F.lit(severity).alias("gravite"),
            F.col(f"m{n}").cast("bigint").alias("violations"),
        )
        for n, (test, severity) in enumerate(measures)
    ]
    return measured.select(F.explode(F.array(*entries)).alias("t")).select("t.*")
