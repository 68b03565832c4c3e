"""Result tables: activities, benefits per employee, key figures, their history."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from trailperks import labels as L
from trailperks.functions import rules
from trailperks.params import Params, small_table

ACTIVITY_COLUMNS = (
    "id_activite", "id_salarie", "date_activite", "mois", "jour_semaine", "type_activite",
    "distance_km", "duree_min", "source", "est_valide", "a_commentaire", "bu", "tranche_age",
    "sport_declare",
)
BENEFIT_COLUMNS = (
    "id_salarie", "bu", "tranche_age", "type_contrat", "date_embauche", "sport_declare",
    "pratique_declaree", "moyen_deplacement", "trajet_sportif", "distance_km", "seuil_km",
    "statut_declaration", "eligible_prime", "montant_prime", "nb_activites", "eligible_bien_etre",
    "jours_bien_etre", "cout_bien_etre",
)


def activity_mart(activities: DataFrame, salaries: DataFrame, sports: DataFrame) -> DataFrame:
    """One row per activity, with the employee's unit, age band and declared sport.

    The two employee tables are joined first, so the activity table is moved at most once and its
    join is the last shuffle of the plan: a hot employee is a skewed partition that adaptive
    execution may split without a further exchange.
    """
    people = salaries.select("id_salarie", "bu", "tranche_age").join(
        sports.select("id_salarie", "sport_declare"), "id_salarie", "left"
    )
    # Only the columns of the mart take part in the shuffle; comments stay behind.
    slim = activities.select(
        "id_activite", "id_salarie", "date_activite", "type_activite", "distance_km", "duree_min",
        "source", "est_valide", F.col("commentaire").isNotNull().alias("a_commentaire"),
    )
    return with_calendar(slim.join(people, "id_salarie", "left")).select(*ACTIVITY_COLUMNS)


def with_calendar(activities: DataFrame) -> DataFrame:
    """Month and ISO weekday (1 = Monday) of the activity date."""
    return activities.withColumns({
        "mois": F.trunc("date_activite", "month"),
        "jour_semaine": F.weekday("date_activite") + 1,
    })


def since(activities: DataFrame, start: date) -> DataFrame:
    """Activities dated from ``start`` on, by their Paris date.

    Paris is ahead of UTC by two hours at most, so the Paris bound implies an instant of the day
    before or later. That second bound is a plain comparison on a stored column, which reaches the
    scan and skips files. In the mart the month does the same for its folders.
    """
    recent = activities.where(F.col("date_activite") >= F.lit(start))
    if "date_debut" in activities.columns:
        coarse = datetime.combine(start - timedelta(days=1), time.min, tzinfo=timezone.utc)
        recent = recent.where(F.col("date_debut") >= F.lit(coarse))
    if "mois" in activities.columns:
        recent = recent.where(F.col("mois") >= F.lit(start.replace(day=1)))
    return recent


def daily_activity(activities: DataFrame, start: date) -> DataFrame:
    """Valid and invalid activities per employee and day, from ``start`` on.

    The partial counts collapse a hot employee to one row per day and task before anything moves.
    """
    return since(activities, start).groupBy("id_salarie", "date_activite").agg(
        F.count_if("est_valide").alias("nb_valides"),
        F.count_if(~F.col("est_valide")).alias("nb_invalides"),
    )


def activity_rollup(
    daily: DataFrame, salaries: DataFrame, starts: dict[str, date]
) -> DataFrame:
    """Activities per employee id for one or several period starts, in one pass.

    For each suffix in ``starts``: ``nb_activites<suffix>`` counts valid activities from the period
    start and not before hiring (NULL for ids outside the HR table); ``nb_valides<suffix>`` and
    ``nb_invalides<suffix>`` ignore the hire date.
    """
    day = F.col("date_activite")
    hired = salaries.select("id_salarie", "date_embauche")
    counts: list[Column] = []
    for suffix, start in starts.items():
        in_period = day >= F.lit(start)
        since_hire = in_period & (day >= F.col("date_embauche"))
        counts += [
            F.sum(F.when(since_hire, F.col("nb_valides"))).alias(f"nb_activites{suffix}"),
            F.sum(F.when(in_period, F.col("nb_valides"))).alias(f"nb_valides{suffix}"),
            F.sum(F.when(in_period, F.col("nb_invalides"))).alias(f"nb_invalides{suffix}"),
        ]
    return daily.join(hired, "id_salarie", "left").groupBy("id_salarie").agg(*counts)


def activities_per_employee(
    activities: DataFrame, salaries: DataFrame, params: Params, as_of: date
) -> DataFrame:
    """Valid activities in the period and after hiring, for employees that have some."""
    valid = since(activities, params.period_start(as_of)).where("est_valide")
    daily = valid.groupBy("id_salarie", "date_activite").agg(F.count(F.lit(1)).alias("n"))
    hired = salaries.select("id_salarie", "date_embauche")
    return (
        daily.join(hired, "id_salarie")
        .where(F.col("date_activite") >= F.col("date_embauche"))
        .groupBy("id_salarie")
        .agg(F.sum("n").alias("nb_activites"))
    )


def employee_base(salaries: DataFrame, sports: DataFrame, distances: DataFrame) -> DataFrame:
    """HR rows with declared sport and measured commute; all joins share the employee key."""
    measured = distances.select(
        "id_salarie",
        F.col("distance_km"),
        F.col("statut_api"),
        F.col("mode_api").alias("mode_mesure"),
        F.col("adresse_calculee"),
    )
    current = rules.distance_is_current(
        {
            "distance_km": F.col("distance_km"),
            "statut_api": F.col("statut_api"),
            "mode_api": F.col("mode_mesure"),
            "adresse": F.col("adresse_calculee"),
        },
        F.col("mode_api"),
        F.col("adresse"),
    )
    return (
        salaries.join(sports, "id_salarie", "left")
        .join(measured, "id_salarie", "left")
        .withColumn("pratique_declaree", F.coalesce("pratique_declaree", F.lit(False)))
        .withColumn("distance_a_jour", current)
        .withColumn("connu", F.lit(True))
    )


def apply_rules(base: DataFrame, values: dict[str, Column], count: Column) -> DataFrame:
    """Status, bonus and wellness columns of employee rows for one set of rule parameters."""
    eligible = F.col("nb_activites") >= values["nb_activites_min"]
    return (
        base.withColumn("nb_activites", F.coalesce(count, F.lit(0).cast("long")))
        .withColumn(
            "seuil_km",
            rules.commute_limit_km(
                F.col("mode_api"), values["seuil_marche_km"], values["seuil_velo_km"]
            ),
        )
        .withColumn(
            "statut_declaration",
            rules.declaration_status(
                F.col("trajet_sportif"), F.col("distance_a_jour"), F.col("distance_km"),
                F.col("seuil_km"),
            ),
        )
        .withColumns({
            "eligible_prime": F.col("statut_declaration") == L.COMPLIANT,
            "montant_prime": rules.bonus_amount(
                F.col("statut_declaration"), F.col("salaire_brut"), values["taux_prime"]
            ),
            "eligible_bien_etre": eligible,
            "jours_bien_etre": F.when(eligible, values["nb_jours_bien_etre"]).otherwise(
                F.lit(0).cast("decimal(18,6)")
            ),
            "cout_bien_etre": rules.wellness_cost(
                eligible, F.col("salaire_brut"), values["jours_travailles_an"],
                values["nb_jours_bien_etre"],
            ),
        })
    )


def benefit_mart(base: DataFrame, rollup: DataFrame, params: Params) -> DataFrame:
    """One row per employee: both benefits and their cost. Name, address and salary stay out."""
    counts = rollup.select("id_salarie", F.col("nb_activites").alias("comptees"))
    joined = base.join(counts, "id_salarie", "left")
    return apply_rules(joined, rules.literals(params), F.col("comptees")).select(*BENEFIT_COLUMNS)


COUNTED = (
    "nb_salaries", "nb_sportifs_declares", "nb_trajets_sportifs", "nb_declarations_suspectes",
    "nb_declarations_non_verifiees", "nb_eligibles_prime", "nb_eligibles_bien_etre",
)


def _key_figures() -> list[Column]:
    """Aggregates of the summary; rows of unknown employees only carry activity counts."""
    known = F.col("connu")
    status = F.col("statut_declaration")

    def rows(condition: Column) -> Column:
        return F.count_if(known & condition)

    bonus = F.sum(F.when(known, F.col("montant_prime")))
    wellness = F.sum(F.when(known, F.col("cout_bien_etre")))
    return [
        F.count_if(known).alias("nb_salaries"),
        rows(F.col("pratique_declaree")).alias("nb_sportifs_declares"),
        rows(F.col("trajet_sportif")).alias("nb_trajets_sportifs"),
        rows(status == L.SUSPECT).alias("nb_declarations_suspectes"),
        rows(status == L.NOT_VERIFIED).alias("nb_declarations_non_verifiees"),
        rows(F.col("eligible_prime")).alias("nb_eligibles_prime"),
        bonus.alias("cout_prime"),
        rows(F.col("eligible_bien_etre")).alias("nb_eligibles_bien_etre"),
        F.sum(F.when(known, F.col("jours_bien_etre"))).alias("nb_jours_bien_etre"),
        wellness.alias("cout_bien_etre"),
        (bonus + wellness).alias("cout_total"),
        F.coalesce(F.sum("valides"), F.lit(0)).alias("nb_activites_valides"),
        F.coalesce(F.sum("invalides"), F.lit(0)).alias("nb_activites_invalides"),
    ]


def _with_params(summary: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Add the parameters in force. Without any employee, all but the counts is NULL."""
    some = F.col("nb_salaries") > 0
    shown = {
        "taux_prime": "taux_prime",
        "seuil_marche_km": "seuil_marche_km",
        "seuil_velo_km": "seuil_velo_km",
        "nb_activites_min": "nb_activites_min",
        "nb_jours_bien_etre_par_salarie": "nb_jours_bien_etre",
    }
    totals = {
        name: F.when(some, F.col(name)) for name in ("nb_activites_valides", "nb_activites_invalides")
    }
    return summary.withColumns(
        totals | {name: F.when(some, values[source]) for name, source in shown.items()}
    )


def kpi_summary(base: DataFrame, rollup: DataFrame, params: Params) -> DataFrame:
    """The one-row summary of both benefits, with the parameters used.

    Employees and activity counts meet in one full outer join, so the activity table is read once
    for the benefits and for the activity totals, which include ids outside the HR table.
    """
    counts = rollup.select(
        "id_salarie",
        F.col("nb_activites").alias("comptees"),
        F.col("nb_valides").alias("valides"),
        F.col("nb_invalides").alias("invalides"),
    )
    values = rules.literals(params)
    rows = apply_rules(base.join(counts, "id_salarie", "full"), values, F.col("comptees"))
    return _with_params(rows.agg(*_key_figures()), values)


def kpi_history(
    summary: DataFrame, execution_id: str | Column, computed_at: datetime
) -> DataFrame:
    """The summary stamped with run id and time, ready to be appended."""
    return summary.select(
        F.lit(computed_at).cast("timestamp").alias("calcule_le"),
        F.lit(execution_id).alias("execution_id"),
        "*",
    )


def kpi_history_schema(summary: DataFrame) -> T.StructType:
    return kpi_history(summary, "", datetime.now(timezone.utc)).schema


def compare_runs(history: DataFrame) -> DataFrame:
    """Runs in time order with the change of the total cost since the run before.

    The history holds one row per run, so a single ordered window is bounded by the number of runs.
    """
    in_order = Window.orderBy("calcule_le")
    return history.select(
        "calcule_le", "execution_id", "taux_prime", "seuil_velo_km", "nb_eligibles_prime",
        "cout_prime", "cout_bien_etre", "cout_total",
        (F.col("cout_total") - F.lag("cout_total").over(in_order)).alias("ecart_cout_total"),
    )


def kpi_scenarios(
    base: DataFrame, salaries: DataFrame, activities: DataFrame, scenarios: dict[str, Params],
    as_of: date,
) -> DataFrame:
    """One summary row per named parameter set, from a single pass over the activities.

    Counts only depend on the period, so the roll-up holds one column group per distinct period.
    Each employee row is then unfolded into the scenarios (a constant list) and aggregated on the
    way out: partial aggregation leaves one row per scenario and task to shuffle.
    """
    starts = {f"_{p.period_start(as_of):%Y%m%d}": p.period_start(as_of) for p in scenarios.values()}
    daily = daily_activity(activities, min(starts.values()))
    rollup = activity_rollup(daily, salaries, starts)
    sets = []
    for name, params in scenarios.items():
        constants = rules.literals(params)
        suffix = f"_{params.period_start(as_of):%Y%m%d}"
        sets.append(
            F.struct(
                F.lit(name).alias("scenario"),
                *[column.alias(key) for key, column in constants.items()],
                F.col(f"nb_activites{suffix}").alias("comptees"),
                F.col(f"nb_valides{suffix}").alias("valides"),
                F.col(f"nb_invalides{suffix}").alias("invalides"),
            )
        )
    unfolded = (
        base.join(rollup, "id_salarie", "full")
        .withColumn("jeu", F.explode(F.array(*sets)))
        .withColumns({"comptees": F.col("jeu.comptees"), "valides": F.col("jeu.valides"),
                      "invalides": F.col("jeu.invalides")})
    )
    names = list(rules.literals(Params()))
    ruled = apply_rules(unfolded, {n: F.col(f"jeu.{n}") for n in names}, F.col("comptees"))
    keys = [F.col("jeu.scenario").alias("scenario")] + [
        F.col(f"jeu.{name}").alias(f"p_{name}") for name in names
    ]
    summary = _with_params(
        ruled.groupBy(*keys).agg(*_key_figures()), {name: F.col(f"p_{name}") for name in names}
    ).drop(*[f"p_{name}" for name in names])
    # Without any row at all, a set still has a summary, as in a single run.
    listed = small_table(
        base.sparkSession, [(name,) for name in scenarios],
        T.StructType([T.StructField("scenario", T.StringType())]),
    )
    return listed.join(summary, "scenario", "left").na.fill(0, list(COUNTED))
