"""Queries over the staging models and the marts."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from trailperks.catalog.oracle import half_up, kpi_sql, benefits_sql, oracle
from trailperks.catalog.registry import query
from trailperks.functions import rules
from trailperks.functions.numbers import round_ratio
from trailperks.operators import marts
from trailperks.operators.joins import count_by
from trailperks.params import Params
from trailperks.session import new_run_folder
from trailperks.sources import views
from trailperks.sources.layers import Layers
from trailperks.sources.testdata import AS_OF, TestTables

STRICT = Params(nb_activites_min=60)
BENEFITS_SELECT = """
SELECT id_salarie, bu, tranche_age, type_contrat, CAST(date_embauche AS VARCHAR) AS date_embauche,
  sport_declare, pratique_declaree, moyen_deplacement, trajet_sportif, distance_km, seuil_km,
  statut_declaration, eligible_prime, montant_prime, nb_activites, eligible_bien_etre,
  jours_bien_etre, cout_bien_etre
FROM avantages_salaries"""


@query("stg_salaries", oracle("""
SELECT id_salarie, nom, prenom, CAST(date_naissance AS VARCHAR) AS date_naissance, age, tranche_age,
  bu, CAST(date_embauche AS VARCHAR) AS date_embauche, salaire_brut, type_contrat, jours_cp,
  adresse, moyen_deplacement, trajet_sportif, mode_api
FROM stg_salaries"""))
def stg_salaries(t: TestTables):
    return t.stg_salaries


@query("stg_sports", oracle("SELECT * FROM stg_sports"))
def stg_sports(t: TestTables):
    return t.stg_sports


@query("stg_distances", oracle("""
SELECT id_salarie, adresse_calculee, mode_api, CAST(distance_km AS DOUBLE) AS distance_km, duree_min,
  statut_api, strftime(calcule_le, '%Y-%m-%d %H:%M:%S') AS calcule_le
FROM stg_distances"""))
def stg_distances(t: TestTables):
    return t.stg_distances


@query("stg_activites", oracle("""
SELECT id_activite, id_salarie, strftime(date_debut, '%Y-%m-%d %H:%M:%S') AS date_debut,
  strftime(date_fin, '%Y-%m-%d %H:%M:%S') AS date_fin, CAST(date_activite AS VARCHAR) AS date_activite,
  type_activite, distance_m, CAST(distance_km AS DOUBLE) AS distance_km, duree_min, vitesse_kmh,
  commentaire, source, est_valide
FROM stg_activites"""))
def stg_activites(t: TestTables):
    return t.stg_activities


@query("mart_activities", oracle("""
SELECT id_activite, id_salarie, CAST(date_activite AS VARCHAR) AS date_activite,
  CAST(mois AS VARCHAR) AS mois, jour_semaine, type_activite,
  CAST(distance_km AS DOUBLE) AS distance_km, duree_min, source, est_valide, a_commentaire, bu,
  tranche_age, sport_declare
FROM activites"""))
def mart_activities(t: TestTables):
    return t.activity_mart


@query("mart_benefits", oracle(BENEFITS_SELECT))
def mart_benefits(t: TestTables):
    return t.benefits()


@query("mart_benefits_min60", oracle(BENEFITS_SELECT, STRICT))
def mart_benefits_min60(t: TestTables):
    return t.benefits(STRICT)


SQL_BENEFITS = """
WITH comptes AS (
  SELECT id_salarie, count(*) AS n FROM stg_activites JOIN stg_salaries USING (id_salarie)
  WHERE est_valide AND date_activite >= DATE '2024-01-31' - INTERVAL 365 DAYS AND date_activite >= date_embauche
  GROUP BY id_salarie),
personnes AS (
  SELECT s.id_salarie, bu, tranche_age(age) AS tranche_age, type_contrat, date_embauche, sport_declare,
    coalesce(pratique_declaree, false) AS pratique_declaree, moyen_deplacement,
    trajet_sportif(moyen_deplacement) AS sportif, distance_km,
    seuil_trajet_km(mode_api(moyen_deplacement)) AS seuil_km, salaire_brut, coalesce(n, 0) AS nb_activites,
    distance_km IS NOT NULL AND coalesce(statut_api = 'ROUTE_EXISTS', true)
      AND d.mode_api <=> mode_api(moyen_deplacement) AND adresse_calculee <=> adresse AS a_jour
  FROM stg_salaries s LEFT JOIN stg_sports USING (id_salarie)
  LEFT JOIN stg_distances d USING (id_salarie) LEFT JOIN comptes USING (id_salarie)),
jugees AS (SELECT *, statut_declaration(sportif, a_jour, distance_km, seuil_km) AS statut FROM personnes)
SELECT id_salarie, bu, tranche_age, type_contrat, date_embauche, sport_declare, pratique_declaree,
  moyen_deplacement, sportif AS trajet_sportif, distance_km, seuil_km, statut AS statut_declaration,
  statut = 'conforme' AS eligible_prime, montant_prime(statut, salaire_brut) AS montant_prime, nb_activites,
  bien_etre_acquis(nb_activites) AS eligible_bien_etre, jours_bien_etre(nb_activites) AS jours_bien_etre,
  cout_bien_etre(nb_activites, salaire_brut) AS cout_bien_etre
FROM jugees"""


@query("sql_benefits", oracle(BENEFITS_SELECT))
def sql_benefits(t: TestTables):
    """The benefit mart as a user of SQL writes it, over the staging views and the rules as functions."""
    views.create_views({
        "salaries": t.salaries, "sports": t.sports, "distances": t.distances, "activites": t.activities,
        "vitesses_max": t.speed_limits,
    }, AS_OF)
    views.create_functions(t.spark, Params())
    return t.spark.sql(SQL_BENEFITS)


@query("mart_no_pii", oracle("""
SELECT count(*) AS lignes, count(DISTINCT id_salarie) AS salaries, false AS colonne_personnelle
FROM avantages_salaries"""))
def mart_no_pii(t: TestTables):
    """Row count of the result mart, with a flag if its schema held a personal column."""
    benefits = t.benefits()
    leaked = {"nom", "prenom", "adresse", "salaire_brut", "date_naissance"} & set(benefits.columns)
    return benefits.agg(
        F.count(F.lit(1)).alias("lignes"), F.count_distinct("id_salarie").alias("salaries")
    ).withColumn("colonne_personnelle", F.lit(bool(leaked)))


@query("activities_per_employee", oracle(f"""
SELECT id_salarie, count(*) AS nb_activites
FROM stg_activites JOIN stg_salaries USING (id_salarie)
WHERE est_valide AND date_activite >= DATE '2024-01-31' - 365 AND date_activite >= date_embauche
GROUP BY 1"""))
def activities_per_employee(t: TestTables):
    return marts.activities_per_employee(t.stg_activities, t.stg_salaries, Params(), AS_OF)


@query("valid_activity_counts", oracle("""
SELECT count(*) FILTER (WHERE est_valide) AS nb_valides,
  count(*) FILTER (WHERE NOT est_valide) AS nb_invalides
FROM stg_activites WHERE date_activite >= DATE '2024-01-31' - 365"""))
def valid_activity_counts(t: TestTables):
    activities = marts.since(t.stg_activities, Params().period_start(AS_OF))
    return activities.agg(
        F.count_if("est_valide").alias("nb_valides"),
        F.count_if(~F.col("est_valide")).alias("nb_invalides"),
    )


@query("age_band_counts", oracle("SELECT tranche_age, count(*) AS n FROM stg_salaries GROUP BY 1"))
def age_band_counts(t: TestTables):
    return count_by(t.stg_salaries, "tranche_age")


@query("declaration_status", oracle("""
SELECT statut_declaration, count(*) AS salaries,
  count(*) FILTER (WHERE eligible_bien_etre) AS eligibles_bien_etre
FROM avantages_salaries GROUP BY 1""", STRICT))
def declaration_status(t: TestTables):
    return t.benefits(STRICT).groupBy("statut_declaration").agg(
        F.count(F.lit(1)).alias("salaries"),
        F.count_if("eligible_bien_etre").alias("eligibles_bien_etre"),
    )


@query("bonus_amounts", oracle("""
SELECT id_salarie, montant_prime FROM avantages_salaries WHERE eligible_prime""",
                               Params(taux_prime="0.0325")))
def bonus_amounts(t: TestTables):
    benefits = t.benefits(Params(taux_prime="0.0325"))
    return benefits.where("eligible_prime").select("id_salarie", "montant_prime")


@query("wellness_days", oracle("""
SELECT id_salarie, nb_activites, jours_bien_etre, cout_bien_etre
FROM avantages_salaries WHERE eligible_bien_etre""", STRICT))
def wellness_days(t: TestTables):
    benefits = t.benefits(STRICT).where("eligible_bien_etre")
    return benefits.select("id_salarie", "nb_activites", "jours_bien_etre", "cout_bien_etre")


FINE = Params(taux_prime="0.0333333333", nb_jours_bien_etre="2.125", jours_travailles_an="217.5")


@query("bonus_fine_rate", oracle("""
SELECT id_salarie, montant_prime FROM avantages_salaries WHERE eligible_prime""", FINE))
def bonus_fine_rate(t: TestTables):
    """Bonuses at a rate of ten decimals."""
    return t.benefits(FINE).where("eligible_prime").select("id_salarie", "montant_prime")


@query("wellness_fractions", oracle("""
SELECT id_salarie, nb_activites, jours_bien_etre, cout_bien_etre
FROM avantages_salaries WHERE eligible_bien_etre""", FINE))
def wellness_fractions(t: TestTables):
    """Parts of days granted, and worked days with a fraction."""
    benefits = t.benefits(FINE).where("eligible_bien_etre")
    return benefits.select("id_salarie", "nb_activites", "jours_bien_etre", "cout_bien_etre")


@query("kpi_summary", oracle("SELECT * FROM kpi_synthese"))
def kpi_summary(t: TestTables):
    return t.kpi()


@query("kpi_summary_min60", oracle("SELECT * FROM kpi_synthese", STRICT))
def kpi_summary_min60(t: TestTables):
    return t.kpi(STRICT)


SCENARIOS = {
    "defaut": Params(),
    "taux_3": Params(taux_prime="0.03"),
    "velo_10": Params(seuil_velo_km=10),
    "minimum_60": STRICT,
    "quinze_jours": Params(periode_jours=15, nb_activites_min=30),
    "dix_jours_bien_etre": Params(nb_jours_bien_etre=10, jours_travailles_an=200),
}


def _scenario_union(columns: str = "*") -> str:
    parts = []
    for number, (name, params) in enumerate(SCENARIOS.items()):
        parts.append(
            f"SELECT {number} AS numero, '{name}' AS scenario, {columns} FROM "
            f"({kpi_sql(params, f'({benefits_sql(params)})')})"
        )
    return "\nUNION ALL\n".join(parts)


@query("kpi_scenarios", oracle(f"SELECT * EXCLUDE (numero) FROM ({_scenario_union()})"))
def kpi_scenarios(t: TestTables):
    return marts.kpi_scenarios(t.employee_base, t.stg_salaries, t.stg_activities, SCENARIOS, AS_OF)


@query("kpi_history", oracle("""
SELECT '2024-01-31 00:00:00' AS calcule_le, unnest(['execution-1', 'execution-2']) AS execution_id, *
FROM kpi_synthese"""))
def kpi_history(t: TestTables):
    """Two runs appended to the stored history, read back."""
    layers = Layers(t.spark, new_run_folder(t.spark, "history"))
    kpi, moment = t.kpi(), datetime(2024, 1, 31, tzinfo=timezone.utc)
    for run in ("execution-1", "execution-2"):
        layers.append("analytics.historique_kpi", marts.kpi_history(kpi, run, moment))
    return layers.read_log("analytics.historique_kpi", marts.kpi_history_schema(kpi))


@query("kpi_history_compare", oracle(f"""
SELECT strftime(TIMESTAMP '2024-01-31 00:00:00' + to_minutes(numero), '%Y-%m-%d %H:%M:%S')
    AS calcule_le,
  scenario AS execution_id, taux_prime, seuil_velo_km, nb_eligibles_prime, cout_prime,
  cout_bien_etre, cout_total,
  CAST(CAST(round(cout_total * 100) AS BIGINT)
    - lag(CAST(round(cout_total * 100) AS BIGINT)) OVER (ORDER BY numero) AS DOUBLE) / 100.0
    AS ecart_cout_total
FROM ({_scenario_union()})"""))
def kpi_history_compare(t: TestTables):
    """The parameter sets as successive runs, each compared with the one before."""
    numbers = F.create_map(
        *[F.lit(v) for pair in enumerate(SCENARIOS) for v in reversed(pair)]
    )
    runs = marts.kpi_scenarios(t.employee_base, t.stg_salaries, t.stg_activities, SCENARIOS, AS_OF)
    start = F.lit(datetime(2024, 1, 31, tzinfo=timezone.utc))
    stamped = runs.withColumn(
        "calcule_le", F.timestamp_add("MINUTE", numbers[F.col("scenario")], start)
    ).withColumnRenamed("scenario", "execution_id")
    return marts.compare_runs(stamped)


@query("params_effective", oracle("""
SELECT mode_api, CAST(CASE mode_api WHEN 'WALK' THEN 12 ELSE 25 END AS DOUBLE) AS seuil_km,
  CAST(0.05 AS DOUBLE) AS taux_prime, count(*) AS nb_trajets
FROM stg_salaries WHERE trajet_sportif GROUP BY 1"""))
def params_effective(t: TestTables):
    """Parameters in force with one override (and one left empty), per commute mode."""
    values = rules.literals(Params().with_overrides(seuil_marche_km=12, taux_prime=None))
    limit = rules.commute_limit_km(
        F.col("mode_api"), values["seuil_marche_km"], values["seuil_velo_km"]
    )
    commutes = count_by(t.stg_salaries.where("trajet_sportif"), "mode_api", name="nb_trajets")
    return commutes.select(
        "mode_api", limit.alias("seuil_km"), values["taux_prime"].alias("taux_prime"), "nb_trajets"
    )


@query("date_functions", oracle(f"""
SELECT CAST(date_activite AS VARCHAR) AS jour,
  CAST(CAST(date_trunc('month', date_activite) AS DATE) AS VARCHAR) AS mois,
  CAST(isodow(date_activite) AS INTEGER) AS jour_semaine,
  CAST(date_activite - 30 AS VARCHAR) AS trente_jours_avant,
  count(*) AS n, min({half_up("(epoch_us(date_fin) - epoch_us(date_debut))", "1000000", 0)})
    AS duree_min_s
FROM stg_activites GROUP BY date_activite"""))
def date_functions(t: TestTables):
    seconds = round_ratio(rules.elapsed_us(F.col("date_debut"), F.col("date_fin")), 1_000_000, 0)
    days = t.stg_activities.groupBy("date_activite").agg(
        F.count(F.lit(1)).alias("n"), F.min(seconds).alias("duree_min_s")
    )
    day = F.col("date_activite")
    return days.select(
        day.alias("jour"), F.trunc(day, "month").alias("mois"),
        (F.weekday(day) + 1).alias("jour_semaine"), F.date_sub(day, 30).alias("trente_jours_avant"),
        "n", "duree_min_s",
    )
