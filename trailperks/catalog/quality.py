"""Queries over the quality checks and the model tests."""

from pyspark.sql import DataFrame, functions as F

from trailperks import labels as L, schemas
from trailperks.catalog.oracle import oracle, quoted
from trailperks.catalog.registry import query
from trailperks.operators import assertions, marts, quality as Q
from trailperks.operators.joins import count_by, duplicate_keys, orphan_counts
from trailperks.params import Params
from trailperks.session import cut_lineage, new_run_folder, written
from trailperks.sources.layers import Layers
from trailperks.sources.testdata import AS_OF, AS_OF_TIME, TestTables


SOURCES = {"activites", "salaries", "sports", "distances_domicile_travail", "vitesses_max"}


def checked_tables(t: TestTables, names: set[str] | None = None) -> dict[str, DataFrame]:
    """The named tables under test, by default all. Where benefits and summary are read several times,
    the counts behind them and the benefits are computed once and kept."""
    params = Params()
    tables = {
        "activites": t.activities,
        "salaries": t.salaries,
        "sports": t.sports,
        "distances_domicile_travail": t.distances,
        "parametres": params.row(t.spark),
        "vitesses_max": t.speed_limits,
    }
    if names is None or "kpi_synthese" in names:
        rollup = written(t.rollup(params), "compte")
        benefits = marts.benefit_mart(t.employee_base, rollup, params)
        tables["avantages_salaries"] = written(benefits, "avantages")
        tables["kpi_synthese"] = marts.kpi_summary(t.employee_base, rollup, params)
    elif "avantages_salaries" in names:
        tables["avantages_salaries"] = t.benefits(params)
    return tables if names is None else {n: f for n, f in tables.items() if n in names}


def evaluated(t: TestTables, checks: list[Q.Check]) -> DataFrame:
    """Outcomes of the checks; only tables that one of them names are built."""
    names = {check.table for check in checks} | {check.same_rows_as for check in checks}
    names |= {check.parent[1] for check in checks if check.parent}
    limited = {"activites": t.activities.join(t.speed_limits, "type_activite", "left")}
    return Q.evaluate(t.spark, checked_tables(t, names), checks, limited)


MICROS = "(epoch_us(date_fin) - epoch_us(date_debut))"
SAME_ROWS = "(SELECT count(*) FROM {0}) - (SELECT count(*) FROM raw_salaries)"
NOT_LISTED = "(SELECT count(*) FROM {0} WHERE {1} NOT IN ({2}))"
DUPLICATES = "(SELECT count(*) FROM (SELECT {1} FROM {0} GROUP BY 1 HAVING count(*) > 1))"
AGE_MS = "(SELECT (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max({1}))) / 1000.0 FROM {0})"
DAY = 86400000

# (value, fail condition, warn condition); v stands for the value.
CHECK_SQL = [
    ("(SELECT count(*) FROM raw_activites)", "v < 1", None),
    (AGE_MS.format("raw_activites", "charge_le"), f"v > {7 * DAY}", f"v > {DAY}"),
    (DUPLICATES.format("raw_activites", "id_activite"), "v > 0", None),
    ("(SELECT count(*) FROM raw_activites WHERE id_salarie IS NULL)", "v > 0", None),
    ("(SELECT count(*) FROM raw_activites WHERE id_salarie NOT IN "
     "(SELECT id_salarie FROM raw_salaries))", "v > 0", None),
    ("(SELECT 100.0 * count(*) FILTER (WHERE distance_m < 0 OR distance_m > 300000) / count(*) "
     "FROM raw_activites)", "v > 1", "v > 0"),
    (f"(SELECT count(*) FROM raw_activites WHERE date_fin <= date_debut OR {MICROS} >= 86400000000)",
     "v > 50", "v > 0"),
    (f"(SELECT count(*) FROM raw_activites JOIN vitesses_max USING (type_activite) "
     f"WHERE distance_m > 0 AND date_fin > date_debut AND CAST(distance_m AS BIGINT) * 3600000 > "
     f"CAST(vitesse_max_kmh AS BIGINT) * {MICROS})", "v > 50", "v > 0"),
    (NOT_LISTED.format("raw_activites", "type_activite",
                       quoted(L.ACTIVITY_TYPES)), None, "v > 0"),
    ("(SELECT count(*) FROM raw_salaries)", "v < 1", None),
    ("0", "v > 0", None),
    (DUPLICATES.format("raw_salaries", "id_salarie"), "v > 0", None),
    ("(SELECT count(*) FROM raw_salaries WHERE salaire_brut IS NULL)", "v > 0", None),
    ("(SELECT min(salaire_brut) FROM raw_salaries)", "v <= 0", None),
    ("(SELECT count(*) FROM raw_salaries WHERE adresse IS NULL)", "v > 0", None),
    (NOT_LISTED.format("raw_salaries", "moyen_deplacement",
                       quoted(L.TRAVEL_MODES)), "v > 0", None),
    (NOT_LISTED.format("raw_salaries", "type_contrat", "'CDI', 'CDD'"), "v > 0", None),
    ("(SELECT count(*) FROM raw_salaries WHERE date_embauche > DATE '2024-01-31')", "v > 0", None),
    (SAME_ROWS.format("raw_sports"), "v <> 0", None),
    (DUPLICATES.format("raw_sports", "id_salarie"), "v > 0", None),
    ("(SELECT count(*) FROM raw_distances)", "v < 1", None),
    (DUPLICATES.format("raw_distances", "id_salarie"), "v > 0", None),
    (NOT_LISTED.format("raw_distances", "statut", "'ROUTE_EXISTS'"), None, "v > 0"),
    ("(SELECT count(*) FROM raw_distances WHERE distance_m IS NULL)", None, "v > 0"),
    (AGE_MS.format("raw_distances", "calcule_le"), None, f"v > {90 * DAY}"),
    (SAME_ROWS.format("avantages_salaries"), "v <> 0", None),
    (DUPLICATES.format("avantages_salaries", "id_salarie"), "v > 0", None),
    ("(SELECT min(montant_prime) FROM avantages_salaries)", "v < 0", None),
    ("(SELECT min(cout_bien_etre) FROM avantages_salaries)", "v < 0", None),
    (NOT_LISTED.format("avantages_salaries", "statut_declaration",
                       "'non concerné', 'conforme'"), None, "v > 0"),
    ("(SELECT count(*) FROM kpi_synthese)", "v <> 1", None),
    ("(SELECT min(cout_total) FROM kpi_synthese)", "v <= 0", None),
    ("1", "v <> 1", None),
    ("0", "v > 0", None),
    ("0", "v > 0", None),
]


def check_sql(selected=None) -> str:
    """One row per check: number, layer, table, name, result, value."""
    parts = []
    pairs = zip(Q.standard_checks(AS_OF_TIME), CHECK_SQL)
    chosen = [pair for pair in pairs if selected is None or selected(pair[0])]
    for number, (check, (value, fail, warn)) in enumerate(chosen, start=1):
        cases = " ".join(
            f"WHEN {condition} THEN '{result}'"
            for condition, result in ((fail, "fail"), (warn, "warn")) if condition
        )
        name = check.name.replace("'", "''")
        parts.append(
            f"SELECT CAST({number} AS INTEGER) AS numero, '{check.layer}' AS couche, "
            f"'{check.table}' AS table_verifiee, '{name}' AS controle, "
            f"CASE {cases} ELSE 'pass' END AS resultat, v AS valeur "
            f"FROM (SELECT CAST({value} AS DOUBLE) AS v)"
        )
    return "\nUNION ALL\n".join(parts)


@query("dq_run", oracle(check_sql()))
def dq_run(t: TestTables):
    """All 35 checks."""
    return evaluated(t, Q.standard_checks(AS_OF_TIME))


@query("dq_results", oracle(f"""
SELECT unnest(['controle-1', 'controle-2']) AS execution_id, '2024-01-31 00:00:00' AS verifie_le, couche AS data_source,
  couche AS fichier_controle, table_verifiee, controle, resultat, valeur
FROM ({check_sql()})"""))
def dq_results(t: TestTables):
    """The outcomes of two runs, appended to the stored check history and read back."""
    layers = Layers(t.spark, new_run_folder(t.spark, "checks"))
    outcomes = cut_lineage(evaluated(t, Q.standard_checks(AS_OF_TIME)))
    for run in ("controle-1", "controle-2"):
        layers.append("monitoring.qualite_checks", Q.stored(outcomes, run, AS_OF_TIME))
    return layers.read_log("monitoring.qualite_checks", schemas.QUALITY_CHECKS)


@query("dq_broken_check", oracle("""
SELECT CAST(1 AS INTEGER) AS numero, 'raw' AS couche, CAST(NULL AS VARCHAR) AS table_verifiee,
  'erreur' AS resultat, CAST(NULL AS DOUBLE) AS valeur
UNION ALL
SELECT 2, 'raw', 'activites', 'pass', CAST(count(*) AS DOUBLE) FROM raw_activites"""))
def dq_broken_check(t: TestTables):
    """A check on a column that does not exist is reported; its neighbours still run."""
    checks = [
        Q.Check("raw", "activites", "colonne absente", Q.missing("id_inconnu"), fail=Q.above(0)),
        Q.Check("raw", "activites", "table non vide", Q.row_count, fail=Q.below(1)),
    ]
    return Q.evaluate(t.spark, {"activites": t.activities}, checks).drop("controle")


@query("dq_metrics", oracle("""
SELECT count(*) AS lignes, count(*) FILTER (WHERE id_salarie IS NULL) AS salaries_manquants,
  count(*) FILTER (WHERE distance_m IS NULL) AS distances_manquantes,
  count(*) FILTER (WHERE distance_m < 0 OR distance_m > 300000) AS distances_hors_bornes,
  min(distance_m) AS plus_petite_distance, max(distance_m) AS plus_grande_distance
FROM raw_activites"""))
def dq_metrics(t: TestTables):
    return t.activities.agg(
        Q.row_count().alias("lignes"),
        Q.missing("id_salarie")().alias("salaries_manquants"),
        Q.missing("distance_m")().alias("distances_manquantes"),
        Q.out_of_range("distance_m", 0, L.MAX_DISTANCE_M)().alias("distances_hors_bornes"),
        F.min("distance_m").alias("plus_petite_distance"),
        F.max("distance_m").alias("plus_grande_distance"),
    )


@query("dq_duplicate_keys", oracle("""
SELECT execution_id, controle, count(*) AS n FROM qualite_checks
GROUP BY 1, 2 HAVING count(*) > 1"""))
def dq_duplicate_keys(t: TestTables):
    return duplicate_keys(t.quality_checks, "execution_id", "controle")


@query("dq_reference_orphans", oracle("""
SELECT id_salarie, count(*) AS n FROM raw_activites
WHERE id_salarie IS NOT NULL AND id_salarie NOT IN (SELECT id_salarie FROM raw_distances)
GROUP BY 1"""))
def dq_reference_orphans(t: TestTables):
    """Activities of employees without a measured commute."""
    return orphan_counts(t.activities, "id_salarie", t.distances, "id_salarie")


@query("dq_inconsistent_dates", oracle(f"""
SELECT type_activite, count(*) FILTER
  (WHERE date_fin <= date_debut OR {MICROS} >= 86400000000) AS n
FROM raw_activites GROUP BY 1"""))
def dq_inconsistent_dates(t: TestTables):
    return t.activities.groupBy("type_activite").agg(Q.inconsistent_dates().alias("n"))


@query("dq_implausible_speeds", oracle(f"""
SELECT type_activite, count(*) FILTER (WHERE distance_m > 0 AND date_fin > date_debut
  AND CAST(distance_m AS BIGINT) * 3600000 > CAST(vitesse_max_kmh AS BIGINT) * {MICROS}) AS n
FROM raw_activites LEFT JOIN vitesses_max USING (type_activite) GROUP BY 1"""))
def dq_implausible_speeds(t: TestTables):
    limited = t.activities.join(t.speed_limits, "type_activite", "left")
    return limited.groupBy("type_activite").agg(Q.implausible_speeds().alias("n"))


@query("dq_out_of_range_percent", oracle("""
SELECT type_activite,
  100.0 * count(*) FILTER (WHERE distance_m < 0 OR distance_m > 300000) / count(*) AS pourcentage
FROM raw_activites GROUP BY 1"""))
def dq_out_of_range_percent(t: TestTables):
    percent = Q.percent_out_of_range("distance_m", 0, L.MAX_DISTANCE_M)
    return t.activities.groupBy("type_activite").agg(percent().alias("pourcentage"))


@query("dq_row_count_match", oracle(check_sql(lambda c: c.same_rows_as)))
def dq_row_count_match(t: TestTables):
    return evaluated(t, [c for c in Q.standard_checks(AS_OF_TIME) if c.same_rows_as])


@query("dq_freshness", oracle("""
SELECT 'activites' AS objet, (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(charge_le))) / 1000.0
  AS age_ms FROM raw_activites
UNION ALL
SELECT 'distances', (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(calcule_le))) / 1000.0
FROM raw_distances"""))
def dq_freshness(t: TestTables):
    def age(table, column, name):
        value = Q.age_ms(column, AS_OF_TIME)().alias("age_ms")
        return table.agg(value).select(F.lit(name).alias("objet"), "age_ms")

    return age(t.activities, "charge_le", "activites").unionByName(
        age(t.distances, "calcule_le", "distances")
    )


@query("dq_last_run_summary", oracle("""
SELECT fichier_controle, resultat, count(*) AS controles FROM qualite_checks
WHERE execution_id = (SELECT max_by(execution_id, verifie_le) FROM qualite_checks)
GROUP BY 1, 2"""))
def dq_last_run_summary(t: TestTables):
    """Outcome counts of the newest run."""
    checks = t.quality_checks
    newest = checks.agg(F.max_by("execution_id", "verifie_le")).scalar()
    return count_by(
        checks.where(F.col("execution_id") == newest), "fichier_controle", "resultat",
        name="controles",
    )


@query("dq_last_run_failures", oracle("""
SELECT table_verifiee, controle, resultat, valeur FROM qualite_checks
WHERE execution_id = (SELECT max_by(execution_id, verifie_le) FROM qualite_checks)
  AND resultat <> 'pass'"""))
def dq_last_run_failures(t: TestTables):
    checks = t.quality_checks
    newest = checks.agg(F.max_by("execution_id", "verifie_le")).scalar()
    rows = checks.where((F.col("execution_id") == newest) & (F.col("resultat") != L.CHECK_PASS))
    return rows.select("table_verifiee", "controle", "resultat", "valeur")


@query("dq_parameters", oracle("""
SELECT CAST(1 AS INTEGER) AS numero, 'taux de prime hors bornes' AS controle, CAST(count(*) FILTER (
    WHERE c_custkey % 40 > 20) AS DOUBLE) AS valeur, if(count(*) FILTER (WHERE c_custkey % 40 > 20) > 0, 'fail', 'pass')
    AS resultat FROM customer
UNION ALL
SELECT 2, 'nombre minimal d''activités hors bornes', CAST(count(*) FILTER (WHERE c_custkey % 500 = 0 OR c_custkey % 500 > 365)
    AS DOUBLE), 'fail' FROM customer
UNION ALL
SELECT 3, 'une seule ligne', CAST(count(*) AS DOUBLE), 'fail' FROM customer
UNION ALL
SELECT 4, 'colonnes attendues', CAST(2 AS DOUBLE), 'fail'"""))
def dq_parameters(t: TestTables):
    """The checks of the parameter table on a row of parameters for each customer, many of them out of bounds."""
    number = F.col("c_custkey")
    rows = t.read("customer").select(
        (number % 40 / 100).cast("decimal(21,12)").alias("taux_prime"),
        (number % 500).cast("decimal(18,6)").alias("nb_activites_min"),
    )
    names = ("taux de prime hors bornes", "nombre minimal d'activités hors bornes", "une seule ligne")
    known = {c.name: c for c in Q.standard_checks(AS_OF_TIME) if c.table == "parametres"}
    lost = Q.Check("analytics", "parametres", "colonnes attendues", fail=Q.above(0),
                   required=("taux_prime", "periode_jours", "jours_travailles_an"))
    found = Q.evaluate(t.spark, {"parametres": rows}, [*[known[n] for n in names], lost])
    return found.select("numero", "controle", "valeur", "resultat")


# --- model tests ------------------------------------------------------------------------------

@query("assert_status_values", oracle("""
SELECT statut_declaration,
  statut_declaration IN ('non concerné', 'non vérifiée', 'conforme', 'suspecte') AS connu,
  count(*) AS n FROM avantages_salaries GROUP BY 1, 2"""))
def assert_status_values(t: TestTables):
    known = F.col("statut_declaration").isin(*L.DECLARATION_STATUSES)
    return count_by(t.benefits().withColumn("connu", known), "statut_declaration", "connu")


@query("activities_before_hire", oracle("""
SELECT id_activite, id_salarie, CAST(date_activite AS VARCHAR) AS date_activite,
  CAST(date_embauche AS VARCHAR) AS date_embauche
FROM stg_activites JOIN stg_salaries USING (id_salarie) WHERE date_activite < date_embauche"""))
def activities_before_hire(t: TestTables):
    return assertions.activities_before_hire(t.stg_activities, t.stg_salaries)


def spoiled_benefits(t: TestTables) -> DataFrame:
    """Negative bonuses, wellness costs without eligibility, and bonuses that are a cent too high."""
    key, cent = F.col("id_salarie"), F.lit("0.01").cast("decimal(18,2)")
    bonus, cost = F.col("montant_prime"), F.col("cout_bien_etre")
    return t.benefits().withColumns({
        "montant_prime": F.when(key % 7 == 0, -cent).when(key % 5 == 0, bonus + cent).otherwise(bonus),
        "cout_bien_etre": F.when(key % 11 == 0, cent).otherwise(cost),
    })


@query("assert_costs", oracle("""
SELECT id_salarie FROM avantages_salaries WHERE id_salarie % 7 = 0
UNION SELECT id_salarie FROM avantages_salaries WHERE id_salarie % 11 = 0 AND NOT eligible_bien_etre
UNION SELECT id_salarie FROM avantages_salaries WHERE id_salarie % 5 = 0 AND NOT eligible_prime"""))
def assert_costs(t: TestTables):
    return assertions.incoherent_costs(spoiled_benefits(t)).select("id_salarie")


# Name -> what is added to a measure of the summary; the first and the last form are sound.
SPOILED_SUMMARIES = {
    "juste": ("nb_salaries", 0),
    "trop de primes": ("nb_eligibles_prime", 10**9),
    "trop de trajets": ("nb_trajets_sportifs", 10**9),
    "trop de bien-etre": ("nb_eligibles_bien_etre", 10**9),
    "cout faux": ("cout_total", 1),
    "cout presque juste": ("cout_total", 0.005),
}


@query("assert_kpi", oracle("""
SELECT unnest(['trop de primes', 'trop de trajets', 'trop de bien-etre', 'cout faux']) AS cas,
  nb_salaries FROM kpi_synthese"""))
def assert_kpi(t: TestTables):
    """Which spoiled forms of the summary are found out."""
    cases = None
    for name, (measure, added) in SPOILED_SUMMARIES.items():
        spoiled = t.kpi().withColumns({
            "cas": F.lit(name), measure: (F.col(measure) + F.lit(added)).cast("double"),
        })
        cases = spoiled if cases is None else cases.unionByName(spoiled)
    return assertions.incoherent_kpi(cases, t.benefits()).select(
        "cas", F.col("nb_salaries").cast("long").alias("nb_salaries")
    )


@query("assert_bonus", oracle("""
SELECT id_salarie, montant_prime AS montant_attendu FROM avantages_salaries
WHERE eligible_prime AND (id_salarie % 5 = 0 OR id_salarie % 7 = 0)"""))
def assert_bonus(t: TestTables):
    found = assertions.wrong_bonus(spoiled_benefits(t), t.stg_salaries, Params())
    return found.select("id_salarie", "montant_attendu")


def _model_test_sql() -> str:
    """Expected numbers: repeated and missing keys counted, the others as many as were put in."""
    keys = {
        "salaries": ("raw_salaries", "id_salarie"),
        "sports": ("raw_sports", "id_salarie"),
        "raw_activites": ("raw_activites", "id_activite"),
        "distances": ("raw_distances", "id_salarie"),
        "avantages_salaries": ("avantages_salaries", "id_salarie"),
        "activites": ("activites", "id_activite"),
        "vitesses_max": ("vitesses_max", "type_activite"),
    }
    row = "SELECT '{0}' AS test, '{1}' AS gravite, {2} AS violations"
    people = "(SELECT count(*) FROM avantages_salaries WHERE {0})"
    parts = []
    for name, (table, key) in keys.items():
        repeated, missing = DUPLICATES.format(table, key), f"(SELECT count(*) - count({key}) FROM {table})"
        if name == "activites":  # every hundredth activity stands there twice
            repeated = "(SELECT count(*) FROM activites WHERE id_activite % 100 = 0)"
        parts += [row.format(f"{name}.{key} unique", "error", repeated),
                  row.format(f"{name}.{key} renseigné", "error", missing)]
    injected = {
        "avantages_salaries.statut_declaration renseigné": "id_salarie % 17 = 0",
        "avantages_salaries.montant_prime renseigné": "id_salarie % 19 = 0",
        "avantages_salaries.cout_bien_etre renseigné": "false",
        "avantages_salaries statuts connus": "id_salarie % 13 = 0 AND id_salarie % 17 <> 0",
        "montant de prime":
            "eligible_prime AND id_salarie % 19 <> 0 AND (id_salarie % 5 = 0 OR id_salarie % 7 = 0)",
    }
    parts += [row.format(name, "error", people.format(condition)) for name, condition in injected.items()]
    parts.append(row.format("coûts cohérents", "error", """(SELECT count(*) FROM (
      SELECT id_salarie FROM avantages_salaries WHERE id_salarie % 7 = 0 AND id_salarie % 19 <> 0
      UNION SELECT id_salarie FROM avantages_salaries WHERE id_salarie % 11 = 0 AND NOT eligible_bien_etre
      UNION SELECT id_salarie FROM avantages_salaries
      WHERE id_salarie % 5 = 0 AND id_salarie % 19 <> 0 AND NOT eligible_prime))"""))
    # The cents and gaps that were put in add up to another total than that of the summary.
    parts.append(row.format("synthèse cohérente", "error", "CAST(1 AS BIGINT)"))
    parts.append(row.format("activites salarié connu", "warn", "2 * " + "(SELECT count(*) FROM activites WHERE id_activite % 100 = 0)"))
    parts.append(row.format("activités avant embauche", "warn", """(SELECT count(*) FROM stg_activites
      JOIN stg_salaries USING (id_salarie) WHERE date_activite < date_embauche AND id_activite % 100 <> 0)"""))
    return "\nUNION ALL\n".join(parts)


@query("model_tests", oracle(_model_test_sql()))
def model_tests(t: TestTables):
    """Violations of each of the 23 model tests, over stored marts into which some were put.

    Every hundredth activity is stored twice under an unknown employee; bonuses and costs are spoiled as in
    the tests of amounts, and some statuses and amounts are unknown or missing.
    """
    params, key = Params(), F.col("id_salarie")
    hundredth = F.col("id_activite") % 100 == 0
    activities = t.activity_mart.withColumn(
        "id_salarie", F.when(hundredth, F.lit(-1)).otherwise(F.col("id_salarie"))
    )
    copies = F.explode(F.when(hundredth, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    mart = written(activities.withColumn("copie", copies).drop("copie"), "activites")
    benefits = spoiled_benefits(t).withColumns({
        "statut_declaration": F.when(key % 17 != 0, F.when(key % 13 == 0, "inconnu").otherwise(
            F.col("statut_declaration"))),
        "montant_prime": F.when(key % 19 != 0, F.col("montant_prime")),
    })
    return assertions.model_tests(
        checked_tables(t, SOURCES), written(benefits, "avantages"), mart, t.kpi(), mart, t.stg_salaries, params
    )
