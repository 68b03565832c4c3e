"""Queries over the population profile."""

from datetime import date

from pyspark.sql import functions as F

from trailperks import schemas
from trailperks.catalog.oracle import oracle
from trailperks.catalog.registry import query
from trailperks.functions import text
from trailperks.operators import places, profiling as P, sketches
from trailperks.operators.joins import count_by, null_safe_left_join
from trailperks.params import Params
from trailperks.session import new_run_folder, written
from trailperks.sources import reference_files, seeds
from trailperks.sources.layers import Layers
from trailperks.sources.seeds import COMPANY_TOWN
from trailperks.sources.reference_files import HR_FILE, SPORT_FILE
from trailperks.sources.testdata import AS_OF, TestTables

PATTERN = r"(\d{5})\s+([^,\d][^,]*)$"
TODAY = "DATE '2024-01-31'"
POPULATION = f"""
    SELECT *, CASE WHEN age > 0 AND age <= 99 THEN CASE WHEN age <= 29 THEN '< 30 ans'
        WHEN age <= 39 THEN '30-39 ans' WHEN age <= 49 THEN '40-49 ans'
        WHEN age <= 59 THEN '50-59 ans' ELSE '60 ans et +' END END AS tranche_age,
      substr(code_postal, 1, 2) AS departement
    FROM (
      SELECT s.*, sport, sport IS NOT NULL AS pratique_sport,
        CAST(floor(({TODAY} - date_naissance) / 365.25) AS INTEGER) AS age,
        ({TODAY} - date_embauche) / 365.25::DOUBLE AS anciennete,
        (date_embauche - date_naissance) / 365.25::DOUBLE AS age_embauche,
        nullif(regexp_extract(adresse, '{PATTERN}', 1), '') AS code_postal,
        trim(coalesce(nullif(regexp_extract(adresse, '{PATTERN}', 2), ''),
          list_last(string_split(adresse, ',')))) AS commune,
        moyen_deplacement IN ('Marche/running', 'Vélo/Trottinette/Autres') AS trajet_sportif
      FROM raw_salaries s LEFT JOIN (
        SELECT id_salarie, nullif(CASE trim(pratique_sport) WHEN 'Runing' THEN 'Course à pied'
          ELSE trim(pratique_sport) END, '') AS sport FROM raw_sports) p
      ON p.id_salarie = s.id_salarie)"""
POINT = "(SELECT {0} FROM communes WHERE commune = 'Lattes')"
HAVERSINE = (
    "2 * 6371.0 * asin(sqrt(power(sin(radians({lat} - lat) / 2), 2) + cos(radians(lat)) "
    "* cos(radians({lat})) * power(sin(radians({lon} - lon) / 2), 2)))"
).format(lat=POINT.format("lat"), lon=POINT.format("lon"))
ESTIMATED = f"""
    SELECT *, coalesce(distance_estimee_km > seuil_km, false) AS declaration_suspecte
    FROM (
      SELECT p.*, c.lat, c.codes_postaux, {HAVERSINE} AS distance_vol_oiseau_km,
        1.3 * {HAVERSINE} AS distance_estimee_km,
        CASE moyen_deplacement WHEN 'Marche/running' THEN 15
          WHEN 'Vélo/Trottinette/Autres' THEN 25 END AS seuil_km
      FROM population p LEFT JOIN communes c ON c.commune = p.commune
        AND c.departement IS NOT DISTINCT FROM p.departement)"""


def profile(select: str) -> str:
    return oracle(select, population=POPULATION, estimees=ESTIMATED)


def people(t: TestTables):
    return P.population(t.salaries, t.sports, AS_OF)


def estimated(t: TestTables):
    return P.estimated_commutes(people(t), t.towns, COMPANY_TOWN)


@query("employee_sport_left_join", oracle("""
SELECT s.id_salarie, CAST(date_embauche AS VARCHAR) AS date_embauche, trim(pratique_sport) AS sport
FROM raw_salaries s LEFT JOIN raw_sports p ON p.id_salarie = s.id_salarie"""))
def employee_sport_left_join(t: TestTables):
    return P.employee_sports(t.salaries, t.sports)


def missing_sql(file: str, table: str, columns: list[str]) -> str:
    counts = ", ".join(f"count(*) - count({c}) AS {c}" for c in columns)
    return (
        f"SELECT '{file}' AS fichier, colonne, manquants FROM (SELECT {counts} FROM {table}) "
        f"UNPIVOT (manquants FOR colonne IN ({', '.join(columns)}))"
    )


HR_COLUMNS, SPORT_COLUMNS = (list(file.columns.values()) for file in (HR_FILE, SPORT_FILE))


@query("null_profile", oracle(" UNION ALL ".join([
    missing_sql("rh", "raw_salaries", HR_COLUMNS),
    missing_sql("sport", "raw_sports", SPORT_COLUMNS),
    missing_sql("activites", "raw_activites", schemas.RAW_ACTIVITIES.fieldNames()),
])))
def null_profile(t: TestTables):
    """Missing values of every column of both files and of the activities."""
    frames = {
        "rh": t.salaries.select(*HR_COLUMNS), "sport": t.sports.select(*SPORT_COLUMNS),
        "activites": t.activities.select(*schemas.RAW_ACTIVITIES.fieldNames()),
    }
    parts = [P.null_profile(f).select(F.lit(n).alias("fichier"), "*") for n, f in frames.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("id_set_differences", oracle("""
SELECT 'gauche' AS sens, count(*) AS n FROM raw_salaries
WHERE id_salarie NOT IN (SELECT id_salarie FROM raw_distances)
UNION ALL
SELECT 'droite', count(*) FROM raw_distances
WHERE id_salarie NOT IN (SELECT id_salarie FROM raw_salaries)"""))
def id_set_differences(t: TestTables):
    return P.id_differences(t.salaries, t.distances, "id_salarie")


@query("unknown_labels", oracle("""
SELECT sport_declare, count(*) AS n FROM stg_sports
WHERE sport_declare IS NOT NULL
  AND sport_declare NOT IN (SELECT type_activite FROM raw_activites)
GROUP BY 1"""))
def unknown_labels(t: TestTables):
    """Declared sports that are the type of no recorded activity."""
    used = t.activities.select(F.col("type_activite").alias("sport_declare")).distinct()
    declared = t.stg_sports.where(F.col("sport_declare").isNotNull())
    return count_by(declared, "sport_declare").join(used, "sport_declare", "left_anti")


@query("hr_sanity_counts", profile(f"""
SELECT 'Embauche dans le futur' AS controle, count(*) AS lignes
FROM population WHERE date_embauche > {TODAY}
UNION ALL SELECT 'Embauché avant 16 ans', count(*) FROM population WHERE age_embauche < 16
UNION ALL SELECT 'Âge hors 16-70 ans', count(*) FROM population WHERE age NOT BETWEEN 16 AND 70
UNION ALL SELECT 'Salaire <= 0', count(*) FROM population WHERE salaire_brut <= 0
UNION ALL SELECT 'Jours de CP hors 0-40', count(*) FROM population
WHERE jours_cp NOT BETWEEN 0 AND 40"""))
def hr_sanity_counts(t: TestTables):
    return P.sanity_counts(people(t), AS_OF)


def _describe(column: str, table: str, group: str = "") -> str:
    keys = f"{group}, " if group else ""
    return f"""
SELECT {keys}'{column}' AS colonne, count({column}) AS count, round(avg({column}), 1) AS mean,
  round(stddev_samp({column}), 1) AS std, round(min({column})::DOUBLE, 1) AS min,
  round(quantile_cont({column}::DOUBLE, 0.25), 1) AS p25,
  round(quantile_cont({column}::DOUBLE, 0.5), 1) AS p50,
  round(quantile_cont({column}::DOUBLE, 0.75), 1) AS p75,
  round(max({column})::DOUBLE, 1) AS max FROM {table} {"GROUP BY " + group if group else ""}"""


@query("numeric_profile", profile("\nUNION ALL\n".join(
    _describe(c, "population") for c in ("age", "anciennete", "salaire_brut", "jours_cp"))))
def numeric_profile(t: TestTables):
    return P.describe(people(t), ["age", "anciennete", "salaire_brut", "jours_cp"])


@query("geo_estimate_profile", profile(
    _describe("distance_estimee_km", "estimees", "moyen_deplacement")))
def geo_estimate_profile(t: TestTables):
    return P.describe(estimated(t), ["distance_estimee_km"], "moyen_deplacement")


@query("value_counts_share", profile("""
SELECT sport, count(*) AS n, count(*) / sum(count(*)) OVER () AS part
FROM population WHERE sport IS NOT NULL GROUP BY 1"""))
def value_counts_share(t: TestTables):
    return P.value_shares(people(t), "sport")


def _rate(key: str) -> str:
    return profile(f"""
SELECT {key}, CAST(count(*) FILTER (WHERE pratique_sport) AS BIGINT) AS sportifs,
  count(*) AS effectif, count(*) FILTER (WHERE pratique_sport) / count(*)::DOUBLE AS taux
FROM population GROUP BY 1""")


@query("practice_rate_by_group", _rate("bu"))
def practice_rate_by_group(t: TestTables):
    return P.practice_rate(people(t), "bu")


@query("practice_rate_by_age", _rate("tranche_age"))
def practice_rate_by_age(t: TestTables):
    return P.practice_rate(people(t), "tranche_age")


@query("crosstab_margins", profile("""
SELECT coalesce(moyen_deplacement, 'Total') AS moyen_deplacement,
  count(*) FILTER (WHERE NOT pratique_sport) AS "Aucun sport",
  count(*) FILTER (WHERE pratique_sport) AS "Sport déclaré", count(*) AS "Total"
FROM population GROUP BY ROLLUP (moyen_deplacement)"""))
def crosstab_margins(t: TestTables):
    return P.crosstab(people(t))


@query("distinct_and_singletons", oracle("""
SELECT count(*) AS distincts, count(*) FILTER (WHERE n = 1) AS uniques
FROM (SELECT adresse, count(*) AS n FROM raw_salaries GROUP BY 1)"""))
def distinct_and_singletons(t: TestTables):
    return P.distinct_and_singletons(t.salaries, "adresse")


@query("top_groups", profile("""
SELECT commune, count(*) AS n FROM population GROUP BY 1 ORDER BY n DESC, commune LIMIT 15"""))
def top_groups(t: TestTables):
    return P.top_values(people(t), "commune", 15)


@query("top_sport", profile("""
SELECT sport, count(*) AS n FROM population WHERE sport IS NOT NULL
GROUP BY 1 ORDER BY n DESC, sport LIMIT 1"""))
def top_sport(t: TestTables):
    return P.top_values(people(t), "sport", 1)


@query("age_histogram", profile("""
SELECT CAST(least((age - 20) // 5 * 5 + 20, 60) AS INTEGER) AS borne, count(*) AS n
FROM population WHERE age BETWEEN 20 AND 65 GROUP BY 1"""))
def age_histogram(t: TestTables):
    return P.histogram(people(t), F.col("age"), 20, 65, 5)


@query("seniority_histogram", profile("""
SELECT CAST(floor(anciennete) AS INTEGER) AS borne, count(*) AS n FROM population GROUP BY 1"""))
def seniority_histogram(t: TestTables):
    return P.unit_histogram(people(t), F.col("anciennete"))


@query("distinct_places", profile("SELECT DISTINCT commune, departement FROM population"))
def distinct_places(t: TestTables):
    return P.distinct_places(people(t))


@query("department_counts", profile("""
SELECT CASE departement WHEN '34' THEN 'Hérault (34)' WHEN '30' THEN 'Gard (30)' ELSE 'Autre' END
  AS departement, count(*) AS n FROM population GROUP BY 1"""))
def department_counts(t: TestTables):
    labelled = people(t).withColumn("departement", text.department_label(F.col("departement")))
    return count_by(labelled, "departement")


@query("address_split", profile("""
SELECT id_salarie, code_postal, commune, departement FROM population"""))
def address_split(t: TestTables):
    return people(t).select("id_salarie", "code_postal", "commune", "departement")


@query("address_quality", profile("""
SELECT count(*) FILTER (WHERE code_postal IS NULL) AS sans_code_postal,
  count(*) FILTER (WHERE NOT contains(adresse, ',')) AS sans_virgule FROM population"""))
def address_quality(t: TestTables):
    return P.address_quality(people(t))


@query("place_name_match", oracle("""
SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN 'Montpellier' WHEN 1 THEN 'Nîmes'
    WHEN 2 THEN 'Mèze' WHEN 3 THEN 'Pérols' END AS nom_officiel,
  CASE c_custkey % 5 WHEN 0 THEN '34172' WHEN 1 THEN '30189' WHEN 2 THEN '34157'
    WHEN 3 THEN '34198' END AS code_insee
FROM customer"""))
def place_name_match(t: TestTables):
    """Town names in other spellings, matched to the official ones."""
    spellings = F.array(*[F.lit(n) for n in ("MONTPELLIER", "nimes", "Méze", "perols ", "Sète")])
    names = t.read("customer").select(
        F.col("c_custkey").alias("id"),
        F.get(spellings, (F.col("c_custkey") % 5).cast("int")).alias("commune"),
    )
    return P.matched_towns(names, t.towns).drop("commune")


ASKED = """
    SELECT n_nationkey AS k, n_name, (n_nationkey + 1) % (SELECT count(*) FROM nation) AS suivant FROM nation"""


@query("place_candidates", oracle("""
SELECT DISTINCT concat('commune-', a.k) AS departement,
  CASE WHEN a.k % 5 = 0 THEN b.n_name ELSE a.n_name END AS nom_officiel,
  CAST(CASE WHEN a.k % 5 = 0 THEN a.suivant ELSE a.k END AS VARCHAR) AS code_insee,
  CAST(CASE WHEN a.k % 5 = 0 THEN a.suivant ELSE a.k END + 0.5 AS DOUBLE) AS lat,
  CASE WHEN a.k % 5 = 0 THEN '' ELSE '1|2' END AS codes_postaux
FROM customer JOIN demandes a ON a.k = c_nationkey JOIN demandes b ON b.k = a.suivant
WHERE a.k % 7 <> 3""", demandes=ASKED))
def place_candidates(t: TestTables):
    """The town chosen for each name that customers use, from JSON lists of candidates.

    The name comes in other letters than the official one; in some lists it is the second candidate, in
    some it is missing, and some lists are empty or cut off.
    """
    nations = t.read("nation").select(F.col("n_nationkey").cast("int").alias("k"), F.col("n_name").alias("nom"))
    size = nations.agg(F.count(F.lit(1))).scalar()
    other = nations.select(F.col("k").alias("suivant"), F.col("nom").alias("autre"))
    letters = ("AEIOUNSC", "ąėįőůñšç")
    asked = nations.withColumn("suivant", ((F.col("k") + 1) % size).cast("int")).join(other, "suivant")

    def entry(key, name, *codes):
        point = F.struct(F.array(F.lit(3.0), key + F.lit(0.5)).alias("coordinates"))
        return F.struct(name.alias("nom"), key.cast("string").alias("code"), point.alias("centre"),
                        F.array(*[F.lit(c) for c in codes]).cast("array<string>").alias("codesPostaux"))

    key, name = F.col("k"), F.col("nom")
    near, exact = entry(F.col("suivant"), F.col("autre")), entry(key, name, "1", "2")
    listed = F.to_json(F.when(key % 5 == 0, F.array(near)).otherwise(F.array(near, exact)))
    used = t.read("customer").select(F.col("c_nationkey").cast("int").alias("k")).distinct()
    answers = asked.join(used, "k").select(
        F.translate(F.replace(name, F.lit(" "), F.lit("-")), *letters).alias("commune"),
        F.concat(F.lit("commune-"), key).alias("departement"),
        F.when(key % 14 == 3, "[]").when(key % 7 == 3, F.substring(listed, 1, 9)).otherwise(listed).alias("reponse"),
    )
    found = places.chosen(places.candidates(answers))
    return found.select("departement", "nom_officiel", "code_insee", "lat", "codes_postaux")


@query("geo_cache_scan", profile("""
SELECT c.commune, c.departement, nom_officiel, code_insee, CAST(lat AS DOUBLE) AS lat,
  CAST(lon AS DOUBLE) AS lon, codes_postaux, count(id_salarie) AS salaries
FROM communes c LEFT JOIN population p ON p.commune = c.commune
  AND p.departement IS NOT DISTINCT FROM c.departement
GROUP BY ALL"""))
def geo_cache_scan(t: TestTables):
    """The cached towns from a CSV file, codes kept as text, with the employees living there."""
    path = new_run_folder(t.spark, "communes")
    t.towns.coalesce(1).write.csv(path, header=True)
    cached = seeds.towns(t.spark, path)
    lived = count_by(people(t), "commune", "departement", name="salaries")
    joined = null_safe_left_join(cached, lived, ["commune", "departement"])
    return joined.withColumn("salaries", F.coalesce("salaries", F.lit(0)))


@query("geo_estimate", profile("""
SELECT id_salarie, commune, departement, round(distance_vol_oiseau_km, 6) AS distance_vol_oiseau_km,
  round(distance_estimee_km, 6) AS distance_estimee_km, seuil_km, declaration_suspecte
FROM estimees"""))
def geo_estimate(t: TestTables):
    return estimated(t).select(
        "id_salarie", "commune", "departement",
        F.round("distance_vol_oiseau_km", 6).alias("distance_vol_oiseau_km"),
        F.round("distance_estimee_km", 6).alias("distance_estimee_km"),
        "seuil_km", "declaration_suspecte",
    )


@query("suspects_ranked", profile("""
SELECT id_salarie, moyen_deplacement, commune, round(distance_estimee_km, 1) AS distance_estimee_km,
  seuil_km, round(distance_estimee_km - seuil_km, 1) AS depassement_km
FROM estimees WHERE declaration_suspecte"""))
def suspects_ranked(t: TestTables):
    return P.suspects_ranked(estimated(t))


@query("postcode_consistency", profile("""
SELECT id_salarie, code_postal, commune, codes_postaux,
  CASE WHEN codes_postaux IS NOT NULL
    THEN coalesce(list_contains(string_split(codes_postaux, '|'), code_postal), false) END
    AS cp_coherent
FROM estimees"""))
def postcode_consistency(t: TestTables):
    return P.postcode_consistency(estimated(t))


@query("cost_scenarios", profile("""
SELECT 'Prime : toutes les déclarations' AS scenario, count(*) AS beneficiaires,
  CAST(round_even(sum(salaire_brut) * 0.05, 0) AS BIGINT) AS cout_annuel
FROM estimees WHERE trajet_sportif
UNION ALL
SELECT 'Prime : hors déclarations suspectes', count(*),
  CAST(round_even(sum(salaire_brut) * 0.05, 0) AS BIGINT)
FROM estimees WHERE trajet_sportif AND NOT declaration_suspecte
UNION ALL
SELECT 'Journées bien-être (borne haute)', count(*),
  CAST(round_even(sum(salaire_brut) * 5 / 218.0, 0) AS BIGINT)
FROM estimees WHERE pratique_sport"""))
def cost_scenarios(t: TestTables):
    return P.cost_scenarios(estimated(t), Params())


@query("population_summary", profile("""
SELECT count(*) AS nb_salaries, count(*) FILTER (WHERE pratique_sport) AS nb_sportifs,
  count(*) FILTER (WHERE pratique_sport) / count(*)::DOUBLE AS part_sportifs,
  count(*) FILTER (WHERE trajet_sportif) AS nb_trajets,
  count(*) FILTER (WHERE trajet_sportif) / count(*)::DOUBLE AS part_trajets,
  CAST(sum(salaire_brut) AS BIGINT) AS masse_salariale, count(DISTINCT bu) AS nb_bu,
  count(DISTINCT sport) AS nb_sports, quantile_cont(age::DOUBLE, 0.5) AS age_median,
  concat(replace(format('{:,}', CAST(sum(salaire_brut) AS BIGINT)), ',', ' '), ' €')
    AS masse_affichee
FROM population"""))
def population_summary(t: TestTables):
    return P.population_summary(people(t))


WEEK = "date_trunc('week', date_activite)"


def sketches_of(t: TestTables) -> Layers:
    """Sketches per week, those of the last weeks renewed after the first ones were stored."""
    layers = Layers(t.spark, new_run_folder(t.spark, "sketches"))
    mart, week = t.activity_mart, F.trunc("date_activite", "week")
    late = F.col(sketches.PERIOD) >= F.lit(date(2024, 1, 15))
    sketches.refresh(layers, mart.where(F.col("date_activite") < F.lit(date(2024, 1, 18))), week)
    sketches.refresh(layers, mart, week, late)
    return layers


@query("sketch_quantiles", oracle("\nUNION ALL\n".join(
    f"SELECT '{m}' AS mesure, CAST({q} AS DOUBLE) AS part, count({m}) AS n, true AS juste FROM activites"
    for m in ("distance_km", "duree_min") for q in (0.05, 0.25, 0.5, 0.75, 0.95))))
def sketch_quantiles(t: TestTables):
    """Quantiles from merged weekly sketches, each checked against its exact rank."""
    one = sketches.merged(sketches_of(t).read(sketches.SKETCHES))
    found = written(sketches.quantile_estimates(one, (0.05, 0.25, 0.5, 0.75, 0.95)), "estimates")
    return sketches.within_rank_error(t.activity_mart, found)


@query("sketch_distinct", oracle(f"""
SELECT CAST({WEEK} AS DATE)::VARCHAR AS periode, count(*) AS n, true AS juste
FROM activites GROUP BY {WEEK}
UNION ALL SELECT NULL, count(*), true FROM activites"""))
def sketch_distinct(t: TestTables):
    """Active employees per week and over all weeks, each estimate checked against the exact number."""
    table = sketches_of(t).read(sketches.SKETCHES)
    stored = table.select("periode", "n", "hll_salaries")
    everything = sketches.merged(table).select(
        F.lit(None).cast("date").alias("periode"), "n", "hll_salaries"
    )
    estimated = stored.unionByName(everything).withColumn("estimes", F.hll_sketch_estimate("hll_salaries"))
    mart = t.activity_mart.select(F.trunc("date_activite", "week").alias("periode"), "id_salarie")
    exact = mart.groupBy("periode").agg(F.count_distinct("id_salarie").alias("salaries")).unionByName(
        mart.agg(F.count_distinct("id_salarie").alias("salaries")).withColumn("periode", F.lit(None).cast("date"))
    )
    joined = null_safe_left_join(estimated, exact, ["periode"])
    off = F.abs(F.col("estimes") - F.col("salaries"))
    return joined.select("periode", "n", (off <= F.lit(sketches.DISTINCT_ERROR) * F.col("salaries")).alias("juste"))


@query("sketch_top_types", oracle("""
SELECT type_activite, count(*) AS n FROM raw_activites GROUP BY 1"""))
def sketch_top_types(t: TestTables):
    """Activity types by frequency from merged weekly sketches; exact, as there are few."""
    return sketches.top_estimates(sketches.merged(sketches_of(t).read(sketches.SKETCHES)), 50)


@query("activity_leaderboard", oracle("""
SELECT nb_activites >= 60 AS au_moins_60, count(*) AS salaries, max(nb_activites) AS maximum
FROM (SELECT id_salarie, count(*) AS nb_activites FROM raw_activites GROUP BY 1) GROUP BY 1"""))
def activity_leaderboard(t: TestTables):
    """Employees at and below a number of recorded activities."""
    counts = count_by(t.activities, "id_salarie", name="nb_activites")
    reached = (F.col("nb_activites") >= 60).alias("au_moins_60")
    return counts.groupBy(reached).agg(
        F.count(F.lit(1)).alias("salaries"), F.max("nb_activites").alias("maximum")
    )


@query("activity_type_ranking", oracle("""
SELECT type_activite, count(*) AS n FROM raw_activites GROUP BY 1"""))
def activity_type_ranking(t: TestTables):
    return count_by(t.activities, "type_activite").orderBy(F.desc("n"), "type_activite")


@query("activities_sorted", oracle("""
SELECT id_activite, id_salarie, strftime(date_debut, '%Y-%m-%d %H:%M:%S') AS date_debut
FROM raw_activites"""))
def activities_sorted(t: TestTables):
    """All activities in order of their start: a range-partitioned, distributed sort."""
    return t.activities.orderBy("date_debut", "id_activite").select(
        "id_activite", "id_salarie", "date_debut"
    )


@query("names_directory", oracle("""
SELECT id_salarie, trim(prenom) AS prenom, trim(nom) AS nom FROM raw_salaries"""))
def names_directory(t: TestTables):
    return reference_files.names_directory(t.salaries)
