"""Queries over the report measures and the operational tables."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from trailperks import schemas
from trailperks.catalog.models import STRICT
from trailperks.catalog.oracle import half_up, money, oracle
from trailperks.catalog.registry import query
from trailperks.operators import bi, marts, ops
from trailperks.operators.joins import count_by
from trailperks.session import new_run_folder
from trailperks.sources import seeds
from trailperks.sources.testdata import TestTables

NOW = datetime(2001, 8, 1, tzinfo=timezone.utc)
HUNDREDTHS = "CAST(sum(CAST(round(distance_km * 100) AS BIGINT)) AS DOUBLE) / 100.0"


def dated(t: TestTables) -> DataFrame:
    """Activities with month and weekday: the mart without its employee columns, which these
    series do not use."""
    return marts.with_calendar(t.stg_activities)


@query("bi_measures", oracle(f"""
SELECT {money("montant_prime")} AS cout_prime, {money("cout_bien_etre")} AS cout_bien_etre,
  {money("montant_prime + cout_bien_etre")} AS cout_total, count(*) AS nb_salaries,
  count(*) FILTER (WHERE pratique_declaree) AS nb_sportifs_declares,
  count(*) FILTER (WHERE trajet_sportif) AS nb_trajets_sportifs,
  count(*) FILTER (WHERE eligible_prime) AS nb_eligibles_prime,
  count(*) FILTER (WHERE eligible_bien_etre) AS nb_eligibles_bien_etre,
  count(*) FILTER (WHERE eligible_bien_etre) / count(*)::DOUBLE AS part_eligibles_bien_etre,
  count(*) FILTER (WHERE statut_declaration IN ('suspecte', 'non vérifiée'))
    AS declarations_a_verifier,
  count(*) FILTER (WHERE nb_activites >= 55 AND nb_activites < 60) AS proches_du_seuil
FROM avantages_salaries""", STRICT))
def bi_measures(t: TestTables):
    return bi.measures(t.benefits(STRICT), int(STRICT.nb_activites_min))


@query("bi_activity_measures", oracle(f"""
SELECT count(*) AS nb_activites_valides, {HUNDREDTHS} AS distance_totale_km
FROM stg_activites WHERE est_valide"""))
def bi_activity_measures(t: TestTables):
    return bi.activity_measures(dated(t))


@query("bi_monitoring", oracle("""
SELECT strftime(max(fin), '%Y-%m-%d %H:%M:%S') AS derniere_execution,
  count(*) FILTER (WHERE statut = 'echec' AND debut >= TIMESTAMP '2001-07-25') AS etapes_en_echec,
  (SELECT count(*) FROM qualite_checks WHERE resultat <> 'pass'
    AND verifie_le = (SELECT max(verifie_le) FROM qualite_checks)) AS controles_non_conformes
FROM pipeline_runs"""))
def bi_monitoring(t: TestTables):
    return bi.monitoring(t.pipeline_runs, t.quality_checks, NOW)


@query("bi_cost_by_bu", oracle(f"""
SELECT bu, {money("montant_prime + cout_bien_etre")} AS cout_total
FROM avantages_salaries GROUP BY 1""", STRICT))
def bi_cost_by_bu(t: TestTables):
    return bi.cost_by_unit(t.benefits(STRICT))


@query("bi_status_by_mode", oracle("""
SELECT moyen_deplacement,
  count(*) FILTER (WHERE statut_declaration = 'non concerné') AS "non concerné",
  count(*) FILTER (WHERE statut_declaration = 'non vérifiée') AS "non vérifiée",
  count(*) FILTER (WHERE statut_declaration = 'conforme') AS "conforme",
  count(*) FILTER (WHERE statut_declaration = 'suspecte') AS "suspecte"
FROM avantages_salaries GROUP BY 1"""))
def bi_status_by_mode(t: TestTables):
    return bi.status_by_mode(t.benefits())


@query("bi_declarations_to_check", oracle("""
SELECT id_salarie, bu, moyen_deplacement, distance_km, seuil_km, statut_declaration
FROM avantages_salaries WHERE statut_declaration IN ('suspecte', 'non vérifiée')"""))
def bi_declarations_to_check(t: TestTables):
    return bi.declarations_to_check(t.benefits())


@query("bi_commute_points", oracle("""
SELECT id_salarie, distance_km, seuil_km, statut_declaration
FROM avantages_salaries WHERE statut_declaration <> 'non concerné'"""))
def bi_commute_points(t: TestTables):
    return bi.commute_points(t.benefits())


@query("bi_by_month_source", oracle("""
SELECT CAST(mois AS VARCHAR) AS mois, source, count(*) AS nb_activites_valides
FROM activites WHERE est_valide GROUP BY 1, 2"""))
def bi_by_month_source(t: TestTables):
    return bi.valid_by(dated(t), "mois", "source")


@query("bi_by_sport", oracle("""
SELECT type_activite, count(*) AS nb_activites_valides
FROM activites WHERE est_valide GROUP BY 1"""))
def bi_by_sport(t: TestTables):
    return bi.valid_by(dated(t), "type_activite")


@query("bi_by_weekday", oracle("""
SELECT jour_semaine, count(*) AS nb_activites_valides,
  CASE jour_semaine WHEN 1 THEN 'Lundi' WHEN 2 THEN 'Mardi' WHEN 3 THEN 'Mercredi'
    WHEN 4 THEN 'Jeudi' WHEN 5 THEN 'Vendredi' WHEN 6 THEN 'Samedi' ELSE 'Dimanche' END AS jour
FROM activites WHERE est_valide GROUP BY 1"""))
def bi_by_weekday(t: TestTables):
    return bi.valid_by_weekday(dated(t))


@query("bi_employees_by_count", oracle("""
SELECT nb_activites AS nb_activites_min, eligible_bien_etre, count(*) AS nb_salaries
FROM avantages_salaries GROUP BY 1, 2""", STRICT))
def bi_employees_by_count(t: TestTables):
    return bi.employees_by_count(t.benefits(STRICT))


@query("histogram_bins", oracle("""
SELECT nb_activites // 5 * 5 AS nb_activites_min, eligible_bien_etre, count(*) AS nb_salaries
FROM avantages_salaries GROUP BY 1, 2""", STRICT))
def histogram_bins(t: TestTables):
    return bi.employees_by_count(t.benefits(STRICT), width=5)


@query("bi_sliced_activities", oracle("""
SELECT type_activite, count(*) AS nb_activites_valides FROM activites
WHERE est_valide AND id_salarie IN (SELECT id_salarie FROM avantages_salaries
  WHERE bu = 'MACHINERY' AND tranche_age = '50-59 ans')
GROUP BY 1"""))
def bi_sliced_activities(t: TestTables):
    return bi.sliced_valid_by(
        dated(t), t.benefits(), ["type_activite"], bu="MACHINERY", tranche_age="50-59 ans"
    )


@query("bi_sliced_rows", oracle("""
SELECT id_activite, type_activite, distance_km::DOUBLE AS distance_km FROM activites
WHERE id_salarie IN (SELECT id_salarie FROM avantages_salaries
  WHERE bu = 'BUILDING' AND statut_declaration = 'suspecte')"""))
def bi_sliced_rows(t: TestTables):
    """Activities of the employees selected by unit and declaration status."""
    rows = bi.sliced_activities(
        t.stg_activities, t.benefits(), bu="BUILDING", statut_declaration="suspecte"
    )
    return rows.select("id_activite", "type_activite", "distance_km")


# --- operations -------------------------------------------------------------------------------

@query("ingestion_volumes", oracle("""
SELECT 'raw.salaries' AS objet, count(*) AS lignes, max(fichier_source) AS fichier,
  strftime(max(charge_le), '%Y-%m-%d %H:%M:%S') AS charge_le FROM raw_salaries
UNION ALL
SELECT 'raw.sports', count(*), max(fichier_source),
  strftime(max(charge_le), '%Y-%m-%d %H:%M:%S') FROM raw_sports
UNION ALL
SELECT 'raw.noms_salaries', count(*), NULL, NULL FROM raw_salaries"""))
def ingestion_volumes(t: TestTables):
    return ops.ingestion_volumes({
        "raw.salaries": t.salaries,
        "raw.sports": t.sports,
        "raw.noms_salaries": t.salaries.select("id_salarie"),
    })


@query("layer_volumes", oracle("""
SELECT 'staging.stg_activites' AS objet, count(*) AS lignes,
  count(*) FILTER (WHERE est_valide) AS valides FROM stg_activites
UNION ALL SELECT 'analytics.activites', count(*), count(*) FILTER (WHERE est_valide) FROM activites
UNION ALL SELECT 'analytics.avantages_salaries', count(*), NULL FROM avantages_salaries"""))
def layer_volumes(t: TestTables):
    return ops.layer_volumes({
        "staging.stg_activites": t.stg_activities,
        "analytics.activites": t.activity_mart,
        "analytics.avantages_salaries": t.benefits(),
    })


@query("geo_by_mode_status", oracle(f"""
SELECT mode_api, statut, count(*) AS trajets,
  {half_up("sum(distance_m)", "nullif(count(distance_m) * 1000, 0)", 1)} AS km_moyen,
  CAST(round(max(distance_m) * 0.001, 1) AS DOUBLE) AS km_max,
  strftime(max(calcule_le), '%Y-%m-%d %H:%M:%S') AS calcule_le
FROM raw_distances GROUP BY 1, 2"""))
def geo_by_mode_status(t: TestTables):
    return ops.distances_by_mode_status(t.distances)


@query("geo_status_counts", oracle("SELECT statut, count(*) AS n FROM raw_distances GROUP BY 1"))
def geo_status_counts(t: TestTables):
    return count_by(t.distances, "statut")


@query("count_by_source", oracle("SELECT source, count(*) AS n FROM raw_activites GROUP BY 1"))
def count_by_source(t: TestTables):
    return count_by(t.activities, "source")


@query("seed_speed_limits", oracle("""
SELECT type_activite, CAST(vitesse_max_kmh AS DOUBLE) AS vitesse_max_kmh, coalesce(n, 0) AS n
FROM vitesses_max LEFT JOIN (SELECT type_activite, count(*) AS n FROM raw_activites GROUP BY 1)
  USING (type_activite)"""))
def seed_speed_limits(t: TestTables):
    """The speed limits, fastest sport first, with the activities each one governs."""
    used = count_by(t.activities, "type_activite")
    listed = t.speed_limits.join(used, "type_activite", "left")
    return listed.withColumn("n", F.coalesce("n", F.lit(0))).orderBy(
        F.desc("vitesse_max_kmh"), "type_activite"
    )


SEED_LINES = """
    SELECT p_partkey AS k, p_name,
      CASE WHEN p_partkey % 7 = 0 THEN 'rapide' WHEN p_partkey % 11 = 0 THEN '12,5'
        ELSE concat(p_size, '.', lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0')) END AS limite
    FROM part"""


@query("seed_file", oracle("""
SELECT 'lue' AS sorte, replace(p_name, '"', '') AS texte, CAST(limite AS DOUBLE) AS vitesse_max_kmh
FROM lignes WHERE k % 7 <> 0 AND k % 11 <> 0 AND k % 13 <> 0
UNION ALL
SELECT 'refusee', concat('"', replace(p_name, '"', ''), '",', CASE WHEN k % 7 = 0 THEN 'rapide'
    WHEN k % 11 = 0 THEN '12.5,x' ELSE concat(limite, ',de trop') END), NULL
FROM lignes WHERE k % 7 = 0 OR k % 11 = 0 OR k % 13 = 0""", lignes=SEED_LINES))
def seed_file(t: TestTables):
    """A seed file with a row for each part: typed rows, and the lines that do not fit the declared types."""
    path, key = new_run_folder(t.spark, "seed"), F.col("p_partkey")
    name = F.concat(F.lit('"'), F.replace("p_name", F.lit('"'), F.lit("")), F.lit('"'))
    limit = F.concat(F.col("p_size").cast("string"), F.lit("."), F.lpad((key % 1000).cast("string"), 3, "0"))
    value = (
        F.when(key % 7 == 0, "rapide").when(key % 11 == 0, "12.5,x")
        .when(key % 13 == 0, F.concat(limit, F.lit(",de trop"))).otherwise(limit)
    )
    lines = t.read("part").select(F.concat(name, F.lit(","), value).alias("value"))
    header = t.spark.range(1).select(F.lit("type_activite,vitesse_max_kmh").alias("value"))
    for part in (header.unionByName(lines.where(key % 2 == 0)), header.unionByName(lines.where(key % 2 == 1))):
        part.coalesce(1).write.mode("append").text(path)
    good, bad = seeds.checked_csv(t.spark, path, schemas.SPEED_LIMITS)
    return good.select(F.lit("lue").alias("sorte"), F.col("type_activite").alias("texte"), "vitesse_max_kmh").unionByName(
        bad.select(F.lit("refusee").alias("sorte"), F.col(seeds.BAD_ROW).alias("texte"),
                   F.lit(None).cast("decimal(9,3)").alias("vitesse_max_kmh"))
    )


RUN_COLUMNS = """etape, statut, nb_lignes, message, strftime(fin, '%Y-%m-%d %H:%M:%S') AS fin"""


@query("ops_recent_runs", oracle(f"""
SELECT {RUN_COLUMNS} FROM pipeline_runs AS r WHERE etape <> 'chargement_activites'
ORDER BY r.fin DESC, id_run DESC LIMIT 8"""))
def ops_recent_runs(t: TestTables):
    return ops.recent_runs(t.pipeline_runs).select(
        "etape", "statut", "nb_lignes", "message", "fin"
    )


@query("ops_recent_findings", oracle("""
SELECT strftime(q.verifie_le, '%Y-%m-%d %H:%M:%S') AS verifie_le, fichier_controle, table_verifiee,
  controle, resultat, valeur
FROM qualite_checks AS q WHERE resultat <> 'pass'
ORDER BY q.verifie_le DESC, table_verifiee, controle, valeur, fichier_controle, resultat LIMIT 10"""))
def ops_recent_findings(t: TestTables):
    return ops.recent_findings(t.quality_checks).select(
        "verifie_le", "fichier_controle", "table_verifiee", "controle", "resultat", "valeur"
    )


@query("ops_runs_summary", oracle("""
SELECT etape, statut, count(*) AS executions, CAST(sum(nb_lignes) AS BIGINT) AS lignes,
  strftime(max(fin), '%Y-%m-%d %H:%M:%S') AS derniere
FROM pipeline_runs GROUP BY 1, 2"""))
def ops_runs_summary(t: TestTables):
    return ops.runs_summary(t.pipeline_runs)


@query("ops_volume_by_step", oracle("""
SELECT etape, CAST(sum(nb_lignes) AS BIGINT) AS lignes FROM pipeline_runs GROUP BY 1"""))
def ops_volume_by_step(t: TestTables):
    return ops.rows_by_step(t.pipeline_runs)
