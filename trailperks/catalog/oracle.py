"""SQL side of the registered queries: the bindings and models as common table expressions."""

from __future__ import annotations

from trailperks import labels as L
from trailperks.params import Params
from trailperks.sources.seeds import TOWN_ROWS

AS_OF = "DATE '2024-01-31'"


def quoted(values) -> str:
    return ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def half_up(numerator: str, denominator: str, digits: int, kind: str = "BIGINT") -> str:
    """Rounding half away from zero of an integer ratio."""
    scale = 10**digits
    value = (
        f"(sign(CAST({numerator} AS {kind})) * sign(CAST({denominator} AS {kind})) * "
        f"((2 * abs(CAST({numerator} AS {kind})) * {scale} + abs(CAST({denominator} AS {kind}))) // "
        f"(2 * abs(CAST({denominator} AS {kind})))))"
    )
    return f"CAST({value} AS DOUBLE) / {scale}.0" if digits else f"CAST({value} AS BIGINT)"


def raw_activities(source: str = "events") -> str:
    seconds = (
        "CASE WHEN event_id % 89 = 0 THEN -600 "
        "ELSE 60 * CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) "
        "+ CAST(event_id % 60 AS INTEGER) END"
    )
    return f"""
    SELECT event_id AS id_activite, CAST(user_id AS INTEGER) AS id_salarie, ts AS date_debut,
      CASE event_type WHEN 'click' THEN 'Course à pied' WHEN 'view' THEN 'Marche'
        WHEN 'purchase' THEN 'Vélo' WHEN 'signup' THEN 'Natation' ELSE 'Escalade' END AS type_activite,
      CASE WHEN event_type = 'error' THEN NULL
        WHEN event_id % 97 = 0 THEN -CAST(floor(value * 100) AS INTEGER)
        WHEN event_type = 'signup' THEN CAST(floor(value * 20) AS INTEGER)
        ELSE CAST(floor(value * 100) AS INTEGER) END AS distance_m,
      ts + to_seconds({seconds}) AS date_fin,
      CASE WHEN event_id % 5 = 0 THEN 'Belle séance !' END AS commentaire,
      CASE WHEN event_id % 10 = 0 THEN 'live' ELSE 'backfill' END AS source,
      ts AS cree_le,
      CASE WHEN event_id % 10 = 0 THEN 'c' ELSE 'r' END AS operation,
      ts AS capture_le,
      ts + to_seconds(60) AS charge_le
    FROM {source}"""


ADDRESS = """concat(CAST(c_custkey % 200 AS VARCHAR), ' rue des Tests, ',
        CASE WHEN c_custkey % 31 = 0 THEN ''
          ELSE concat(CAST(34000 + c_custkey % 50 * 10 AS VARCHAR), ' ') END,
        CASE c_nationkey % 5 WHEN 0 THEN 'Montpellier' WHEN 1 THEN 'Lattes' WHEN 2 THEN 'Nîmes'
          WHEN 3 THEN 'Mèze' ELSE 'Pérols' END)"""

RAW_SALARIES = f"""
    SELECT CAST(c_custkey AS INTEGER) AS id_salarie, c_name AS nom,
      concat(' P', CAST(c_custkey % 10 AS VARCHAR), ' ') AS prenom,
      DATE '1960-01-01' + CAST((c_custkey * 53) % 16000 AS INTEGER) AS date_naissance,
      c_mktsegment AS bu,
      DATE '2010-01-01' + CAST(CASE WHEN c_custkey % 17 = 0 THEN 5127
        ELSE (c_custkey * 37) % 5110 END AS INTEGER) AS date_embauche,
      CAST(20000 + floor(abs(c_acctbal) * 4) AS INTEGER) AS salaire_brut,
      CASE WHEN c_custkey % 6 = 0 THEN 'CDD' ELSE 'CDI' END AS type_contrat,
      25 AS jours_cp,
      {ADDRESS} AS adresse,
      CASE c_nationkey % 4 WHEN 0 THEN 'Marche/running' WHEN 1 THEN 'Vélo/Trottinette/Autres'
        WHEN 2 THEN 'Transports en commun' ELSE 'véhicule thermique/électrique' END
        AS moyen_deplacement,
      'rh.parquet' AS fichier_source, TIMESTAMP '2024-01-30 00:00:00' AS charge_le
    FROM customer"""

RAW_SPORTS = """
    SELECT CAST(c_custkey AS INTEGER) AS id_salarie,
      CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'Runing' WHEN 2 THEN ' Tennis '
        WHEN 3 THEN 'Natation' WHEN 4 THEN 'Randonnée' WHEN 5 THEN '' ELSE 'Triathlon' END
        AS pratique_sport,
      'sport.parquet' AS fichier_source, TIMESTAMP '2024-01-30 00:00:00' AS charge_le
    FROM customer"""

RAW_DISTANCES = f"""
    SELECT CAST(c_custkey AS INTEGER) AS id_salarie,
      CASE WHEN c_custkey % 19 = 0 THEN 'ancienne adresse' ELSE {ADDRESS} END AS adresse,
      CASE WHEN c_nationkey % 4 = 0 THEN 'WALK' ELSE 'BICYCLE' END AS mode_api,
      CASE WHEN c_custkey % 23 <> 0
        THEN CAST(500 + (c_custkey * 7919) % 30000 AS INTEGER) END AS distance_m,
      CASE WHEN c_custkey % 23 <> 0
        THEN CAST(300 + (c_custkey * 104729) % 14400 AS INTEGER) END AS duree_s,
      CASE WHEN c_custkey % 23 = 0 THEN 'ROUTE_NOT_FOUND' ELSE 'ROUTE_EXISTS' END AS statut,
      TIMESTAMP '2024-01-15 00:00:00' AS calcule_le
    FROM customer WHERE c_nationkey % 4 IN (0, 1) AND c_custkey % 29 <> 0"""

PIPELINE_RUNS = """
    SELECT CAST(o_orderkey AS VARCHAR) AS id_run,
      CASE o_orderkey % 6 WHEN 0 THEN 'ingestion_salaries' WHEN 1 THEN 'ingestion_sports'
        WHEN 2 THEN 'geo_distances' WHEN 3 THEN 'chargement_activites' WHEN 4 THEN 'modeles'
        ELSE 'qualite' END AS etape,
      o_orderdate + to_seconds(CAST(o_orderkey % 40000 AS INTEGER)) AS debut,
      o_orderdate + to_seconds(CAST(o_orderkey % 40000 + o_orderkey % 97 AS INTEGER)) AS fin,
      CASE o_orderstatus WHEN 'O' THEN 'succes' WHEN 'F' THEN 'echec' ELSE 'en_cours' END AS statut,
      CAST(floor(o_totalprice) AS BIGINT) AS nb_lignes,
      concat('commande ', CAST(o_orderkey AS VARCHAR)) AS message
    FROM orders"""

QUALITY_CHECKS = """
    SELECT CAST(l_orderkey AS VARCHAR) AS execution_id,
      TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST(l_orderkey AS INTEGER)) AS verifie_le,
      'entrepot' AS data_source,
      CASE l_linenumber % 3 WHEN 0 THEN 'raw' WHEN 1 THEN 'geo' ELSE 'analytics' END
        AS fichier_controle,
      CASE l_suppkey % 4 WHEN 0 THEN 'activites' WHEN 1 THEN 'salaries' WHEN 2 THEN 'sports'
        ELSE 'kpi_synthese' END AS table_verifiee,
      concat('controle ', CAST(l_partkey % 35 AS VARCHAR)) AS controle,
      CASE l_returnflag WHEN 'R' THEN 'fail' WHEN 'A' THEN 'warn' ELSE 'pass' END AS resultat,
      l_quantity AS valeur
    FROM lineitem"""

# Complete years, and the position of their band in the list of bands.
AGE = f"date_sub('year', date_naissance, {AS_OF})"
BANDS = quoted([label for _, label in L.AGE_BANDS] + [L.AGE_BAND_LAST])
ROUTES = ", ".join(f"('{label}', '{mode}')" for label, mode in L.ROUTE_MODES.items())

STG_SALARIES = f"""
    SELECT id_salarie, trim(nom) AS nom, trim(prenom) AS prenom, date_naissance,
      CAST({AGE} AS INTEGER) AS age,
      [{BANDS}][greatest(1, least(5, {AGE} // 10 - 1))] AS tranche_age,
      trim(bu) AS bu, date_embauche, salaire_brut, trim(type_contrat) AS type_contrat, jours_cp,
      adresse, trim(moyen_deplacement) AS moyen_deplacement,
      coalesce(route IS NOT NULL, false) AS trajet_sportif, route AS mode_api
    FROM raw_salaries LEFT JOIN (VALUES {ROUTES}) AS routes(libelle, route)
      ON libelle = trim(moyen_deplacement)"""

STG_SPORTS = """
    SELECT id_salarie, coalesce(juste, declare) AS sport_declare,
      declare IS NOT NULL AS pratique_declaree
    FROM (SELECT id_salarie, nullif(trim(pratique_sport), '') AS declare FROM raw_sports)
    LEFT JOIN (VALUES ('Runing', 'Course à pied')) AS corrections(lu, juste) ON lu = declare"""

STG_DISTANCES = f"""
    SELECT id_salarie, adresse AS adresse_calculee, mode_api,
      round(distance_m * 0.001, 1) AS distance_km,
      {half_up("duree_s", "60", 0)} AS duree_min, statut AS statut_api, calcule_le
    FROM raw_distances"""

MICROS = "(epoch_us(date_fin) - epoch_us(date_debut))"

STG_ACTIVITIES = f"""
    SELECT id_activite, id_salarie, date_debut, date_fin,
      CAST((date_debut AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS DATE) AS date_activite,
      type_activite, distance_m,
      round(distance_m * 0.001, 2) AS distance_km,
      {half_up(MICROS, "60000000", 1)} AS duree_min,
      {half_up("distance_m * CAST(3600000 AS BIGINT)", f"nullif({MICROS}, 0)", 1)} AS vitesse_kmh,
      commentaire, source,
      CASE WHEN len([r FOR r IN regles IF NOT r]) > 0 THEN false
        WHEN len([r FOR r IN regles IF r IS NULL]) = 0 THEN true END AS est_valide
    FROM (SELECT *, [
        date_fin > date_debut,
        {MICROS} / 3600000000.0::DOUBLE < 24,
        coalesce(distance_m >= 0 AND distance_m <= 300000, true),
        coalesce(distance_m::HUGEINT * 3600 * 1000 <= vitesse_max_kmh::HUGEINT * {MICROS}, true)
      ] AS regles
    FROM raw_activites LEFT JOIN vitesses_max USING (type_activite))"""

MART_ACTIVITIES = """
    SELECT id_activite, a.id_salarie, date_activite,
      CAST(date_trunc('month', date_activite) AS DATE) AS mois,
      CAST(isodow(date_activite) AS INTEGER) AS jour_semaine, type_activite, distance_km,
      duree_min, source, est_valide, commentaire IS NOT NULL AS a_commentaire, bu, tranche_age,
      sport_declare
    FROM stg_activites a
    LEFT JOIN stg_salaries s ON s.id_salarie = a.id_salarie
    LEFT JOIN stg_sports p ON p.id_salarie = a.id_salarie"""


def whole(value) -> tuple[int, int]:
    """A decimal as a ratio of whole numbers."""
    return value.as_integer_ratio()


def benefits_sql(params: Params) -> str:
    """One row per employee: facts first, then the outcome by its place in a list of outcomes."""
    (days, per_days), (worked, per_worked) = whole(params.nb_jours_bien_etre), whole(params.jours_travailles_an)
    rate, per_rate = whole(params.taux_prime)
    bonus = half_up(f"(salaire_brut::HUGEINT * {rate})", f"{per_rate}", 2, "HUGEINT")
    wellness = half_up(f"(salaire_brut::HUGEINT * {days * per_worked})", f"{worked * per_days}", 2, "HUGEINT")
    limits = f"MAP {{'WALK': {params.seuil_marche_km}, 'BICYCLE': {params.seuil_velo_km}}}"
    counted = f"""
      SELECT id_salarie, count(*) AS nb_activites
      FROM stg_activites SEMI JOIN stg_salaries USING (id_salarie)
      WHERE est_valide AND date_diff('day', date_activite, {AS_OF}) <= {int(params.periode_jours)}
      GROUP BY id_salarie"""
    facts = f"""
      SELECT e.*, p.sport_declare, coalesce(p.pratique_declaree, false) AS pratique_declaree,
        d.distance_km, {limits}[e.mode_api] AS seuil_km, coalesce(n.nb_activites, 0)
          - coalesce(trop_tot.n, 0) AS nb_activites,
        coalesce(d.distance_km IS NOT NULL AND coalesce(d.statut_api = 'ROUTE_EXISTS', true)
          AND (d.mode_api, d.adresse_calculee) IS NOT DISTINCT FROM (e.mode_api, e.adresse), false)
          AS mesure,
        coalesce(d.distance_km <= {limits}[e.mode_api], false) AS proche
      FROM stg_salaries e
      LEFT JOIN stg_sports p USING (id_salarie)
      LEFT JOIN stg_distances d USING (id_salarie)
      LEFT JOIN ({counted}) n USING (id_salarie)
      LEFT JOIN (
        SELECT id_salarie, count(*) AS n FROM stg_activites JOIN stg_salaries USING (id_salarie)
        WHERE est_valide AND date_diff('day', date_activite, {AS_OF}) <= {int(params.periode_jours)}
          AND date_embauche > date_activite GROUP BY id_salarie) trop_tot USING (id_salarie)"""
    return f"""
    SELECT id_salarie, bu, tranche_age, type_contrat, date_embauche, sport_declare,
      pratique_declaree, moyen_deplacement, trajet_sportif, CAST(distance_km AS DOUBLE) AS distance_km,
      CAST(seuil_km AS DOUBLE) AS seuil_km, statut_declaration,
      prime AS eligible_prime, if(prime, {bonus}, 0.0) AS montant_prime,
      nb_activites, assidu AS eligible_bien_etre,
      if(assidu, CAST({params.nb_jours_bien_etre} AS DOUBLE), 0.0) AS jours_bien_etre,
      if(assidu, {wellness}, 0.0) AS cout_bien_etre,
      salaire_brut
    FROM (
      SELECT *, trajet_sportif AND mesure AND proche AS prime,
        nb_activites >= {params.nb_activites_min} AS assidu,
        [{quoted([L.NOT_CONCERNED, L.NOT_VERIFIED, L.SUSPECT, L.COMPLIANT])}][
          1 + trajet_sportif::INTEGER * (1 + mesure::INTEGER * (1 + proche::INTEGER))]
          AS statut_declaration
      FROM ({facts}))"""


# Measure of the summary -> what an employee adds to it.
ADDED = {
    "nb_salaries": "1",
    "nb_sportifs_declares": "pratique_declaree::INTEGER",
    "nb_trajets_sportifs": "trajet_sportif::INTEGER",
    "nb_declarations_suspectes": f"(statut_declaration = '{L.SUSPECT}')::INTEGER",
    "nb_declarations_non_verifiees": f"(statut_declaration = '{L.NOT_VERIFIED}')::INTEGER",
    "nb_eligibles_prime": "eligible_prime::INTEGER",
    "nb_eligibles_bien_etre": "eligible_bien_etre::INTEGER",
}


def kpi_sql(params: Params, benefits: str = "avantages_salaries") -> str:
    """The summary from one long table of measures, turned into columns at the end."""
    long = ", ".join(f"{{'m': '{name}', 'v': {value}}}" for name, value in ADDED.items())
    counts = ", ".join(f"coalesce(max(total) FILTER (m = '{name}'), 0)::BIGINT AS {name}" for name in ADDED)
    recent = f"date_diff('day', date_activite, {AS_OF}) <= {int(params.periode_jours)}"
    used = {
        "taux_prime": params.taux_prime, "seuil_marche_km": params.seuil_marche_km,
        "seuil_velo_km": params.seuil_velo_km, "nb_activites_min": params.nb_activites_min,
        "nb_jours_bien_etre_par_salarie": params.nb_jours_bien_etre,
    }
    constants = ", ".join(f"CAST({value} AS DOUBLE) AS {name}" for name, value in used.items())
    return f"""
    SELECT * FROM (
      SELECT {counts} FROM (
        SELECT e.m AS m, sum(e.v) AS total
        FROM (SELECT unnest([{long}]) AS e FROM {benefits}) GROUP BY 1))
    CROSS JOIN (
      SELECT {money("montant_prime")} AS cout_prime, {money("cout_bien_etre")} AS cout_bien_etre,
        {money("montant_prime + cout_bien_etre")} AS cout_total,
        CAST(sum(jours_bien_etre) AS DOUBLE) AS nb_jours_bien_etre FROM {benefits})
    CROSS JOIN (
      SELECT coalesce(sum(est_valide::INTEGER), 0)::BIGINT AS nb_activites_valides,
        coalesce(sum((NOT est_valide)::INTEGER), 0)::BIGINT AS nb_activites_invalides
      FROM stg_activites WHERE {recent})
    CROSS JOIN (SELECT {constants})"""


def money(expression: str) -> str:
    """Exact sum of amounts in cents, shown as a double."""
    return f"CAST(sum(CAST(round(({expression}) * 100) AS BIGINT)) AS DOUBLE) / 100.0"


def ctes(params: Params = Params()) -> str:
    limits = ", ".join(f"('{k}', {v})" for k, v in L.SPEED_LIMITS_KMH.items())
    towns = ", ".join(f"({quoted(row)})" for row in TOWN_ROWS)
    tables = {
        "vitesses_max(type_activite, vitesse_max_kmh)": f" VALUES {limits}",
        "communes(commune, departement, nom_officiel, code_insee, lat, lon, codes_postaux)":
            f" VALUES {towns}",
        "raw_activites": raw_activities(),
        "raw_salaries": RAW_SALARIES,
        "raw_sports": RAW_SPORTS,
        "raw_distances": RAW_DISTANCES,
        "pipeline_runs": PIPELINE_RUNS,
        "qualite_checks": QUALITY_CHECKS,
        "stg_salaries": STG_SALARIES,
        "stg_sports": STG_SPORTS,
        "stg_distances": STG_DISTANCES,
        "stg_activites": STG_ACTIVITIES,
        "activites": MART_ACTIVITIES,
        "avantages_salaries": benefits_sql(params),
        "kpi_synthese": kpi_sql(params),
    }
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in tables.items())


def oracle(select: str, params: Params = Params(), **extra: str) -> str:
    """A full statement: the shared expressions, further named ones, and the final SELECT."""
    more = "".join(f",\n{name} AS ({body})" for name, body in extra.items())
    return f"{ctes(params)}{more}\n{select}"
