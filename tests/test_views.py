"""SQL views and functions, seed files, town candidates and the ordered work-list."""

import json
import random
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from trailperks import labels as L, schemas
from trailperks.functions import rules
from trailperks.operators import distances, places
from trailperks.params import Params
from trailperks.plans import pipeline as P
from trailperks.sources import seeds, views
from trailperks.sources.testdata import AS_OF


@pytest.mark.parametrize("params", [Params(), Params(taux_prime="0.0333333", nb_activites_min="3", seuil_velo_km="7.5")])
def test_functions_equal_the_columns(spark, params):
    draw = random.Random(2)
    rows = [
        (draw.choice([None, *range(15, 75)]), draw.choice([None, *L.TRAVEL_MODES]), draw.choice([True, False]),
         draw.choice([None, Decimal(draw.randrange(400)) / 10]), draw.randrange(1, 10**6), draw.choice([0, 2, 3, 15, 80]))
        for _ in range(500)
    ]
    frame = spark.createDataFrame(rows, "age int, mode string, a_jour boolean, km decimal(18,1), salaire int, n bigint")
    values = rules.literals(params)
    mode = rules.route_mode(F.col("mode"))
    limit = rules.commute_limit_km(mode, values["seuil_marche_km"], values["seuil_velo_km"])
    status = rules.declaration_status(rules.is_active_commute(F.col("mode")), F.col("a_jour"), F.col("km"), limit)
    enough = F.col("n") >= values["nb_activites_min"]
    expected = frame.select(
        rules.age_band(F.col("age")), mode, limit, status,
        rules.bonus_amount(status, F.col("salaire"), values["taux_prime"]),
        rules.wellness_cost(enough, F.col("salaire"), values["jours_travailles_an"], values["nb_jours_bien_etre"]),
    ).collect()
    views.create_functions(spark, params)
    frame.createOrReplaceTempView("essai")
    found = spark.sql("""
        SELECT tranche_age(age), mode_api(mode), seuil_trajet_km(mode_api(mode)), statut, montant_prime(statut, salaire),
          cout_bien_etre(n, salaire)
        FROM (SELECT *, statut_declaration(trajet_sportif(mode), a_jour, km, seuil_trajet_km(mode_api(mode))) AS statut
              FROM essai)""").collect()
    assert [tuple(r) for r in found] == [tuple(r) for r in expected]


def test_views_show_the_newest_version(spark, layers, tables):
    run = P.Pipeline(layers, datetime(2024, 1, 31, tzinfo=timezone.utc))
    for table, rows in (
        ("raw.salaries", tables.salaries), ("raw.sports", tables.sports), (P.DISTANCES, tables.distances),
        ("raw.activites", tables.activities),
    ):
        layers.reload(table, rows)
    run.load_seeds()
    run.sql_views()
    assert spark.sql("SELECT count(*) FROM stg_salaries WHERE age > 0").first()[0] == tables.salaries.count()
    assert spark.sql("SELECT min(mode_api('Marche/running')) FROM raw_sports").first()[0] == "WALK"
    layers.reload("raw.salaries", tables.salaries.limit(3))
    run.sql_views()
    assert spark.sql("SELECT count(*) FROM raw_salaries").first()[0] == 3
    assert spark.table("stg_salaries").columns == P.staging.staged_salaries(tables.salaries, AS_OF).columns


def test_seed_files_are_typed_and_bad_lines_told(spark, layers, tmp_path):
    path = tmp_path / "v.csv"
    path.write_text('type_activite,vitesse_max_kmh\nCourse à pied,25.5\n"Vélo, route",070\nx,vite\ny\nz,1,2\n', encoding="utf-8")
    good, bad = seeds.checked_csv(spark, str(path), schemas.SPEED_LIMITS)
    assert {(r[0], r[1]) for r in good.collect()} == {("Course à pied", Decimal("25.5")), ("Vélo, route", Decimal(70))}
    assert {r[0] for r in bad.collect()} == {"x,vite", "y", "z,1,2"}
    towns = tmp_path / "communes.csv"
    towns.write_text("commune,departement,nom_officiel,code_insee,lat,lon,codes_postaux\n"
                     "Nice,06,Nice,06088,43.7,7.2,06000|06100\nSète,,Sète,34301,43.4,3.7,\n", encoding="utf-8")
    P.Pipeline(layers, datetime(2024, 1, 31, tzinfo=timezone.utc)).load_seeds(towns=str(towns))
    stored = {r["commune"]: r for r in layers.read(P.TOWNS).collect()}
    assert stored["Nice"]["departement"] == "06" and stored["Nice"]["codes_postaux"] == "06000|06100"
    assert stored["Sète"]["departement"] is None and stored["Sète"]["lat"] == 43.4


def answer(*names):
    return json.dumps([
        {"nom": name, "code": f"c{n}", "centre": {"coordinates": [n, n + 0.5]}, "codesPostaux": ["1", str(n)]}
        for n, name in enumerate(names)
    ])


def test_exact_name_first_else_the_first_candidate(spark):
    rows = [
        ("saint clement", "34", answer("Saint-Clément-de-Rivière", "SAINT-CLÉMENT", "Saint Clément")),
        ("Brasov", None, answer("Bras", "Brașov")),
        ("L'Isle", "84", answer("l isle sur la sorgue", "Lisle")),
        ("vide", "1", "[]"), ("coupee", "1", '[{"nom": "Cou'), ("absente", "1", None),
        ("sans point", "2", '[{"nom": "Sans Point"}]'),
    ]
    found = places.candidates(spark.createDataFrame(rows, places.ANSWER))
    town = {r["commune"]: r for r in places.chosen(found).collect()}
    assert town["saint clement"]["nom_officiel"] == "SAINT-CLÉMENT" and town["saint clement"]["code_insee"] == "c1"
    assert town["Brasov"]["nom_officiel"] == "Brașov" and town["Brasov"]["departement"] is None
    assert (town["Brasov"]["lat"], town["Brasov"]["lon"], town["Brasov"]["codes_postaux"]) == (1.5, 1.0, "1|1")
    assert town["L'Isle"]["nom_officiel"] == "l isle sur la sorgue"
    assert town["sans point"]["lat"] is None and town["sans point"]["codes_postaux"] == ""
    assert sorted(town) == ["Brasov", "L'Isle", "saint clement", "sans point"]
    asked = spark.createDataFrame(rows, places.ANSWER).select("commune", "departement")
    lost = places.unanswered(asked, places.chosen(found))
    assert {r["commune"] for r in lost.collect()} == {"vide", "coupee", "absente"}
    people = spark.createDataFrame([("vide", "1"), ("Brasov", None), (None, "3"), ("neu", None)], "commune string, departement string")
    todo = places.places_to_ask(people, places.chosen(found)).collect()
    assert {(r[0], r[1]) for r in todo} == {("vide", "1"), ("neu", None)}


def test_point_of_a_precise_address(spark):
    found = '{"features": [{"geometry": {"coordinates": [3.9, 43.5]}}, {"geometry": {"coordinates": [0, 0]}}]}'
    rows = spark.createDataFrame([(found,), ('{"features": []}',), (None,)], "r string")
    got = [tuple(r[0]) for r in rows.select(places.coordinates(F.col("r"))).collect()]
    assert got == [(43.5, 3.9), (None, None), (None, None)]


def test_worklist_in_order_of_ids(tables):
    for force in (False, True):
        ids = [r["id_salarie"] for r in distances.worklist(tables.salaries, tables.distances, force).collect()]
        assert ids == sorted(ids) and ids
