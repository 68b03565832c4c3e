"""Work-list, lots, answers, update."""

import json
import random
from collections import defaultdict
from datetime import datetime, timezone

from trailperks import labels as L, schemas
from trailperks.functions import geo
from trailperks.operators import distances, profiling
from trailperks.sources import seeds
from pyspark.sql import functions as F

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)
WALK, BIKE = L.MODE_WALK, L.MODE_BIKE


def people(spark, *rows):
    return spark.createDataFrame(
        list(rows), "id_salarie int, adresse string, moyen_deplacement string"
    )


def trips(spark, rows):
    return spark.createDataFrame(rows, "id_salarie int, adresse string, mode_api string")


def stored(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.DISTANCES)


def test_worklist(spark):
    salaries = people(
        spark, (1, "a", WALK), (2, "b", BIKE), (3, "c", WALK), (4, "d", "Transports en commun"),
        (5, "e", WALK), (6, None, WALK), (7, "f", f" {WALK}"),
    )
    cache = stored(
        spark, (1, "a", "WALK", 10, 5, "ROUTE_EXISTS", NOW),
        (2, "old", "BICYCLE", 10, 5, "ROUTE_EXISTS", NOW),
        (3, "c", "BICYCLE", 10, 5, "ROUTE_EXISTS", NOW),
        (5, "e", "WALK", None, None, "ROUTE_NOT_FOUND", NOW),
    )
    todo = {r["id_salarie"] for r in distances.worklist(salaries, cache).collect()}
    assert todo == {2, 3, 5, 6}
    forced = {r["id_salarie"] for r in distances.worklist(salaries, cache, True).collect()}
    assert forced == {1, 2, 3, 5, 6}


def test_lots_of_25_per_mode(spark):
    rows = [(i, f"rue {i}", "BICYCLE") for i in range(30)] + [(99, "x", "WALK")]
    numbered = distances.lots(trips(spark, rows))
    asked = {(r["mode_api"], r["lot"]): r["origines"] for r in distances.requests(numbered).collect()}
    assert {k: len(v) for k, v in asked.items()} == {
        ("BICYCLE", 0): 25, ("BICYCLE", 1): 5, ("WALK", 0): 1}
    assert asked["BICYCLE", 1][0] == "rue 25, France"
    assert all(a.endswith(", France") for origins in asked.values() for a in origins)


def test_numbering_matches_a_plain_loop(spark):
    """Ids over many ranges, gaps, negative ids."""
    draw = random.Random(5)
    ids = draw.sample(range(-400_000, 2_000_000), 3_000)
    rows = [(i, "a", draw.choice(["WALK", "WALK", "BICYCLE"])) for i in ids]
    expected, by_mode = {}, defaultdict(list)
    for identifier, _, mode in rows:
        by_mode[mode].append(identifier)
    for mode, members in by_mode.items():
        for rank, identifier in enumerate(sorted(members)):
            expected[identifier] = (mode, rank // 25, rank % 25)
    found = {
        r["id_salarie"]: (r["mode_api"], r["lot"], r["position"])
        for r in distances.lots(trips(spark, rows)).collect()
    }
    assert found == expected


def test_answers(spark):
    numbered = distances.lots(trips(spark, [(i, f"rue {i}", "WALK") for i in range(7)]))
    elements = [
        {"destinationIndex": 0, "distanceMeters": 1200, "duration": "3949s",
         "condition": "ROUTE_EXISTS", "status": {}},
        {"originIndex": 2, "condition": "ROUTE_NOT_FOUND"},
        {"originIndex": 1, "status": {"code": 3, "message": "no"}},
        {"originIndex": 4, "distanceMeters": 5},
        {"originIndex": 5, "distanceMeters": 1, "condition": "ROUTE_EXISTS"},
        {"originIndex": 5, "distanceMeters": 2, "condition": "ROUTE_EXISTS"},
        {"originIndex": 6, "distanceMeters": 7, "status": {"code": 0}, "condition": "ROUTE_EXISTS"},
    ]
    answers = spark.createDataFrame(
        [("WALK", 0, json.dumps(elements))], "mode_api string, lot long, reponse string"
    )
    rows = {r["id_salarie"]: (r["distance_m"], r["duree_s"], r["statut"])
            for r in distances.parse_answers(numbered, answers).collect()}
    assert rows == {
        0: (1200, 3949, "ROUTE_EXISTS"), 1: (None, None, "ERREUR_3"),
        2: (None, None, "ROUTE_NOT_FOUND"), 3: (None, None, "SANS_REPONSE"),
        4: (5, None, "INCONNU"), 5: (2, None, "ROUTE_EXISTS"), 6: (7, None, "ROUTE_EXISTS"),
    }


def test_lots_without_a_readable_answer(spark):
    """They give no rows, so that stored distances stay, and are listed with the reason."""
    numbered = distances.lots(trips(spark, [(n, "a", mode) for n, mode in enumerate(["WALK", "BICYCLE"] * 60)]))
    page, cut = '{"error": {"code": 503}}', '[{"originIndex": 0, "dis'
    answers = spark.createDataFrame(
        [("WALK", 0, "[]"), ("WALK", 1, page), ("BICYCLE", 0, cut), ("BICYCLE", 2, None)],
        "mode_api string, lot long, reponse string",
    )
    assert {r["statut"] for r in distances.parse_answers(numbered, answers).collect()} == {"SANS_REPONSE"}
    assert distances.parse_answers(numbered, answers).count() == 25
    found = {(r["mode_api"], r["lot"]): (r["trajets"], r["motif"]) for r in distances.quarantined(numbered, answers).collect()}
    assert found == {
        ("WALK", 1): (25, "illisible"), ("WALK", 2): (10, "absente"), ("BICYCLE", 0): (25, "illisible"),
        ("BICYCLE", 1): (25, "absente"), ("BICYCLE", 2): (10, "absente"),
    }


def test_trips_without_id_come_last(spark):
    numbered = distances.lots(trips(spark, [(None, "z", "WALK"), (5, "a", "WALK"), (70000, "b", "WALK")]))
    places = {r["id_salarie"]: (r["lot"], r["position"]) for r in numbered.collect()}
    assert places == {5: (0, 0), 70000: (0, 1), None: (0, 2)}


def test_upsert(spark):
    old = stored(spark, (1, "a", "WALK", 10, 5, "ROUTE_EXISTS", datetime(2020, 1, 1)),
                 (2, "b", "WALK", 10, 5, "ROUTE_EXISTS", datetime(2020, 1, 1)))
    new = spark.createDataFrame([(2, "z", "BICYCLE", 7, 3, "ROUTE_EXISTS"),
                                 (3, "c", "WALK", 8, 4, "ROUTE_EXISTS")],
                                "id_salarie int, adresse string, mode_api string, distance_m int, "
                                "duree_s int, statut string")
    rows = {r["id_salarie"]: r for r in distances.upsert(old, new, NOW).collect()}
    assert sorted(rows) == [1, 2, 3]
    assert rows[2]["adresse"] == "z" and rows[2]["calcule_le"].year == 2024
    assert rows[1]["calcule_le"].year == 2020


def test_preview_compares_raw_metres(spark):
    rows = stored(spark, (1, "a", "WALK", 15_040, 1, "ROUTE_EXISTS", NOW),
                  (2, "a", "WALK", 15_000, 1, "ROUTE_EXISTS", NOW),
                  (3, "a", "BICYCLE", 25_001, 1, "ROUTE_EXISTS", NOW),
                  (4, "a", "WALK", None, None, "ROUTE_NOT_FOUND", NOW))
    assert [r["id_salarie"] for r in distances.suspects_preview(rows).collect()] == [3, 1]


def test_haversine(spark):
    km = geo.haversine_km(F.lit(48.8566), F.lit(2.3522), F.lit(43.6108), F.lit(3.8767))
    assert abs(spark.range(1).select(km).first()[0] - 595.7) < 1.5


def test_unknown_department_matches_its_own_entry(spark):
    rows = [(1, "Montpellier", None, WALK), (2, "Montpellier", "34", WALK),
            (3, "Montpellier", "30", WALK), (4, "Lattes", None, BIKE)]
    frame = spark.createDataFrame(
        rows, "id_salarie int, commune string, departement string, moyen_deplacement string"
    )
    placed = profiling.estimated_commutes(frame, seeds.example_towns(spark), seeds.COMPANY_TOWN)
    found = {r["id_salarie"]: r for r in placed.collect()}
    assert [found[i]["lat"] is not None for i in range(1, 5)] == [True, True, False, False]
    assert found[3]["declaration_suspecte"] is False
    assert len(found) == 4
