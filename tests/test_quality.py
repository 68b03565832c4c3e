"""Checks, gate and model tests."""

import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from trailperks import labels as L, schemas
from trailperks.operators import assertions, quality as Q, simulation
from trailperks.operators.joins import duplicate_keys, orphan_counts
from trailperks.operators.keys import KeyCounts
from trailperks.params import Params
from trailperks.sources.testdata import AS_OF_TIME


def outcomes(spark, tables, checks, wide=None):
    frame = Q.evaluate(spark, tables, checks, wide)
    return {r["numero"]: r for r in frame.collect()}


def test_there_are_35_checks():
    checks = Q.standard_checks(AS_OF_TIME)
    assert len(checks) == 35
    tables = [c.table for c in checks]
    assert [tables.count(t) for t in ("activites", "salaries", "sports",
                                      "distances_domicile_travail", "avantages_salaries",
                                      "kpi_synthese", "parametres")] == [9, 9, 2, 5, 5, 2, 3]


def test_thresholds(spark):
    table = {"t": spark.createDataFrame([(1, 5), (2, None), (3, 500)], "id int, v int")}
    checks = [
        Q.Check("raw", "t", "a", Q.row_count, fail=Q.below(1)),
        Q.Check("raw", "t", "b", Q.missing("v"), warn=Q.above(0), fail=Q.above(1)),
        Q.Check("raw", "t", "c", Q.out_of_range("v", 0, 100), fail=Q.above(0)),
        Q.Check("raw", "t", "d", Q.percent_out_of_range("v", 0, 100), warn=Q.above(0)),
        Q.Check("raw", "t", "e", Q.smallest("v"), fail=Q.below(1)),
    ]
    found = outcomes(spark, table, checks)
    assert [found[n]["resultat"] for n in range(1, 6)] == ["pass", "warn", "fail", "warn", "pass"]
    assert found[4]["valeur"] == pytest.approx(100 / 3)


def test_empty_table(spark):
    table = {"t": spark.createDataFrame([], "id int, v int, ts timestamp")}
    checks = [
        Q.Check("raw", "t", "rows", Q.row_count, fail=Q.below(1)),
        Q.Check("raw", "t", "min", Q.smallest("v"), fail=Q.below(1)),
        Q.Check("raw", "t", "percent", Q.percent_out_of_range("v", 0, 1), fail=Q.above(0)),
        Q.Check("raw", "t", "age", Q.age_ms("ts", AS_OF_TIME), fail=Q.above(0)),
    ]
    found = outcomes(spark, table, checks)
    assert [found[n]["resultat"] for n in range(1, 5)] == ["fail", "erreur", "pass", "erreur"]


def test_freshness_in_milliseconds(spark):
    loaded = AS_OF_TIME - timedelta(days=2)
    table = {"t": spark.createDataFrame([(loaded,)], "ts timestamp")}
    check = Q.Check("raw", "t", "age", Q.age_ms("ts", AS_OF_TIME), warn=Q.above(Q.DAY_MS),
                    fail=Q.above(7 * Q.DAY_MS))
    found = outcomes(spark, table, [check])[1]
    assert (found["resultat"], found["valeur"]) == ("warn", 2 * Q.DAY_MS)


def test_broken_checks_are_errors_and_others_run(spark):
    table = {"t": spark.createDataFrame([(1,)], "id int")}
    checks = [
        Q.Check("raw", "t", "no column", Q.missing("id_x"), fail=Q.above(0)),
        Q.Check("raw", "absent", "no table", Q.row_count, fail=Q.above(0)),
        Q.Check("raw", "t", "unique", unique="id_x", fail=Q.above(0)),
        Q.Check("raw", "t", "rows", Q.row_count, fail=Q.below(1)),
        Q.Check("raw", "t", "schema", required=("id", "nom"), fail=Q.above(0)),
    ]
    found = outcomes(spark, table, checks)
    assert [found[n]["resultat"] for n in range(1, 6)] == ["erreur"] * 3 + ["pass", "fail"]
    assert found[1]["table_verifiee"] is None
    assert found[1]["controle"].startswith("Erreur technique : ")
    assert found[4]["table_verifiee"] == "t"


def test_statuses():
    counts = {"pass": 3, "warn": 1, "fail": 0, "erreur": 0}
    assert Q.run_status(counts) == L.RUN_OK
    assert Q.run_status(counts | {"fail": 1}) == L.RUN_FAILED
    assert Q.run_status(counts | {"erreur": 1}) == L.RUN_FAILED
    assert "technique" in Q.run_message(counts | {"erreur": 1})


@pytest.mark.parametrize("rate, expected", [(0.0, "pass"), (0.004, "warn"), (0.5, "fail")])
def test_three_levels_of_anomalies(spark, rate, expected):
    """Clean data pass, a few errors warn, many fail."""
    start = datetime(2024, 1, 10, 8, tzinfo=timezone.utc)
    rows = [
        (i, 1, start, "Course à pied", 5_000, start + timedelta(hours=1), None, "live", start, "c",
         start, start)
        for i in range(2_000)
    ]
    clean = spark.createDataFrame(rows, schemas.RAW_ACTIVITIES)
    spoiled = simulation.inject_anomalies(clean, rate, "essai")
    limits = spark.createDataFrame([("Course à pied", 25)], "type_activite string, vmax int").select(
        "type_activite", F.col("vmax").cast("decimal(9,3)").alias("vitesse_max_kmh"))
    tables = {"activites": spoiled}
    checks = [c for c in Q.standard_checks(AS_OF_TIME) if c.measure and c.table == "activites"]
    wide = {"activites": spoiled.join(limits, "type_activite", "left")}
    measured = [c for c in checks if c.name in (
        "% de distances hors bornes", "dates incohérentes", "vitesses implausibles")]
    results = {r["resultat"] for r in Q.evaluate(spark, tables, measured, wide).collect()}
    assert max(results, key=["pass", "warn", "fail"].index) == expected


def test_duplicates_and_orphans_ignore_null(spark):
    rows = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,), (9,), (9,)], "k int")
    assert {(r["k"], r["n"]) for r in duplicate_keys(rows, "k").collect()} == {(1, 2), (9, 2)}
    parents = spark.createDataFrame([(1,), (2,)], "id int")
    assert [(r["k"], r["n"]) for r in orphan_counts(rows, "k", parents, "id").collect()] == [(9, 2)]


def test_assertions_find_violations(spark, tables):
    benefits = tables.benefits()
    spoiled = benefits.withColumn("montant_prime", F.col("montant_prime") + 1)
    assert assertions.incoherent_costs(benefits).count() == 0
    assert assertions.incoherent_costs(spoiled).count() == benefits.where("!eligible_prime").count()
    kpi = tables.kpi()
    assert assertions.incoherent_kpi(kpi, benefits).count() == 0
    assert assertions.incoherent_kpi(kpi, spoiled).count() == 1
    swapped = kpi.withColumn("nb_salaries", F.lit(0))
    assert assertions.incoherent_kpi(swapped, benefits).count() == 1
    assert assertions.wrong_bonus(spoiled, tables.stg_salaries, Params()).count() == (
        benefits.where("eligible_prime").count())
    odd = benefits.withColumn("statut_declaration", F.lit("autre"))
    assert assertions.unknown_status(odd).count() == benefits.count()


def test_key_counts_against_plain_python(spark):
    """Repeated, missing and orphaned values and numbers of rows of several tables, read off one aggregation."""
    rng = random.Random(1)
    child = [(rng.choice([None, *range(9)]), rng.choice("abc")) for _ in range(400)]
    parent = [(n,) for n in (0, 1, 2, 2, 3, None, None, 77)]
    text = [("1",), ("1",), ("x",), (None,)]
    tables = {
        "enfant": spark.createDataFrame(child, "id int, lettre string"),
        "parent": spark.createDataFrame(parent, "cle bigint"),
        "texte": spark.createDataFrame(text, "cle string"),
        "vide": spark.createDataFrame([], "cle int"),
    }
    keys = KeyCounts(tables)
    measures = {
        "orphelins": keys.orphans("enfant", "id", "parent", "cle"),
        "repetes": keys.repeated("enfant", "id"),
        "lettres": keys.repeated("enfant", "lettre"),
        "manquants": keys.missing("enfant", "id"),
        "parent": keys.repeated("parent", "cle"),
        "sans": keys.missing("parent", "cle"),
        "texte": keys.repeated("texte", "cle"),
        "lignes": keys.rows("enfant"),
        "vide": keys.rows("vide"),
        "rien": keys.repeated("vide", "cle"),
    }
    found = keys.counts().agg(*[m().alias(n) for n, m in measures.items()]).first().asDict()
    ids = [i for i, _ in child if i is not None]
    assert found == {
        "orphelins": sum(i > 3 for i in ids), "repetes": sum(n > 1 for n in Counter(ids).values()),
        "lettres": 3, "manquants": 400 - len(ids), "parent": 1, "sans": 2, "texte": 1, "lignes": 400, "vide": 0,
        "rien": 0,
    }
    with pytest.raises(Exception, match="absente"):
        KeyCounts(tables).missing("enfant", "absente")


def test_model_tests_count_every_kind(spark, tables):
    """Spoiled tables: a repeated and a missing key in each, activities of unknown people, a lost amount."""
    salaries, benefits, limits = tables.stg_salaries, tables.benefits(), tables.speed_limits
    first = lambda frame, key: frame.where(F.col(key) == frame.agg(F.min(key)).scalar())
    broken = lambda frame, key: frame.unionByName(first(frame, key)).unionByName(
        first(frame, key).withColumn(key, F.lit(None).cast(dict(frame.dtypes)[key]))
    )
    mart = tables.activity_mart
    stranger = first(mart, "id_activite").withColumns({
        "id_salarie": F.lit(10**9).cast("int"), "id_activite": F.lit(-1).cast("bigint"),
    })
    people = tables.salaries
    sources = {
        "salaries": broken(people, "id_salarie"), "sports": broken(tables.sports, "id_salarie"),
        "activites": broken(tables.activities, "id_activite"),
        "distances_domicile_travail": broken(tables.distances, "id_salarie"),
        "vitesses_max": broken(limits, "type_activite"),
    }
    found = {
        r["test"]: r["violations"]
        for r in assertions.model_tests(
            sources, broken(benefits, "id_salarie").withColumn("montant_prime", F.lit(None).cast("decimal(18,2)")),
            broken(mart, "id_activite").unionByName(stranger).unionByName(stranger), tables.kpi(),
            tables.stg_activities, salaries, Params(),
        ).collect()
    }
    assert len(found) == 23
    for name in ("salaries", "sports", "distances", "avantages_salaries"):
        assert found[f"{name}.id_salarie unique"] == found[f"{name}.id_salarie renseigné"] == 1
    assert found["raw_activites.id_activite unique"] == found["vitesses_max.type_activite renseigné"] == 1
    assert found["activites.id_activite unique"] == 2 and found["activites salarié connu"] == 2
    assert found["avantages_salaries.montant_prime renseigné"] == benefits.count() + 2
