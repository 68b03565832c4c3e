"""Hot keys against plain Python, and the shape of the plans."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta, timezone
from io import StringIO
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from compare import SMALL
from trailperks import schemas
from trailperks.catalog import QUERIES as CORE
from trailperks.catalog import flows
from trailperks.operators import changes, marts, profiling, staging
from trailperks.params import Params
from trailperks.sources import seeds

AS_OF = date(2024, 1, 31)
UTC = timezone.utc


def plan(frame) -> str:
    out = StringIO()
    with redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


def hot_activities(spark, rows=3_000):
    """A third of all activities belong to employee 0; some employees are unknown."""
    draw = random.Random(3)
    start = datetime(2024, 1, 1, tzinfo=UTC)
    data = []
    for i in range(rows):
        employee = 0 if i % 3 == 0 else draw.randrange(1, 60)
        begin = start + timedelta(minutes=draw.randrange(30 * 24 * 60))
        metres = draw.choice([None, -5, 3_000, 5_000, 400_000])
        data.append((i, employee, begin, "Vélo", metres, begin + timedelta(hours=1), None, "live",
                     begin, "c", begin, begin))
    return spark.createDataFrame(data, schemas.RAW_ACTIVITIES), data


def test_counts_with_a_hot_employee(spark):
    activities, data = hot_activities(spark)
    hired = {i: date(2024, 1, 1) + timedelta(days=i % 40) for i in range(50)}
    salaries = spark.createDataFrame(list(hired.items()), "id_salarie int, date_embauche date")
    staged = staging.staged_activities(activities, seeds.speed_limits(spark))
    expected = Counter()
    for row in data:
        day = (row[2] + timedelta(hours=1)).date()
        valid = row[4] is None or 0 <= row[4] <= 300_000
        if valid and row[1] in hired and day >= hired[row[1]]:
            expected[row[1]] += 1
    found = marts.activities_per_employee(staged, salaries, Params(), AS_OF)
    assert {r["id_salarie"]: r["nb_activites"] for r in found.collect()} == dict(expected)
    start = Params().period_start(AS_OF)
    rollup = marts.activity_rollup(
        marts.daily_activity(staged, start), salaries, {"": start}
    ).collect()
    assert {r["id_salarie"]: r["nb_activites"] for r in rollup if r["nb_activites"]} == dict(expected)
    assert sum(r["nb_valides"] + r["nb_invalides"] for r in rollup) == len(data)


def test_hot_employee_is_split_by_adaptive_execution(spark, tables):
    """The partition of the hot employee is read by several tasks of the mart's only fact join."""
    activities, data = hot_activities(spark, 60_000)
    staged = staging.staged_activities(activities.repartition(12), tables.speed_limits)
    people = spark.range(60).select(
        F.col("id").cast("int").alias("id_salarie"), F.lit("bu").alias("bu"),
        F.lit("30-39 ans").alias("tranche_age"),
    )
    sports = people.select("id_salarie", F.lit("Vélo").alias("sport_declare"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        mart = marts.activity_mart(staged, people, sports)
        rows = mart.select("id_activite", "id_salarie", "bu").collect()
        narrow = mart.select("id_activite", "id_salarie", "bu")
        narrow.collect()
        assert "skewed=true" in plan(narrow) or "(skew=true)" in plan(narrow)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert len(rows) == len(data) and {r["id_activite"] for r in rows} == {r[0] for r in data}
    assert all(r["bu"] == "bu" for r in rows)


def test_latest_change_with_a_hot_activity(spark):
    draw = random.Random(4)
    offsets = list(range(5_000))
    draw.shuffle(offsets)
    rows = [(0, o, 0 if o % 3 == 0 else draw.randrange(1, 500), o * 7) for o in offsets]
    frame = spark.createDataFrame(rows, "partition int, offset long, id_activite long, v long")
    expected = {}
    for _, offset, key, value in sorted(rows, key=lambda r: r[1]):
        expected[key] = value
    found = changes.latest_per_activity(frame)
    assert {r["id_activite"]: r["v"] for r in found.collect()} == expected


def test_latest_change_is_found_by_hashing(spark, tables):
    stored = changes.accepted(changes.parse(flows.versions(tables)))
    plan = changes.latest_per_activity(stored)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_scenarios_equal_single_runs(spark, tables):
    scenarios = {
        "a": Params(), "b": Params(periode_jours=10, nb_activites_min=3),
        "c": Params(seuil_velo_km=5, taux_prime="0.1"),
    }
    many = marts.kpi_scenarios(
        tables.employee_base, tables.stg_salaries, tables.stg_activities, scenarios, AS_OF
    )
    rows = {r["scenario"]: r.asDict() for r in many.collect()}
    for name, params in scenarios.items():
        single = tables.kpi(params).first().asDict()
        rows[name].pop("scenario")
        assert rows[name] == single


def test_scenarios_without_any_row(spark, tables):
    nobody = tables.stg_salaries.where("false")
    base = marts.employee_base(nobody, tables.stg_sports, tables.stg_distances)
    nothing = tables.stg_activities.where("false")
    many = marts.kpi_scenarios(base, nobody, nothing, {"a": Params()}, AS_OF).collect()
    start = Params().period_start(AS_OF)
    rollup = marts.activity_rollup(marts.daily_activity(nothing, start), nobody, {"": start})
    single = marts.kpi_summary(base, rollup, Params()).first().asDict()
    assert [r["scenario"] for r in many] == ["a"]
    assert {k: v for k, v in many[0].asDict().items() if k != "scenario"} == single


def test_summary_without_employees(spark, tables):
    base = tables.employee_base.where("false")
    row = marts.kpi_summary(base, tables.rollup(Params()), Params()).first().asDict()
    assert row["nb_salaries"] == 0 and row["nb_eligibles_prime"] == 0
    assert row["cout_total"] is None and row["taux_prime"] is None
    assert row["nb_activites_valides"] is None


def test_activities_of_unknown_employees_count_in_the_totals(spark, tables):
    few = tables.stg_salaries.where("id_salarie < 5")
    base = marts.employee_base(few, tables.stg_sports, tables.stg_distances)
    start = Params().period_start(AS_OF)
    daily = marts.daily_activity(tables.stg_activities, start)
    rollup = marts.activity_rollup(daily, few, {"": start})
    row = marts.kpi_summary(base, rollup, Params()).first()
    assert row["nb_salaries"] == 5
    assert row["nb_activites_valides"] + row["nb_activites_invalides"] == tables.activities.count()


def test_quartiles_against_numpy(spark):
    import numpy

    draw = random.Random(8)
    groups = defaultdict(list)
    for i in range(2_000):
        groups["hot" if i % 3 else "cold"].append(draw.randrange(100))
    rows = [(g, v) for g, values in groups.items() for v in values]
    frame = spark.createDataFrame(rows, "g string, v int")
    for row in profiling.describe(frame, ["v"], "g").collect():
        values = groups[row["g"]]
        assert row["count"] == len(values)
        for name, q in (("p25", 25), ("p50", 50), ("p75", 75)):
            assert row[name] == pytest.approx(round(float(numpy.percentile(values, q)), 1))


def test_period_bound_reaches_the_scan(spark, tables, tmp_path):
    """Over a stored activity table the period filter is pushed and only used columns are read."""
    path = str(tmp_path / "activites")
    tables.activities.write.parquet(path)
    staged = staging.staged_activities(spark.read.parquet(path), tables.speed_limits)
    text = plan(marts.daily_activity(staged, date(2024, 1, 10)))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(date_debut,2024-01-09" in pushed
    schema = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "commentaire" not in schema and "source" not in schema


def test_seed_is_broadcast_and_labels_never_shuffle_the_facts(tables):
    text = plan(tables.stg_activities)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "Exchange hashpartitioning" not in text


def test_no_query_joins_every_row_with_every_row(spark):
    for name, build in contract.queries().items():
        if name.startswith(("cdc_", "announce_stream", "run_log", "full_reload", "activity_append")):
            continue
        text = plan(build(spark, SMALL))
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name
        # The benefits use built-in functions only; operators of the optional subpackage need not.
        assert name not in CORE or "PythonUDF" not in text and "InPandas" not in text, name


def scans(frame, file: str) -> int:
    """How often the plan reads a file, reused exchanges not counted."""
    return sum(line.startswith("Location") and file in line for line in plan(frame).splitlines())


def test_key_checks_share_their_scans(spark):
    """Events are read once for keys and once for values, the stored mart for keys and for dates."""
    checks = contract.queries()["dq_run"](spark, SMALL)
    assert scans(checks, "events.parquet") <= 2 and scans(checks, "customer.parquet") <= 8
    tests = contract.queries()["model_tests"](spark, SMALL)
    assert scans(tests, "events.parquet") <= 3 and scans(tests, "/activites-") <= 3


def test_last_messages_are_parsed_once(spark):
    """One pass over the messages reads ids; only the survivors are parsed, in the table that is read here."""
    messages = flows.versions(flows.TestTables(spark, SMALL))
    named = changes.latest_changes(messages)
    assert scans(named, "/changes-") == 1 and "from_json" not in plan(named)


def test_bad_last_messages_give_way(spark):
    rows = [
        (0, '{"id_activite": 1, "distance_m": 1}'), (1, '{"id_activite": 1, "distance_m": 2}'),
        (2, '{"id_activite": 1, "date_debut": "hier"}'), (3, '{"id_activite": 1'), (4, None),
        (5, '{"id_activite": 2, "distance_m": 5}'), (6, '{"distance_m": 6}'), (7, "[]"),
        (8, '{"id_activite": 3, "distance_m": "loin"}'), (9, '{"id_activite": "x"}'),
    ]
    messages = spark.createDataFrame([(0, offset, value) for offset, value in rows], schemas.CHANGE_MESSAGE)
    found = {r["id_activite"]: r["distance_m"] for r in changes.latest_changes(messages).collect()}
    assert found == {1: 2, 2: 5}
    assert changes.latest_changes(messages.where("offset > 6")).count() == 0
    assert changes.latest_changes(messages.where("false")).count() == 0
