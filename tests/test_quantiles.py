"""Exact quantiles and mergeable sketches against plain Python."""

import random
from collections import defaultdict
from datetime import date, timedelta

import numpy
import pytest
from pyspark.sql import functions as F
from test_scale import plan

from trailperks.operators import profiling, sketches
from trailperks.operators.quantiles import quantiles
from trailperks.sources.testdata import AS_OF

SHARES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)


def expected(values):
    return [float(numpy.percentile(values, 100 * share)) for share in SHARES]


def test_as_many_values_as_rows(spark):
    """No two rows are equal, three groups of very different sizes, one of them NULL, one without a value."""
    draw = random.Random(3)
    groups = {"a": [draw.uniform(-1e6, 1e6) for _ in range(20_000)], None: [draw.random() for _ in range(301)], "c": [7.5]}
    rows = [(g, v, int(v)) for g, values in groups.items() for v in values] + [("d", None, None), ("a", None, 1)]
    frame = spark.createDataFrame(rows, "g string, v double, w int")
    found = quantiles(frame, {"v": F.col("v"), "w": F.col("w") * 2}, SHARES, ("g",)).collect()
    by = {(r["g"], r["colonne"]): [r[f"q{n}"] for n in range(len(SHARES))] for r in found}
    for group, values in groups.items():
        assert by[group, "v"] == pytest.approx(expected(values))
    assert by["a", "w"] == pytest.approx(expected([2 * int(v) for v in groups["a"]] + [2]))
    assert ("d", "v") not in by and len(by) == 6


def test_one_value_in_a_third_of_the_rows(spark):
    values = [5.0] * 3000 + [float(n) for n in range(6000)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    row = quantiles(frame, {"v": F.col("v")}, SHARES).first()
    assert [row[f"q{n}"] for n in range(len(SHARES))] == pytest.approx(expected(values))
    assert quantiles(frame.where("false"), {"v": F.col("v")}).count() == 0


def test_no_task_holds_all_values(spark, tables):
    people = profiling.population(tables.salaries, tables.sports, AS_OF)
    for frame in (profiling.describe(people, ["salaire_brut"]), profiling.population_summary(people)):
        assert "percentile" not in plan(frame)


def activities(spark, count, seed):
    draw = random.Random(seed)
    kinds = [f"sport {n}" for n in range(30)]
    rows = [
        (n, draw.randrange(5_000), date(2024, 1, 1) + timedelta(days=draw.randrange(60)), draw.choice(kinds[: 1 + n % 30]),
         draw.lognormvariate(8, 1), draw.uniform(0, 600))
        for n in range(count)
    ]
    schema = "id_activite long, id_salarie int, date_activite date, type_activite string, distance_km double, duree_min double"
    return spark.createDataFrame(rows, schema), rows


def test_merged_sketches_equal_one_pass(spark):
    frame, rows = activities(spark, 30_000, 5)
    by_day = sketches.merged(sketches.sketched(frame, F.col("date_activite")))
    at_once = sketches.merged(sketches.sketched(frame, F.lit("tout")))
    counts = defaultdict(int)
    for row in rows:
        counts[row[3]] += 1
    for one in (by_day, at_once):
        assert {r["type_activite"]: r["n"] for r in sketches.top_estimates(one, 100).collect()} == counts
        people = sketches.distinct_estimate(one).first()[0]
        assert abs(people - len({r[1] for r in rows})) <= sketches.DISTINCT_ERROR * 5_000
        for r in sketches.quantile_estimates(one, (0.01, 0.25, 0.5, 0.9)).collect():
            values = numpy.sort([row[4 if r["mesure"] == "distance_km" else 5] for row in rows])
            rank = numpy.searchsorted(values, r["estimation"]) / len(values)
            assert r["n"] == len(rows) and abs(rank - r["part"]) <= sketches.RANK_ERROR
    same = [sketches.distinct_estimate(one).first()[0] for one in (by_day, at_once)]
    assert same[0] == same[1]


def test_only_changed_periods_are_sketched_again(spark, layers):
    frame, _ = activities(spark, 2_000, 6)
    month = F.trunc("date_activite", "month")
    sketches.refresh(layers, frame, month)
    february = F.col(sketches.PERIOD) == F.lit(date(2024, 2, 1))
    # The second time, what lies before February is no longer there to be read.
    more, _ = activities(spark, 500, 7)
    grown = frame.unionByName(more).where(F.col("date_activite") >= F.lit(date(2024, 2, 1)))
    sketches.refresh(layers, grown, month, february)
    found = {r["periode"]: r["n"] for r in layers.read(sketches.SKETCHES).collect()}
    assert found == {
        date(2024, 1, 1): frame.where(F.col("date_activite") < F.lit(date(2024, 2, 1))).count(),
        date(2024, 2, 1): grown.where(F.col("date_activite") < F.lit(date(2024, 3, 1))).count(),
    }
