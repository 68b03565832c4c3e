"""Rules on small frames: time, rounding, unknown values, ties."""

import random
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from trailperks import labels as L, schemas
from trailperks.functions import messages, rules, text
from trailperks.functions.numbers import round_ratio
from trailperks.operators import changes, quality, staging
from trailperks.params import Params, params_from_row
from trailperks.session import RUNTIME_SETTINGS, SHUFFLE_PARTITION_BYTES, configure
from trailperks.sources import seeds

UTC = timezone.utc
NOON = datetime(2026, 6, 1, 12, tzinfo=UTC)


def one(spark, column, **values):
    """Value of a column expression over a one-row frame."""
    kinds = {int: "long", str: "string", float: "double", bool: "boolean", date: "date",
             datetime: "timestamp"}
    frame = spark.range(1)
    for name, value in values.items():
        kind = kinds.get(type(value), "long")
        frame = frame.withColumn(name, F.lit(value).cast(kind))
    return frame.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("instant, day", [
    (datetime(2024, 1, 1, 22, 59, tzinfo=UTC), date(2024, 1, 1)),
    (datetime(2024, 1, 1, 23, 0, tzinfo=UTC), date(2024, 1, 2)),
    (datetime(2024, 3, 30, 22, 59, tzinfo=UTC), date(2024, 3, 30)),
    (datetime(2024, 3, 31, 21, 59, tzinfo=UTC), date(2024, 3, 31)),
    (datetime(2024, 3, 31, 22, 0, tzinfo=UTC), date(2024, 4, 1)),
    (datetime(2024, 7, 1, 22, 0, tzinfo=UTC), date(2024, 7, 2)),
    (datetime(2024, 10, 27, 22, 30, tzinfo=UTC), date(2024, 10, 27)),
])
def test_paris_date(spark, instant, day):
    assert one(spark, rules.paris_date(F.col("t")), t=instant) == day


@pytest.mark.parametrize("birth, as_of, age", [
    (date(2000, 2, 29), date(2023, 2, 28), 22),
    (date(2000, 2, 29), date(2023, 3, 1), 23),
    (date(2000, 2, 29), date(2024, 2, 29), 24),
    (date(1990, 6, 15), date(2024, 6, 14), 33),
    (date(1990, 6, 15), date(2024, 6, 15), 34),
])
def test_completed_years(spark, birth, as_of, age):
    assert one(spark, rules.completed_years(F.col("b"), as_of), b=birth) == age


def test_unknown_age_is_in_the_last_band(spark):
    assert one(spark, rules.age_band(F.lit(None).cast("int"))) == L.AGE_BAND_LAST
    bands = {29: "< 30 ans", 30: "30-39 ans", 39: "30-39 ans", 59: "50-59 ans", 60: "60 ans et +"}
    for age, band in bands.items():
        assert one(spark, rules.age_band(F.col("a")), a=age) == band


@pytest.mark.parametrize("numerator, denominator, digits, expected", [
    (1005, 1000, 2, "1.01"), (-1005, 1000, 2, "-1.01"), (1004, 1000, 2, "1.00"),
    (25, 10, 0, "3"), (-25, 10, 0, "-3"), (1, 3, 2, "0.33"), (0, 7, 1, "0.0"), (5, 0, 1, None),
    (15040, 1000, 1, "15.0"), (15050, 1000, 1, "15.1"),
])
def test_half_away_from_zero(spark, numerator, denominator, digits, expected):
    value = one(spark, round_ratio(F.col("n"), F.col("d"), digits), n=numerator, d=denominator)
    assert (None if value is None else Decimal(value)) == (
        None if expected is None else Decimal(expected)
    )


def activity(metres, seconds, sport="Course à pied"):
    end = None if seconds is None else NOON + timedelta(seconds=seconds)
    return (1, 1, NOON, sport, metres, end, None, "live", NOON, "c", NOON, NOON)


def staged(spark, *rows):
    frame = spark.createDataFrame(list(rows), schemas.RAW_ACTIVITIES)
    return staging.staged_activities(frame, seeds.speed_limits(spark))


@pytest.mark.parametrize("metres, seconds, sport, valid", [
    (10_800, 2_760, "Course à pied", True),
    (None, 2_760, "Escalade", True),
    (-10_800, 2_760, "Course à pied", False),
    (1_080_000, 2_760, "Course à pied", False),
    (10_800, -2_760, "Course à pied", False),
    (10_800, 0, "Course à pied", False),
    (10_800, 86_400, "Course à pied", False),
    (10_800, 86_399.999999, "Course à pied", True),
    (172_400, 33 * 60, "Natation", False),
    (65_900, 9_000, "Vélo", True),
    (25_000, 3_600, "Course à pied", True),
    (25_001, 3_600, "Course à pied", False),
    (300_000, 60, "Tennis", True),
    (300_001, 60, "Tennis", False),
    (0, 60, "Marche", True),
    (10_800, None, "Course à pied", None),
    (-1, None, "Course à pied", False),
    (None, None, "Escalade", None),
])
def test_validity(spark, metres, seconds, sport, valid):
    assert staged(spark, activity(metres, seconds, sport)).first()["est_valide"] is valid


def test_activity_measures(spark):
    row = staged(spark, activity(10_885, 2_283)).first()
    assert row["distance_km"] == Decimal("10.89")
    assert row["duree_min"] == Decimal("38.1")
    assert row["vitesse_kmh"] == Decimal("17.2")
    assert staged(spark, activity(1_000, 0)).first()["vitesse_kmh"] is None
    row = staged(spark, activity(100, 90.5)).first()
    assert row["duree_min"] == Decimal("1.5")


def test_absurd_values_do_not_overflow(spark):
    far = activity(2_147_483_647, 40 * 365 * 86_400)
    near = activity(-2_147_483_648, 1)
    assert [r["est_valide"] for r in staged(spark, far, near).collect()] == [False, False]


STATUS_SCHEMA = (
    "active boolean, km decimal(18,1), statut string, mode_mesure string, mode string, "
    "adresse_mesure string, adresse string"
)


@pytest.mark.parametrize("row, status", [
    ((False, None, None, None, None, None, "a"), L.NOT_CONCERNED),
    ((True, None, "ROUTE_EXISTS", "WALK", "WALK", "a", "a"), L.NOT_VERIFIED),
    ((True, Decimal("3"), "ROUTE_NOT_FOUND", "WALK", "WALK", "a", "a"), L.NOT_VERIFIED),
    ((True, Decimal("3"), "ROUTE_EXISTS", "BICYCLE", "WALK", "a", "a"), L.NOT_VERIFIED),
    ((True, Decimal("3"), "ROUTE_EXISTS", "WALK", "WALK", "old", "a"), L.NOT_VERIFIED),
    ((True, Decimal("3"), "ROUTE_EXISTS", "WALK", "WALK", "a", None), L.NOT_VERIFIED),
    ((True, Decimal("3"), "ROUTE_EXISTS", "WALK", "WALK", None, None), L.COMPLIANT),
    ((True, Decimal("15.0"), "ROUTE_EXISTS", "WALK", "WALK", "a", "a"), L.COMPLIANT),
    ((True, Decimal("15.1"), "ROUTE_EXISTS", "WALK", "WALK", "a", "a"), L.SUSPECT),
    ((True, Decimal("15.1"), "ROUTE_EXISTS", "BICYCLE", "BICYCLE", "a", "a"), L.COMPLIANT),
])
def test_declaration_status(spark, row, status):
    frame = spark.createDataFrame([row], STATUS_SCHEMA)
    values = rules.literals(Params())
    limit = rules.commute_limit_km(
        F.col("mode"), values["seuil_marche_km"], values["seuil_velo_km"]
    )
    measured = {"distance_km": F.col("km"), "statut_api": F.col("statut"),
                "mode_api": F.col("mode_mesure"), "adresse": F.col("adresse_mesure")}
    current = rules.distance_is_current(measured, F.col("mode"), F.col("adresse"))
    outcome = rules.declaration_status(F.col("active"), current, F.col("km"), limit)
    assert frame.select(outcome.alias("s")).first()["s"] == status


def test_fifteen_kilometres_and_forty_metres_walk_is_compliant(spark):
    stored = spark.createDataFrame(
        [(1, "a", "WALK", 15_040, 9_000, "ROUTE_EXISTS", NOON)], schemas.DISTANCES
    )
    assert staging.staged_distances(stored).first()["distance_km"] == Decimal("15.0")


def test_amounts(spark):
    rate = F.lit(Decimal("0.05"))
    bonus = rules.bonus_amount(F.lit(L.COMPLIANT), F.col("s"), rate)
    assert one(spark, bonus, s=30_330) == Decimal("1516.50")
    assert one(spark, bonus, s=30_333) == Decimal("1516.65")
    cost = rules.wellness_cost(F.lit(True), F.col("s").cast("int"), F.lit(218), F.lit(5))
    assert one(spark, cost, s=20_000) == Decimal("458.72")
    none = rules.wellness_cost(F.lit(False), F.col("s").cast("int"), F.lit(218), F.lit(5))
    assert one(spark, none, s=20_000) == Decimal("0.00")


def test_parameter_overrides():
    params = Params().with_overrides(taux_prime=0.03, seuil_velo_km=None)
    assert params.taux_prime == Decimal("0.03") and params.seuil_velo_km == 25
    with pytest.raises(ValueError):
        Params().with_overrides(taux=1)
    assert Params().period_start(date(2024, 1, 31)) == date(2023, 1, 31)


def test_parameter_row(spark):
    params = Params(nb_activites_min=60)
    assert params_from_row(params.row(spark).first().asDict()) == params


def test_trim_removes_spaces_only(spark):
    frame = spark.createDataFrame([(1, " Tennis ", "f", NOON), (2, "\tTennis", "f", NOON),
                                   (3, "  ", "f", NOON), (4, " Runing", "f", NOON)],
                                  schemas.RAW_SPORTS)
    rows = {r["id_salarie"]: r for r in staging.staged_sports(frame).collect()}
    assert rows[1]["sport_declare"] == "Tennis"
    assert rows[2]["sport_declare"] == "\tTennis"
    assert rows[3]["sport_declare"] is None and rows[3]["pratique_declaree"] is False
    assert rows[4]["sport_declare"] == "Course à pied"
    assert one(spark, text.strip_blanks(F.col("x")), x="\t Tennis \n") == "Tennis"


@pytest.mark.parametrize("address, postcode, town", [
    ("1 rue A, 34970 Lattes", "34970", "Lattes"),
    ("1 rue A 34000 Montpellier ", "34000", "Montpellier"),
    ("12 rue des Tests, Mèze", None, "Mèze"),
    ("Mèze", None, "Mèze"),
    ("34000 rue A, Lattes", None, "Lattes"),
])
def test_address_parts(spark, address, postcode, town):
    assert one(spark, text.address_postcode(F.col("a")), a=address) == postcode
    assert one(spark, text.address_town(F.col("a")), a=address) == town


def test_folded_names_and_numbers(spark):
    for name, other in (
        ("Saint-Clément-de-Rivière", "saint clement de riviere"), ("L'Hérault", "l herault"), (" NÎMES", "nimes"),
        ("Brașov", "BRASOV"), ("Plzeň", "plzen"), ("Ἀθῆναι", "αθηναι"),
    ):
        assert one(spark, text.folded_name(F.col("n")) == F.lit(other), n=name) is True
    assert one(spark, text.folded_name(F.col("n")) == F.lit("lattes"), n="Lattes 2") is False
    assert one(spark, text.euros(F.col("n")), n=1234567) == "1 234 567 €"
    assert one(spark, text.postcode_listed(F.lit("34000"), F.lit("34000|34070"))) is True
    assert one(spark, text.postcode_listed(F.lit("34"), F.lit("34000|34070"))) is False
    assert one(spark, text.postcode_listed(F.lit("34"), F.lit(None).cast("string"))) is None


def test_weekday_labels(spark):
    day = F.lit(date(2024, 1, 1))
    assert one(spark, rules.weekday_label(F.weekday(day) + 1)) == "Lundi"
    assert one(spark, rules.weekday_label(F.lit(9))) is None


@pytest.mark.parametrize("build, expected", [
    (lambda: messages.distance_text(F.lit(800)), "800 m"),
    (lambda: messages.distance_text(F.lit(10_879)), "10,9 km"),
    (lambda: messages.distance_text(F.lit(10_250)), "10,2 km"),
    (lambda: messages.duration_text(F.lit(2_760)), "46 min"),
    (lambda: messages.duration_text(F.lit(3_900)), "1 h 05"),
    (lambda: messages.duration_text(F.lit(150)), "2 min"),
    (lambda: messages.duration_text(F.lit(3_570)), "1 h 00"),
    (lambda: messages.speed_text(F.lit(10_800), F.lit(2_760)), "14,1 km/h"),
    (lambda: messages.speed_text(F.lit(10_800), F.lit(0)), None),
    (lambda: messages.of_sport(F.lit("Tennis")), "de tennis"),
    (lambda: messages.of_sport(F.lit("Escalade")), "d'escalade"),
    (lambda: messages.of_sport(F.lit("Équitation")), "d'équitation"),
])
def test_message_parts(spark, build, expected):
    assert one(spark, build()) == expected


def test_formats_agree_with_python(spark):
    """Durations of a whole day and distances up to 30 km, against Python's own rounding."""
    seconds = spark.range(86_400).select("id", messages.duration_text(F.col("id")).alias("t"))

    def python_duration(s):
        minutes = round(s / 60)
        return f"{minutes} min" if minutes < 60 else f"{minutes // 60} h {minutes % 60:02d}"

    assert all(r["t"] == python_duration(r["id"]) for r in seconds.collect())
    metres = spark.range(1_000, 30_000).select("id", messages.distance_text(F.col("id")).alias("t"))
    assert all(
        r["t"] == f"{r['id'] / 1000:.1f} km".replace(".", ",") for r in metres.collect()
    )


def test_rule_is_the_same_everywhere(spark, tables):
    """Staging, announcements and the quality counts agree where their definitions overlap."""
    staged_rows = staging.staged_activities(tables.activities, tables.speed_limits)
    live = staged_rows.where((F.col("source") == "live") & F.col("est_valide"))
    announced = changes.announceable(tables.activities, tables.speed_limits)
    assert announced.count() == live.count()
    limited = tables.activities.join(tables.speed_limits, "type_activite", "left")
    counted = limited.agg(
        quality.inconsistent_dates().alias("d"), quality.implausible_speeds().alias("s"),
        F.count_if(~rules.distance_in_range(F.col("distance_m"))).alias("r"),
    ).first()
    invalid = staged_rows.where(~F.col("est_valide")).count()
    assert max(counted) <= invalid <= sum(counted)


def test_random_activities_against_python(spark):
    """Rounding and validity of random activities, computed again with Python fractions."""
    draw = random.Random(11)
    sports = [*L.SPEED_LIMITS_KMH, "Tennis"]
    rows = []
    for _ in range(3_000):
        metres = draw.choice([None, 0, draw.randrange(-500, 400_000), draw.randrange(60_000)])
        seconds = draw.choice([0, -60, draw.randrange(100_000), draw.randrange(1, 10_000),
                               draw.randrange(1, 20_000_000) / 1000])
        rows.append(activity(metres, seconds, draw.choice(sports)))
    frame = spark.createDataFrame(
        [(i, *row[1:]) for i, row in enumerate(rows)], schemas.RAW_ACTIVITIES
    )

    def half_up(value, digits):
        scaled = abs(value) * 10**digits
        rounded = int(scaled + Fraction(1, 2))
        return Decimal(rounded if value >= 0 else -rounded) / 10**digits

    found = staging.staged_activities(frame, seeds.speed_limits(spark)).collect()
    assert len(found) == len(rows)
    for row in found:
        _, _, start, sport, metres, end, *_ = rows[row["id_activite"]]
        elapsed = end - start
        seconds = Fraction(elapsed // timedelta(microseconds=1), 1_000_000)
        limit = L.SPEED_LIMITS_KMH.get(sport)
        speed = None if metres is None or not seconds else (
            Fraction(metres, 1000) / (seconds / 3600))
        assert row["duree_min"] == half_up(seconds / 60, 1)
        assert row["vitesse_kmh"] == (None if speed is None else half_up(speed, 1))
        assert row["distance_km"] == (
            None if metres is None else half_up(Fraction(metres, 1000), 2))
        assert row["est_valide"] == (
            0 < seconds < 86_400 and (metres is None or 0 <= metres <= 300_000)
            and (metres is None or limit is None or speed <= int(limit))
        )


def test_session_settings_can_be_changed_at_run_time(spark):
    assert all(spark.conf.isModifiable(key) for key in RUNTIME_SETTINGS)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        configure(spark, shuffle_bytes=SHUFFLE_PARTITION_BYTES * 1000 + 1)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "1001"
        configure(spark, shuffle_bytes=1)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "1001"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
