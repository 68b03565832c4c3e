"""Business rules as Columns, each written once and used by every model, check and stream."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

from trailperks import labels as L
from trailperks.functions.numbers import money, round_ratio
from trailperks.params import Params

PARIS = "Europe/Paris"


# --- time -------------------------------------------------------------------------------------

def elapsed_us(start: Column, end: Column) -> Column:
    """Microseconds between two instants; fractions of a second count."""
    return F.unix_micros(end) - F.unix_micros(start)


def paris_date(instant: Column) -> Column:
    """Calendar date of an instant in Paris. Needs the session time zone UTC."""
    return F.to_date(F.from_utc_timestamp(instant, PARIS))


def _month_day(day: Column) -> Column:
    return F.month(day) * 100 + F.dayofmonth(day)


def completed_years(birth: Column, as_of: date) -> Column:
    """Age in completed calendar years."""
    before_birthday = F.lit(as_of.month * 100 + as_of.day) < _month_day(birth)
    return F.lit(as_of.year) - F.year(birth) - before_birthday.cast("int")


def age_band(age: Column) -> Column:
    """Label of the age band; an unknown age falls in the last band."""
    (first_limit, first_label), *others = L.AGE_BANDS
    band = F.when(age < first_limit, first_label)
    for limit, label in others:
        band = band.when(age < limit, label)
    return band.otherwise(L.AGE_BAND_LAST)


def weekday_label(number: Column) -> Column:
    """Name of an ISO weekday (1 = Monday)."""
    return F.try_element_at(F.array(*[F.lit(name) for name in L.WEEKDAYS]), number)


# --- activities -------------------------------------------------------------------------------

def distance_km(metres: Column) -> Column:
    return round_ratio(metres, 1000, 2)


def duration_min(micros: Column) -> Column:
    return round_ratio(micros, 60_000_000, 1)


def speed_kmh(metres: Column, micros: Column) -> Column:
    """Average speed, one decimal; NULL without a duration."""
    return round_ratio(metres.cast("long") * F.lit(3_600_000), micros, 1)


def faster_than(metres: Column, micros: Column, limit_kmh: Column) -> Column:
    """Unrounded speed above the limit, for a positive duration; compared without division.

    The left product fits a long for every integer distance. If the right one does not, it exceeds
    any possible left side, so the speed is below the limit.
    """
    limit_m_per_h = (limit_kmh * 1000).cast("long")
    covered = metres.cast("long") * F.lit(3_600_000_000)
    allowed = F.try_multiply(limit_m_per_h, micros)
    return F.when(allowed.isNotNull(), covered > allowed).otherwise(F.lit(False))


def distance_in_range(metres: Column) -> Column:
    return metres.isNull() | metres.between(0, L.MAX_DISTANCE_M)


def is_valid(start: Column, end: Column, metres: Column, limit_kmh: Column) -> Column:
    """Plausibility of one activity: dates, distance, speed for the sport.

    Three-valued: unknown dates give NULL unless the distance alone already rules the activity out.
    """
    micros = elapsed_us(start, end)
    return (
        F.when(~distance_in_range(metres), F.lit(False))
        .when(micros.isNull(), F.lit(None).cast("boolean"))
        .when((micros <= 0) | (micros >= L.MAX_DURATION_S * 1_000_000), F.lit(False))
        .when(metres.isNull() | limit_kmh.isNull(), F.lit(True))
        .otherwise(~faster_than(metres, micros, limit_kmh))
    )


# --- commute declarations ---------------------------------------------------------------------

def is_active_commute(mode: Column) -> Column:
    return mode.isin(*L.ROUTE_MODES)


def route_mode(mode: Column) -> Column:
    """Mode of the distance service for a travel mode; NULL for the other modes."""
    walk, bike = L.MODE_WALK, L.MODE_BIKE
    return F.when(mode == walk, L.ROUTE_MODES[walk]).when(mode == bike, L.ROUTE_MODES[bike])


def commute_limit_km(mode: Column, walk_km: Column, bike_km: Column) -> Column:
    """Longest accepted commute for a route mode."""
    return F.when(mode == "WALK", walk_km).when(mode == "BICYCLE", bike_km)


def distance_is_current(measured: dict[str, Column], mode: Column, address: Column) -> Column:
    """The measured distance exists and was measured for this mode and this address.

    A missing status alone does not make a distance obsolete.
    """
    return (
        measured["distance_km"].isNotNull()
        & F.coalesce(measured["statut_api"] == L.ROUTE_FOUND, F.lit(True))
        & measured["mode_api"].eqNullSafe(mode)
        & measured["adresse"].eqNullSafe(address)
    )


def declaration_status(
    active: Column, current: Column, kilometres: Column, limit_km: Column
) -> Column:
    """Outcome of the commute check; the first rule that applies decides."""
    return (
        F.when(~active, L.NOT_CONCERNED)
        .when(~current, L.NOT_VERIFIED)
        .when(kilometres <= limit_km, L.COMPLIANT)
        .otherwise(L.SUSPECT)
    )


# --- benefits ---------------------------------------------------------------------------------

def bonus_amount(status: Column, salary: Column, rate: Column) -> Column:
    amount = money(salary.cast("decimal(12,0)") * rate.cast("decimal(21,12)"))
    return F.when(status == L.COMPLIANT, amount).otherwise(F.lit(0).cast("decimal(18,2)"))


def wellness_cost(eligible: Column, salary: Column, worked_days: Column, days: Column) -> Column:
    """Price of the granted days. The product is exact; it is divided once, to 9 decimals or more."""
    yearly = salary.cast("decimal(10,0)") * days.cast("decimal(15,6)")
    amount = money(yearly / worked_days.cast("decimal(15,6)"))
    return F.when(eligible, amount).otherwise(F.lit(0).cast("decimal(18,2)"))


def literals(params: Params) -> dict[str, Column]:
    """The parameters as constant columns."""
    return {
        "taux_prime": F.lit(params.taux_prime).cast("decimal(21,12)"),
        "seuil_marche_km": F.lit(params.seuil_marche_km).cast("decimal(18,6)"),
        "seuil_velo_km": F.lit(params.seuil_velo_km).cast("decimal(18,6)"),
        "nb_jours_bien_etre": F.lit(params.nb_jours_bien_etre).cast("decimal(18,6)"),
        "nb_activites_min": F.lit(params.nb_activites_min).cast("decimal(18,6)"),
        "jours_travailles_an": F.lit(params.jours_travailles_an).cast("decimal(18,6)"),
    }
