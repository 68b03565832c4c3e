"""Announcement texts as Columns."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, functions as F

from trailperks import labels as L
from trailperks.functions import rules
from trailperks.functions.numbers import int_div


def _one_decimal(value: Column) -> Column:
    """One decimal with a comma; ties go to the even digit of the exact binary value."""
    return F.replace(F.call_function("format_number", value, F.lit("0.0")), F.lit("."), F.lit(","))


def distance_text(metres: Column) -> Column:
    """``800 m`` below a kilometre, ``10,9 km`` from there."""
    short = F.concat(metres.cast("string"), F.lit(" m"))
    return F.when(metres < 1000, short).otherwise(
        F.concat(_one_decimal(metres.cast("double") / 1000), F.lit(" km"))
    )


def speed_text(metres: Column, seconds: Column) -> Column:
    """``14,1 km/h``; NULL for a duration of zero whole seconds."""
    kmh = F.try_divide(metres.cast("double") / 1000, seconds.cast("double") / 3600)
    return F.concat(_one_decimal(kmh), F.lit(" km/h"))


def duration_text(seconds: Column) -> Column:
    """``46 min``, or ``1 h 05`` from an hour on; half minutes go to the even minute."""
    minutes = F.bround(seconds.cast("double") / 60, 0).cast("long")
    rest = F.lpad((minutes % 60).cast("string"), 2, "0")
    hours = int_div(minutes, F.lit(60)).cast("string")
    return F.when(minutes < 60, F.concat(minutes.cast("string"), F.lit(" min"))).otherwise(
        F.concat(hours, F.lit(" h "), rest)
    )


def of_sport(sport: Column) -> Column:
    """``de tennis``, or ``d'escalade`` in front of a vowel."""
    lowered = F.lower(sport)
    elided = F.substring(lowered, 1, 1).isin(*L.ELISION_LETTERS)
    return F.concat(F.when(elided, "d'").otherwise("de "), lowered)


def _sentence(template: str, parts: dict[str, Column]) -> Column:
    """Fill a template; the values themselves are never scanned for placeholders."""
    pieces = []
    for text, field, _, _ in Formatter().parse(template):
        if text:
            pieces.append(F.lit(text))
        if field:
            pieces.append(parts[field])
    return F.concat(*pieces)


def announcement(
    name: Column, sport: Column, start: Column, end: Column, metres: Column, comment: Column
) -> Column:
    """The text of one activity; durations are cut to whole seconds first."""
    seconds = int_div(rules.elapsed_us(start, end), F.lit(1_000_000))
    parts = {
        "nom": F.coalesce(name, F.lit(L.UNKNOWN_EMPLOYEE)),
        "distance": distance_text(metres),
        "duree": duration_text(seconds),
        "de_sport": of_sport(sport),
        "vitesse": speed_text(metres, seconds),
    }
    with_distance = _sentence(L.SENTENCE_OTHER_SPORT, parts)
    for label, template in L.SENTENCES_WITH_DISTANCE.items():
        with_distance = F.when(sport == label, _sentence(template, parts)).otherwise(with_distance)
    speed = F.coalesce(_sentence(L.SPEED_SUFFIX, parts), F.lit(""))
    text = F.when(metres != 0, F.concat(with_distance, speed)).otherwise(
        _sentence(L.SENTENCE_WITHOUT_DISTANCE, parts)
    )
    quoted = F.when(comment != "", F.concat(F.lit(' ("'), comment, F.lit('")')))
    return F.concat(text, F.coalesce(quoted, F.lit("")))
