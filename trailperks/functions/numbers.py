"""Exact rounding on integers and decimals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def int_div(numerator: Column, denominator: Column) -> Column:
    """Integer division; truncates toward zero."""
    return F.call_function("div", numerator, denominator)


def round_ratio(numerator: Column, denominator: Column | int, digits: int) -> Column:
    """``round(numerator / denominator, digits)`` of two integers, half away from zero.

    Long arithmetic end to end: no binary fraction can tip a tie, and the expression stays inside
    generated code. A zero denominator gives NULL.
    """
    scale = 10**digits
    if isinstance(denominator, int):
        # round(n * scale / d) = (2 * n * scale + d) div (2 * d), for the magnitudes.
        double, scaled = 2 * denominator, numerator.cast("long") * (2 * scale)
        magnitude = int_div(F.abs(scaled) + denominator, F.lit(double).cast("long"))
        signed = F.when(scaled < 0, -magnitude).otherwise(magnitude)
    else:
        divisor = F.nullif(denominator.cast("long"), F.lit(0).cast("long"))
        scaled = numerator.cast("long") * (2 * scale)
        size = F.abs(divisor)
        magnitude = int_div(F.abs(scaled) + size, size * 2)
        signed = F.when((scaled < 0) != (divisor < 0), -magnitude).otherwise(magnitude)
    if digits == 0:
        return signed
    return (signed.cast("decimal(18,0)") / F.lit(scale)).cast(f"decimal(18,{digits})")


def money(amount: Column) -> Column:
    """A decimal amount in cents, half away from zero."""
    return F.round(amount, 2).cast("decimal(18,2)")


def share(part: Column, whole: Column) -> Column:
    """A quotient that is NULL when there is nothing to divide by."""
    return F.try_divide(part, whole)
