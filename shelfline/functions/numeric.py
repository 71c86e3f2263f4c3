"""Rounding, guarded arithmetic, histogram buckets, distance."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F, types as T

MONEY = T.DecimalType(18, 2)
_EIGHT_DECIMALS = 1e8

# Fixed values of the distance formula: twice the Earth radius in miles, and
# kilometres per mile.
EARTH_DIAMETER_MI = 2 * 3961
KM_PER_MI = 1.60934


def stable(value: Column) -> Column:
    """The double nearest to the value's eight-decimal form.

    Sums of doubles depend on the order partitions arrive in; the noise sits far
    below 1e-8, so comparing or rounding this form gives the same answer on
    every run.
    """
    return F.when(_too_large(value), value).otherwise(F.rint(value * _EIGHT_DECIMALS) / _EIGHT_DECIMALS)


def below(value: Column, limit: int) -> Column:
    """Whether the stable form of a double is below a whole number; both are compared as multiples of the eighth decimal."""
    return F.rint(value * _EIGHT_DECIMALS) < float(limit) * _EIGHT_DECIMALS


def _too_large(value: Column) -> Column:
    """Whether a double has no eight exact decimals; true for NaN and the infinities."""
    return F.abs(value) >= float(1 << 53) / _EIGHT_DECIMALS


def half_up(value: Column, digits: int = 2) -> Column:
    """Round a double half away from zero, to at most seven digits.

    Plain double arithmetic where eight decimals are exact: going through a decimal
    type, as ``round`` does, costs a conversion to text and back for every value.
    Larger values go that way; NaN and the infinities stay what they are.
    """
    if not 0 <= digits <= 7:
        raise ValueError("digits must be between 0 and 7")
    units = F.abs(F.rint(value * _EIGHT_DECIMALS)) / float(10 ** (8 - digits))
    rounded = F.signum(value) * F.floor(units + 0.5) / float(10**digits)
    # Adding zero turns a negative zero into zero.
    return F.when(_too_large(value), F.round(value, digits)).otherwise(rounded + 0.0)


def percent_of(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole * 100``, NULL when ``whole`` is zero or NULL."""
    return half_up(F.try_divide(part.cast("double"), whole.cast("double")) * 100, digits)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def safe_add(first: Column, *rest: Column) -> Column:
    """Sum that reads NULL operands as zero."""
    total = F.coalesce(first, F.lit(0))
    for operand in rest:
        total = total + F.coalesce(operand, F.lit(0))
    return total


def safe_subtract(first: Column, *rest: Column) -> Column:
    """Left-to-right difference that reads NULL operands as zero."""
    total = F.coalesce(first, F.lit(0))
    for operand in rest:
        total = total - F.coalesce(operand, F.lit(0))
    return total


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL when the denominator is zero."""
    return F.try_divide(numerator, denominator)


def bucket_of(value: Column, low: float, high: float, buckets: int) -> Column:
    """Equal-width bucket number; 0 below the range, ``buckets + 1`` from its end on."""
    return F.width_bucket(value.cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(buckets))


def finite_or_null(value: Column) -> Column:
    """NULL in place of NaN and the infinities."""
    unusable = F.isnan(value) | (F.abs(value) == F.lit(math.inf))
    return F.when(~unusable, value)


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "mi") -> Column:
    """Great-circle distance between two points given in degrees."""
    if unit not in ("mi", "km"):
        raise ValueError("unit must be 'mi' or 'km'")
    half_chord = (
        F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    )
    # Rounding can lift the term of opposite points above 1.
    miles = F.asin(F.sqrt(F.least(half_chord, F.lit(1.0)))) * EARTH_DIAMETER_MI
    return miles * KM_PER_MI if unit == "km" else miles
