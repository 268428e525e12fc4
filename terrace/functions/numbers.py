"""Exact arithmetic for rates and means.

Sums of doubles depend on the order in which tasks finish. Measures of six decimals or
fewer are therefore summed in whole millionths, and quotients are rounded half up from
the exact sums, so that a result is the same whatever the number of partitions. Where a
group has a value with more decimals, or one beyond 9e12, its mean is that of the doubles:
no value is rounded before it is summed, and none is left out. The sums are decimals of
29 and 38 digits, which no number of rows overflows; they start from bigints, since
turning a double into a decimal for every row would cost more than the sum itself.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACES = 6


def millionths(measure: Column) -> Column:
    """The measure in whole millionths; null if it is no finite number."""
    return F.rint(measure * F.lit(float(10**PLACES))).try_cast("bigint")


def _units(measure: Column) -> Column:
    return millionths(measure).cast("decimal(19,0)")


def finite(measure: Column) -> Column:
    """The measure as double, null if it is no finite number."""
    value = measure.cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def inexact(measure: Column, places: int = PLACES, most: float = 9e12) -> Column:
    """True for a finite value with more decimals, or beyond ``most``: its sums are doubles'."""
    value, scale = finite(measure), F.lit(float(10**places))
    exact = (F.abs(value) <= most) & (F.rint(value * scale) / scale == value)
    return value.isNotNull() & ~exact


def exact_sum(measure: Column) -> Column:
    """Aggregate: sum to six decimals."""
    return F.sum(_units(measure)) * F.lit(Decimal(1).scaleb(-PLACES))


def exact_sum_of_products(a: Column, b: Column) -> Column:
    """Aggregate: sum of ``a * b``."""
    return F.sum(_units(a) * _units(b)) * F.lit(Decimal(1).scaleb(-2 * PLACES))


def half_up_quotient(part: Column, whole: Column, places: int = 2) -> Column:
    """``part / whole`` rounded half up, null unless ``whole`` is positive.

    Works on bigint and decimal operands with integer division, so no rounding happens
    before the last digit.
    """
    doubled = F.abs(part) * F.lit(2 * 10**places) + whole
    units = F.call_function("div", doubled, whole * F.lit(2))
    signed = F.when(part < 0, -units).otherwise(units)
    return F.when(whole > 0, signed.cast("double") / F.lit(float(10**places)))


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """Percentage of two counts, null unless ``whole`` is positive."""
    return half_up_quotient(part * F.lit(100), whole, places)


def exact_mean(measure: Column, places: int = 2) -> Column:
    """Aggregate: mean of the finite values, rounded half up.

    With a value that is not exact in millionths it is the mean of doubles.
    """
    exact = half_up_quotient(exact_sum(measure), F.count(finite(measure)), places)
    as_doubles = F.round(F.avg(finite(measure)), places)
    return F.when(F.count_if(inexact(measure)) == 0, exact).otherwise(as_doubles)


def bin_start(value: Column, width: int) -> Column:
    """Lower edge of the fixed-width bin that holds the value."""
    return (F.floor(value / F.lit(width)) * F.lit(width)).cast("int")


def whole_number(text: Column) -> Column:
    """Text to int; a fraction is cut off, anything else that is no number gives null."""
    return F.regexp_replace(text, r"[.][0-9]*$", "").try_cast("int")
