"""Sums, averages, ratios and rounding of double measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Doubles are summed as decimals. A double sum depends on the order in which partial sums meet, so
# it changes between runs, retries and partitionings; the decimal sum does not. Twelve decimals
# keep every digit of the published sources and leave 26 digits before the point. Where a group has
# a value that this form cannot hold, its sum is the ordinary one.
EXACT = "decimal(38,12)"
_LEAST, _MOST = 1e-9, 1e20


def as_exact(value: Column) -> Column:
    """The decimal form that sums are taken in; NULL where it cannot hold the value."""
    return value.try_cast(EXACT)


def exact_sum(value: Column) -> Column:
    """Order-independent SUM of a double column; NULL over no values."""
    size = F.abs(value.cast("double"))
    beyond = (size >= _MOST) | ((size > 0) & (size < _LEAST))
    plain = F.sum(F.when(~F.isnan(value.cast("double")), value.cast("double")))
    exact = F.try_sum(as_exact(value)).cast("double")
    return F.when(F.coalesce(F.bool_or(beyond), F.lit(False)), plain).otherwise(F.coalesce(exact, plain))


def exact_avg(value: Column) -> Column:
    """Order-independent AVG of a double column; NULL over no values, NaN counts as missing."""
    present = F.when(~F.isnan(value.cast("double")), value)
    return F.try_divide(exact_sum(value), F.count(present).cast("double"))


def safe_divide(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """Ratio with a default where it is undefined."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(default))


def per_capita_tonnes(kilotonnes: Column, population: Column) -> Column:
    """Kilotonnes to tonnes per head; NULL where the population is zero or unknown."""
    return F.try_divide(kilotonnes * 1000.0, population)


def per_100k(count: Column, population: Column) -> Column:
    return F.try_divide(count, population) * 100000.0


def percentage(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100.0


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Scale, round half to even, unscale - the rounding of numeric array libraries."""
    factor = float(10**digits)
    return F.rint(value * factor) / factor


def pearson(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs; NULL where a side does not vary.

    Written with its moments because the built-in ``corr`` divides by the deviations and fails on a
    constant side in ANSI mode.
    """
    paired_x = F.when(y.isNotNull(), x)
    paired_y = F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(paired_x) * F.stddev_pop(paired_y))
