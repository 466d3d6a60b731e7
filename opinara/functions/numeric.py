"""Rounding that agrees with the two rules the result formats are defined by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2**27 + 1 cuts a double into two halves whose products with 10**n are exact.
_SPLIT = 134217729.0


def round_scaled(value: Column, digits: int) -> Column:
    """Scale, round half to even, scale back: the rule for array columns."""
    factor = float(10 ** digits)
    return F.rint(value * factor) / F.lit(factor) + F.lit(0.0)


def round_exact(value: Column, digits: int) -> Column:
    """Round on the exact binary value, half to even: the rule for single numbers.

    ``value * 10**digits`` may land on a half only because the product itself
    was rounded (4.35 * 10 is 43.5, yet 4.35 is stored slightly below). The
    rounding error of the product, which is exactly computable, decides then.
    Holds for up to eight digits.
    """
    factor = F.lit(float(10 ** digits))
    product = value * factor
    spread = value * F.lit(_SPLIT)
    high = spread - (spread - value)
    low = value - high
    error = (high * factor - product) + low * factor
    half = (product - F.floor(product)) == F.lit(0.5)
    whole = (
        F.when(half & (error > 0), F.ceil(product).cast("double"))
        .when(half & (error < 0), F.floor(product).cast("double"))
        .otherwise(F.rint(product))
    )
    return whole / factor + F.lit(0.0)


def steady_mean(value: Column) -> Column:
    """Aggregate: the mean, independent of the order in which rows are added.

    Values are added as decimals of six places, which is exact up to 10**32
    for the sum. Only if a value or the sum is beyond that (or no number), the
    mean of the doubles is taken.
    """
    exact = value.try_cast("decimal(38,6)")
    total = F.try_sum(exact).cast("double") / F.count(value)
    return F.when(F.count(exact) == F.count(value), F.coalesce(total, F.avg(value))).otherwise(F.avg(value))


def clip(value: Column, low: float, high: float) -> Column:
    """Bound a number; null stays null."""
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def not_nan(value: Column) -> Column:
    """NaN becomes null, so that every later null rule covers it."""
    return F.when(~F.isnan(value), value)


def let(value: Column, build: Callable[[Column], Column]) -> Column:
    """``build(value)`` with ``value`` computed once, however often it is used.

    Spark copies projected expressions into filters it pushes below them; an
    expression that names its input many times, stacked on another such one,
    grows with every layer. A lambda variable keeps it at one mention each.
    """
    return F.transform(F.array(value), build)[0]
