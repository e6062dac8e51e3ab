"""Rounding and exact sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c: Column, digits: int) -> Column:
    """Half-up rounding in plain IEEE steps, so other engines reproduce it bit for bit; NaN becomes null."""
    scale = float(10**digits)
    x = c.cast("double")
    return F.floor(F.when(~F.isnan(x), x) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def exact_sum(c: Column, digits: int) -> Column:
    """Sum of values that carry ``digits`` decimals, in whole units.

    Adding integers gives the same total whatever the partitioning or task retries; adding doubles does not.
    """
    return F.sum(F.floor(c * F.lit(float(10**digits)) + F.lit(0.5)).cast("bigint"))


def exact_avg(c: Column, digits: int) -> Column:
    """Mean of values that carry ``digits`` decimals, independent of row order."""
    return exact_sum(c, digits).cast("double") / (F.count(c).cast("double") * F.lit(float(10**digits)))


def share_pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part`` of ``whole`` in percent; null when the whole is empty."""
    return round_half_up(part.cast("double") * 100.0 / F.nullif(whole.cast("double"), F.lit(0.0)), digits)
