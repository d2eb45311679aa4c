"""Ratio, average and threshold expressions.

Rates are divided as exact decimals and rounded half-up, then published as
``double`` so every consumer sees one numeric type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _dec(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def exact_ratio(numerator: Column, denominator: Column) -> Column:
    """Unrounded ``numerator / nullif(denominator, 0)`` as an exact decimal."""
    return _dec(numerator) / F.nullif(_dec(denominator), F.lit(0).cast("decimal(20,0)"))


def rate(numerator: Column, denominator: Column, scale: int = 4) -> Column:
    """``round(n::numeric / nullif(d, 0), scale)``; NULL when ``d`` is 0."""
    return F.round(exact_ratio(numerator, denominator), scale).cast("double")


def rounded_mean(total: Column, count: Column, scale: int = 2) -> Column:
    """``round(avg(x)::numeric, scale)`` from an exact sum and count."""
    return rate(total, count, scale)


def above_threshold(numerator: Column, denominator: Column, threshold: float) -> Column:
    """Unrounded ratio compared to a threshold; NULL (no rows) counts as False."""
    limit = F.lit(str(threshold)).cast("decimal(10,4)")
    return F.coalesce(exact_ratio(numerator, denominator) > limit, F.lit(False))


def flag(predicate: Column) -> Column:
    """0/1 integer flag from a predicate; NULL counts as 0."""
    return F.when(predicate, F.lit(1)).otherwise(F.lit(0))


def count_if(predicate: Column) -> Column:
    """``count(*) filter (where predicate)``."""
    return F.count(F.when(predicate, F.lit(1)))
