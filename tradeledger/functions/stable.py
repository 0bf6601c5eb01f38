"""Sums and means of doubles that do not depend on the order of the rows.

Adding doubles is not associative: a retry, another partitioning or an adaptive
re-plan changes the last digits of ``sum(double)``. Here every value is cut into
an integer part and two six-digit fractions, each summed as a long, so the result
is the same on every run and map-side partial sums stay as cheap as plain sums.
Digits below 1e-12 are dropped; longs hold 9e12 rows per group.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLION = 1e6


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _parts_sum(c: Column) -> Column:
    first = (c - F.floor(c)) * MILLION
    second = (first - F.floor(first)) * MILLION
    return F.sum(F.floor(c)) + (F.sum(F.floor(first)) + F.sum(F.floor(second)) / MILLION) / MILLION


def stable_sum(c: Column | str) -> Column:
    """Sum of a double column; null when every value is null."""
    return _parts_sum(_col(c))


def stable_total(c: Column | str) -> Column:
    """Sum of a double column; 0 when every value is null (the dataframe convention)."""
    return F.coalesce(stable_sum(c), F.lit(0.0))


def stable_avg(c: Column | str) -> Column:
    """Mean of the non-null values; null when there are none."""
    value = _col(c)
    # the sum is null whenever the count is 0, so the guard only avoids the ANSI error
    return stable_sum(value) / F.greatest(F.count(value), F.lit(1))


def share(condition: Column) -> Column:
    """Part of the rows (0..1) where ``condition`` holds; null counts as false."""
    return F.avg(F.when(condition, 1).otherwise(0))


def pct(condition: Column) -> Column:
    return share(condition) * 100


def count_where(condition: Column) -> Column:
    """Number of rows where ``condition`` holds; 0 on an empty table."""
    return F.count(F.when(condition, F.lit(1)))
