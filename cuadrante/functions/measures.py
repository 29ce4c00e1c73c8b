"""Statistics written as Columns over aggregates or whole-table scalars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEIGHT_EPSILON = 1e-9


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def weighted_mean(value, weight, eps: float = WEIGHT_EPSILON) -> Column:
    """Aggregate: sum(v w) / sum(w + eps).  Rows with a null weight do not count,
    and a group with no weight at all gives null."""
    v, w = _col(value), _col(weight)
    return F.try_divide(F.sum(v * w), F.sum(w + F.lit(eps)))


def global_stats(df: DataFrame, cols) -> dict[str, dict[str, Column]]:
    """avg, std, min, max, sum and rows of whole columns as scalar subqueries.

    One aggregate with map-side partials computes them all; the plan reads the
    single row as a subquery value, so nothing is collected or cross-joined.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    fields = []
    for c in cols:
        x = F.col(c)
        fields += [
            F.avg(x).alias(f"{c}__avg"),
            F.stddev(x).alias(f"{c}__std"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
            F.sum(x).alias(f"{c}__sum"),
            F.count(x).alias(f"{c}__rows"),
        ]
    row = df.agg(F.struct(*fields).alias("stats")).scalar()
    kinds = ("avg", "std", "min", "max", "sum", "rows")
    return {c: {k: row[f"{c}__{k}"] for k in kinds} for c in cols}


def zscore(value, avg: Column, std: Column) -> Column:
    """(x - avg) / std; null when the deviation is zero or missing."""
    return F.try_divide(_col(value) - avg, std)


def minmax(value, low: Column, high: Column) -> Column:
    """(x - low) / (high - low); null when all values are equal."""
    return F.try_divide(_col(value) - low, high - low)


def log_density(count) -> Column:
    """ln(count + 1)."""
    return F.ln(_col(count) + F.lit(1))


def floor_at(value, low: float) -> Column:
    """The larger of ``value`` and ``low`` that stays null for a null value.
    (``greatest`` alone would skip the null.)"""
    v = _col(value)
    return F.when(v.isNotNull(), F.greatest(v, F.lit(low)))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once and use it by name inside an expression.

    A column used inside a lambda would be inlined there and computed again for
    every element.
    """
    return F.element_at(F.transform(F.array(value), use), 1)
