"""Collects the registered queries and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without ``sql`` it is only checked to run."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int, *cols: str, shift: float = 0.0) -> DataFrame:
    """Round the named columns, to compare sums taken in different orders.

    Engines break decimal ties differently.  Where the values often end in a 5
    just past the last digit, both sides add a ``shift`` far below that digit.
    """
    return df.withColumns({c: F.round(F.col(c) + F.lit(shift) if shift else F.col(c), digits) for c in cols})


def r(col: Column, digits: int) -> Column:
    return F.round(col, digits)
