"""Registry of runnable queries and their SQL restatements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with an optional SQL restatement."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return wrap


#: Added before rounding so that exact decimal ties fall to the same side in both engines.
_OFF_TIE = 2.3e-8


def r6(c: Column | str, digits: int = 6) -> Column:
    """Round for comparison; adding 0.0 removes a negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double") + F.lit(_OFF_TIE), digits) + F.lit(0.0)


def q6(*names: str, digits: int = 6) -> str:
    """The same rounding as SQL text, keeping the names."""
    return ", ".join(f"round(CAST({n} AS DOUBLE) + CAST({_OFF_TIE} AS DOUBLE), {digits}) + 0.0 AS {n}" for n in names)


def rounded(df: DataFrame, keep: str, names: str, digits: int = 6) -> DataFrame:
    """Select the ``keep`` columns and the rounded ``names`` (both blank-separated)."""
    return df.select(*keep.split(), *[r6(n, digits).alias(n) for n in names.split()])
