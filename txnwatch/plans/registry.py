"""Registry of named queries (Spark) and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def r6(c: str | Column, name: str | None = None) -> Column:
    """Round a double to 6 places (both sides of an R-class oracle do this)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), 6).alias(name or (c if isinstance(c, str) else None))
