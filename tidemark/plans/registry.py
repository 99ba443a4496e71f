"""Where queries and their checking SQL are collected under one name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query function, with SQL that must give the same rows."""

    def keep(function):
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return keep


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round columns for comparison: sums of doubles depend on the order of rows."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})
