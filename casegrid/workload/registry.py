"""Query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, folder) -> DataFrame function and its SQL equivalent."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6, *cols: str) -> DataFrame:
    """Round float columns (all of them by default) for a stable comparison."""
    names = cols or tuple(c for c, t in df.dtypes if t in ("double", "float"))
    return df.withColumns({c: F.round(c, digits) for c in names})
