"""Registry of checked queries: name -> Spark callable, name -> SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column: engines add in different orders, so the last bits differ."""
    return df.select([
        F.round(f"`{f.name}`", digits).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def r4(*columns: str) -> str:
    """SQL select items ``round(c, 4) AS c``."""
    return ", ".join(f"round({c}, 4) AS {c}" for c in columns)
