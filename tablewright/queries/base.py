"""The registry and helpers shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and the SQL that gives the same table where SQL can say it."""
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round double columns, so that the order of additions does not show."""
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), places).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f"`{f.name}`") for f in df.schema
    ])


def rounded_sql(sql: str, doubles: Sequence[str], places: int = 6) -> str:
    """The same rounding around a SQL text."""
    replaced = ", ".join(f"round({c}, {places}) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({replaced}) FROM ({sql}) AS q"


def union_sql(parts: Sequence[str]) -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)
