"""Interquartile-range outliers (OUT1-OUT3, FLT6)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.cleaning import percent_text
from tablewright.operators.profile import long_rows, percent_sql, row_sql
from tablewright.operators.projection import numeric_columns
from tablewright.operators.quantiles import (
    measure_sql, quantile_row, sql_double, sql_name, sql_text, with_stats,
)


def fences(df: DataFrame, cols: Sequence[str], k: float = 1.5, mode: str = "exact") -> DataFrame:
    """One row: per column a struct of quartiles and fences. Fit once, apply to any table."""
    return fences_of(quantile_row(df, cols, [0.25, 0.5, 0.75], mode), cols, k)


def fences_of(quartiles: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """The fences from a row of quartile arrays."""
    reach = sql_double(float(k))
    structs = []
    for c in cols:
        q = sql_name(c)
        fields = row_sql(q1=f"{q}[0]", median=f"{q}[1]", q3=f"{q}[2]",
                         lower_bound=f"{q}[0] - {reach} * ({q}[2] - {q}[0])",
                         upper_bound=f"{q}[2] + {reach} * ({q}[2] - {q}[0])")
        structs.append(f"{fields} AS {q}")
    return quartiles.selectExpr(*structs)


def _fence(c: str, part: str) -> str:
    return f"__stats.{sql_name(c)}.{part}"


def outside_sql(df: DataFrame, c: str) -> str:
    """Strictly outside the attached fences; a missing value is not."""
    x = measure_sql(df, c)
    return (f"coalesce({x} < {_fence(c, 'lower_bound')} OR {x} > {_fence(c, 'upper_bound')}, false)")


def iqr_outliers(df: DataFrame, cols: Sequence[str] | None = None, k: float = 1.5,
                 exclude: Iterable[str] = (), fitted: DataFrame | None = None,
                 mode: str = "exact") -> DataFrame:
    """OUT1: columns with outliers: count, percent of rows, fences."""
    skip = set(exclude)
    cols = [c for c in (cols or numeric_columns(df)) if c not in skip]
    fitted = fences(df, cols, k, mode) if fitted is None else fitted
    rows = []
    for c in cols:
        n = f"count_if({outside_sql(df, c)})"
        rows.append(row_sql(
            column=sql_text(c), outlier_count=n, outlier_pct=percent_sql(n),
            lower_bound=f"first({_fence(c, 'lower_bound')})",
            upper_bound=f"first({_fence(c, 'upper_bound')})"))
    return long_rows(with_stats(df, fitted), rows).filter("outlier_count > 0")


def iqr_outliers_text(df: DataFrame, cols: Sequence[str] | None = None, k: float = 1.5,
                      exclude: Iterable[str] = (), fitted: DataFrame | None = None,
                      mode: str = "exact") -> DataFrame:
    """OUT2: the same report with the percent as text."""
    return iqr_outliers(df, cols, k, exclude, fitted, mode).withColumn(
        "outlier_pct", percent_text("outlier_pct"))


def outlier_rows(df: DataFrame, col: str, k: float = 1.5, fitted: DataFrame | None = None,
                 mode: str = "exact") -> DataFrame:
    """FLT6: the rows whose value lies outside the fences."""
    fitted = fences(df, [col], k, mode) if fitted is None else fitted
    return with_stats(df, fitted).filter(outside_sql(df, col)).drop("__stats")


def boxplot_stats(df: DataFrame, cols: Sequence[str] | None = None, k: float = 1.5,
                  fitted: DataFrame | None = None, mode: str = "exact") -> DataFrame:
    """OUT3: quartiles, whiskers (extremes inside the fences) and number of outliers."""
    cols = list(cols or numeric_columns(df))
    fitted = fences(df, cols, k, mode) if fitted is None else fitted
    rows = []
    for c in cols:
        outside = outside_sql(df, c)
        inside = f"CASE WHEN NOT {outside} THEN {measure_sql(df, c)} END"
        rows.append(row_sql(
            column=sql_text(c),
            **{f: f"first({_fence(c, f)})" for f in ("q1", "median", "q3")},
            whisker_low=f"min({inside})", whisker_high=f"max({inside})",
            outlier_count=f"count_if({outside})"))
    return long_rows(with_stats(df, fitted), rows)
