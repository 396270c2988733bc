"""Column selection (PRJ1-PRJ8)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.cleaning import col_of, nan_to_null, normalize_missing


def select_strict(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PRJ1: exactly these columns; a missing one is an error."""
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df.select(*[col_of(c) for c in cols])


def select_lenient(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PRJ2: those of the listed columns that exist, in list order."""
    return df.select(*[col_of(c) for c in cols if c in df.columns])


def drop_present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """PRJ3: drop the listed columns that exist."""
    return df.drop(*[c for c in cols if c in df.columns])


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """PRJ4, PRJ5: numeric columns in table order, without booleans and without `exclude`."""
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def column_kind(data_type: T.DataType) -> str:
    """The class of a column: numeric, text, datetime, boolean or other."""
    if isinstance(data_type, T.NumericType):
        return "numeric"
    if isinstance(data_type, (T.StringType, T.VarcharType, T.CharType)):
        return "text"
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    return "other"


def align_columns(df: DataFrame, expected: Sequence[str], fill_value=0) -> DataFrame:
    """PRJ6: the expected columns in their order; absent ones hold `fill_value`, extras go."""
    return df.select(*[
        col_of(c) if c in df.columns else F.lit(fill_value).alias(c) for c in expected
    ])


def bind_columns(df: DataFrame, derived: Mapping[str, Column]) -> DataFrame:
    """PRJ7, PRJ8: append derived columns in one projection."""
    return df.withColumns(dict(derived))


def normalize_table(df: DataFrame) -> DataFrame:
    """What a CSV hand-off does to a table: missing texts and NaN become NULL."""
    out = []
    for f in df.schema:
        c = col_of(f.name)
        if isinstance(f.dataType, T.StringType):
            c = normalize_missing(c).alias(f.name)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = nan_to_null(c).alias(f.name)
        out.append(c)
    return df.select(*out)
