"""Pearson correlation of all column pairs (COR1-COR3, FLT7, SRT1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.gram import pair_moments
from tablewright.operators.projection import numeric_columns


def _correlations(df: DataFrame, cols: Sequence[str] | None) -> DataFrame:
    """a, b, col_a, col_b, corr of all pairs a <= b whose correlation is defined."""
    cols = list(cols or numeric_columns(df))
    if not cols:
        return df.sparkSession.createDataFrame([], "a int, b int, col_a string, col_b string, corr double")
    names = F.array(*[F.lit(c) for c in cols])
    spread = F.sqrt("square_a") * F.sqrt("square_b")
    ratio = F.try_divide("product", spread)
    corr = (F.when(ratio.isNull() | F.isnan(ratio), None).when(F.col("a") == F.col("b"), 1.0)
            .otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ratio))))
    return pair_moments(df, cols).select(
        "a", "b", names[F.col("a")].alias("col_a"), names[F.col("b")].alias("col_b"),
        corr.alias("corr")).filter("corr is not null")


def correlation_pairs(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """COR2: every unordered pair of columns once; undefined correlations are left out.

    A pair uses the rows that have both values (T13), and is undefined when either side is constant
    there or infinite in one of them. The table is read once, however many columns there are.
    """
    return _correlations(df, cols).filter("a < b").select("col_a", "col_b", "corr")


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """COR1: the full square matrix in long form: the pairs in both orders and the diagonal.

    Undefined cells are absent; a constant column has no diagonal cell either.
    """
    there = F.struct("col_a", "col_b")
    back = F.struct(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"))
    cells = F.when(F.col("a") == F.col("b"), F.array(there)).otherwise(F.array(there, back))
    return _correlations(df, cols).select("corr", F.inline(cells)).select("col_a", "col_b", "corr")


def significant_pairs(df: DataFrame, cols: Sequence[str] | None = None,
                      threshold: float = 0.7) -> DataFrame:
    """COR3: pairs with |r| of at least the threshold, strongest first."""
    return strong_pairs(correlation_pairs(df, cols), threshold)


def strong_pairs(pairs: DataFrame, threshold: float = 0.7) -> DataFrame:
    """COR3 from pairs already at hand."""
    return (
        pairs.withColumn("abs_corr", F.abs("corr"))
        .filter(F.col("abs_corr") >= F.lit(threshold))
        .orderBy(F.desc("abs_corr"), "col_a", "col_b")
    )
