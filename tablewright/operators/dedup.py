"""Duplicates (DUP1-DUP5)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.cleaning import col_of
from tablewright.operators.quantiles import sql_name


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
               place: str | None = None) -> DataFrame:
    """DUP1: the first row of each key in the given order; missing keys form one group.

    An aggregate, not a window: every task first reduces its own rows to one per key, so a key
    that holds a large share of the table ships one row per task and never meets in one sort.
    The minimum is taken over (order columns, other columns), which settles ties of the order
    the same way in every run.

    With `place`, a column that tells all rows apart as a row's place in its file does, wide columns
    come late: only (key, order, place) is sorted and shuffled, to find the first row of each key that
    has several. Rows then pass or fail where they lie if these keys are few enough to be broadcast,
    which Spark decides by their size; else they are joined by key, and a hot key's rows are split,
    as the other side has one row per key. Ties of the order go by place.
    """
    if place is not None:
        return _keep_first_late(df, keys, [*order_by, place])
    rest = [c for c in df.columns if c not in keys]
    ranked = [c for c in order_by if c not in keys]
    ranked += [c for c in rest if c not in ranked]
    if not rest:
        return df.dropDuplicates(list(keys))
    first = df.groupBy(*[col_of(k) for k in keys]).agg(
        F.min(F.struct(*[col_of(c) for c in ranked])).alias("__first")
    )
    return first.select(*[
        col_of(c) if c in keys else F.col("__first").getField(c).alias(c) for c in df.columns
    ])


def _keep_first_late(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    at = F.struct(*[col_of(c).alias(f"o{i}") for i, c in enumerate(order)])
    names = [f"__key{i}" for i in range(len(keys))]
    firsts = (df.select(*[col_of(k).alias(n) for k, n in zip(keys, names)], at.alias("__at"))
              .groupBy(*names).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
              .filter("__rows > 1").drop("__rows"))
    same = reduce(and_, [col_of(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    return df.join(firsts, same, "left").filter(F.col("__first").isNull() | (at == F.col("__first"))).select(
        *[col_of(c) for c in df.columns])


def row_digest(df: DataFrame, cols: Sequence[str]) -> Column:
    """SHA-256 over the columns, each as text behind its length; equal rows have equal digests."""
    parts = []
    for c in cols:
        value = "`" + c.replace("`", "``") + "`"
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            value = f"({value} + double('0'))"  # -0.0 equals 0.0
        text = f"string({value})"
        parts.append(f"coalesce(octet_length({text}) || ':' || {text}, '-')")
    return F.expr(f"unhex(sha2(concat({', '.join(parts)}), 256))")


def duplicate_groups(df: DataFrame, cols: Sequence[str] | None = None,
                     digest: bool = False) -> DataFrame:
    """One row per distinct combination of `cols` (all columns by default) with its row count, `n`.

    `digest` suits long texts: what is shuffled is 32 bytes per row left after the partial count,
    not the text. For rows of numbers and short texts it costs more than it saves.
    """
    cols = list(cols or df.columns)
    keys = [row_digest(df, cols).alias("digest")] if digest else [col_of(c) for c in cols]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def duplicate_counts(df: DataFrame, cols: Sequence[str] | None = None,
                     digest: bool = False) -> DataFrame:
    """DUP2-DUP4: total rows, distinct groups, surplus rows and rows in groups of two or more.

    A missing value equals a missing value.
    """
    n = F.col("n")
    return duplicate_groups(df, cols, digest).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_groups"),
        F.coalesce(F.sum(n - 1), F.lit(0)).alias("surplus_rows"),
        F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("member_rows"),
    )


def cell_digests(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """place (of the column in `cols`), digest: one row per cell that has a value, 16 bytes for the value
    whatever its length. Missing are NULL and NaN; -0.0 equals 0.0."""
    cells = []
    for i, c in enumerate(cols):
        name = sql_name(c)
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            value = f"string(nullif({name}, double('NaN')) + double('0'))"
        elif isinstance(df.schema[c].dataType, (T.StringType, T.BinaryType, T.NumericType, T.DateType,
                                                T.TimestampType, T.TimestampNTZType, T.BooleanType)):
            value = f"string({name})" if not isinstance(df.schema[c].dataType, T.BinaryType) else name
        else:
            value = f"CASE WHEN {name} IS NOT NULL THEN to_json(struct({name})) END"
        cells.append(f"struct({i} AS place, unhex(md5(binary({value}))) AS digest)")
    return df.selectExpr(f"inline(array({', '.join(cells)}))").filter("digest IS NOT NULL")


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None,
                    mode: str = "exact") -> DataFrame:
    """DUP5: distinct values per column, missing ones not counted, in long form.

    'exact': the cells of all columns go through one exchange as (column, 16-byte digest), after each
    task has reduced its own to a set, so neither long texts nor frequent values are moved. 'approx'
    is the estimate of `distinct_sketches`.
    """
    cols = list(cols or df.columns)
    if mode == "approx":
        return estimated_counts(distinct_sketches(df, cols))
    if mode != "exact":
        raise ValueError(f"unknown mode {mode!r}")
    counts = cell_digests(df, cols).distinct().groupBy("place").agg(
        F.count(F.lit(1)).alias("n"))
    names = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in cols])).alias("place", "column"))
    return names.join(counts, "place", "left").select(
        "column", F.coalesce("n", F.lit(0)).cast("bigint").alias("unique_values"))


def distinct_sketches(df: DataFrame, cols: Sequence[str] | None = None, bits: int = 14) -> DataFrame:
    """One row per column: column, sketch (HyperLogLog of its values, some 2^`bits` bytes at most).

    Sketches of parts merge into that of the whole, so a new snapshot need not be counted with all
    earlier ones: keep the table of sketches beside each snapshot."""
    cols = list(cols or df.columns)
    cells = cell_digests(df, cols)
    return cells.groupBy("place").agg(F.hll_sketch_agg("digest", bits).alias("sketch")).select(
        F.array(*[F.lit(c) for c in cols])[F.col("place")].alias("column"), "sketch")


def merge_sketches(parts: Sequence[DataFrame]) -> DataFrame:
    """The sketches of all parts together, by column."""
    return reduce(DataFrame.unionByName, parts).groupBy("column").agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated_counts(sketches: DataFrame) -> DataFrame:
    """DUP5 from sketches."""
    return sketches.select("column", F.hll_sketch_estimate("sketch").alias("unique_values"))
