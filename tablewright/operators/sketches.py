"""Quantile sketches of columns that merge, and searches that start from them.

A sketch is kept beside the table it was made of. Those of all snapshots together give the sketch of
all rows, so a new drop costs a scan of its own rows alone. A sketch answers a quantile within a bound
on its rank; the values at the two ends of that bound are the bracket from which the exact search
starts, which then needs no first scan. A bracket that missed its rank, as the bound holds for nearly
all draws only, is found by the counts of the next scan and widened there.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.profile import long_rows, row_sql
from tablewright.operators.projection import numeric_columns
from tablewright.operators.quantiles import (
    LAST_VALUES, ColumnStart, Wishes, all_wishes, measure_sql, search_quantiles, sql_double, sql_text,
)

#: Parameter of the sketches: some 3 * K numbers a column, and a rank known to 3 / K of the rows in
#: more than 99 of 100 draws.
K = 4096
RANK_BOUND = 3 / K


def column_sketches(df: DataFrame, cols: Sequence[str] | None = None, k: int = K) -> DataFrame:
    """One row per column: column, n (values), low, high, sketch. One scan for all columns."""
    rows = []
    for c in cols or numeric_columns(df):
        m = measure_sql(df, c)
        rows.append(row_sql(column=sql_text(c), n=f"count({m})", low=f"min({m})", high=f"max({m})",
                            sketch=f"kll_sketch_agg_double({m}, {k})"))
    return long_rows(df, rows)


def merge_column_sketches(parts: Sequence[DataFrame]) -> DataFrame:
    """The sketches of all parts together. They must come from different rows."""
    return reduce(DataFrame.unionByName, parts).groupBy("column").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.expr("kll_merge_agg_double(sketch)").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, wishes: Wishes, bound: float = RANK_BOUND) -> DataFrame:
    """column, share, value, low, high: the estimate, and the values at the ends of its rank bound. A
    column without values has none."""
    wishes = all_wishes(wishes)
    points, rows = [], []
    for c, probs in wishes.items():
        ends = [(max(p - bound, 0.0), min(p + bound, 1.0)) for p in probs]
        asked = ", ".join(sql_double(v) for p, (lo, hi) in zip(probs, ends) for v in (p, lo, hi))
        points.append(f"WHEN {sql_text(c)} THEN kll_sketch_get_quantile_double(sketch, array({asked}))")
        cells = [row_sql(share=sql_double(p), value=f"points[{3 * i}]",
                         low=f"points[{3 * i + 1}]" if lo > 0 else "low", high=f"points[{3 * i + 2}]" if hi < 1 else "high")
                 for i, (p, (lo, hi)) in enumerate(zip(probs, ends))]
        rows.append(f"WHEN {sql_text(c)} THEN array({', '.join(cells)})")
    known = sketches.filter(F.col("column").isin(list(wishes)) & (F.col("n") > 0))
    return (known.selectExpr("column", "low", "high", f"CASE column {' '.join(points)} END AS points")
            .selectExpr("column", f"inline(CASE column {' '.join(rows)} END)"))


def search_starts(sketches: DataFrame, wishes: Wishes) -> dict[str, ColumnStart]:
    """Where `search_quantiles` starts from, by these sketches: a few numbers per wish."""
    ends = {r.column: r for r in sketches.select("column", "n", "low", "high").collect()}
    absent = sorted(set(wishes) - set(ends))
    if absent:
        raise KeyError(f"no sketch of {', '.join(absent)}")
    brackets: dict[str, dict[float, tuple[float, float]]] = {}
    for r in sketch_quantiles(sketches, wishes).collect():
        brackets.setdefault(r.column, {})[r.share] = (r.low, r.high)
    return {c: ColumnStart(ends[c].n, ends[c].low, ends[c].high, brackets.get(c, {})) for c in wishes}


def quantiles_from(df: DataFrame, sketches: DataFrame, wishes: Wishes,
                   last: int = LAST_VALUES) -> dict[tuple[str, float], float | None]:
    """Exact quantiles of `df`, whose rows the sketches were made of, without the first scan."""
    return search_quantiles(df, wishes, last, search_starts(sketches, wishes))
