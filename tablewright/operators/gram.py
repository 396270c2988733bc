"""Pairwise-complete moments of any number of columns from one scan.

Each task turns its rows into a block of values and a block of presence marks. Their products hold,
for all pairs at once, the rows both columns have and the sums over those rows. Blocks are centred
before they are multiplied and merged by their means, so neither a large offset nor the number of
rows costs digits. A task keeps five squares of the number of columns, however many rows it reads, and
hands on one row per pair; those are merged in one exchange.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.quantiles import measure_sql

#: Rows of a block, and the share of a sum of squares below which a difference is taken again.
BLOCK_ROWS = 4096
LOST_DIGITS = 1e-9
PARTIAL = ("a int, b int, n double, mean_a double, mean_b double, square_a double, square_b double, "
           "product double")


def block_moments(x: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a block of rows: n, mean, square, product, each a square over (a, b): rows with both, mean
    and sum of squared deviations of a over them, sum of products of deviations. NaN is missing; where
    an infinite value takes part, squares and products are NaN."""
    there, wild = ~np.isnan(x), np.isinf(x)
    columns = np.arange(x.shape[1])
    first = x[there.argmax(0), columns]
    first = np.where(np.isfinite(first), first, 0.0)
    with np.errstate(all="ignore"):
        d = np.where(there & ~wild, x - first, 0.0)
        p = there.astype(float)
        n, total, square, product = p.T @ p, d.T @ p, (d * d).T @ p, d.T @ d
        mean = np.divide(total, n, out=np.zeros_like(total), where=n > 0)
        left = square - total * mean
        product = product - total * mean.T
    center = first[:, None] + mean
    lost = (n > 0) & (square > 0) & ~(left > LOST_DIGITS * square)
    for a, b in np.argwhere(np.triu(lost | lost.T)):
        both = there[:, a] & there[:, b]
        u, v = x[both, a], x[both, b]
        with np.errstate(all="ignore"):
            mu, mv = (w[0] if (w == w[0]).all() else w.mean() for w in (u, v))
            center[a, b], center[b, a] = mu, mv
            left[a, b], left[b, a] = ((u - mu) ** 2).sum(), ((v - mv) ** 2).sum()
            product[a, b] = product[b, a] = ((u - mu) * (v - mv)).sum()
    if wild.any():
        broken = (wild.astype(float).T @ p) > 0
        left[broken] = np.nan
        product[broken | broken.T] = np.nan
        center[broken] = 0.0
    return n, center, np.maximum(left, 0.0), product


def merged_moments(one: tuple | None, two: tuple) -> tuple[np.ndarray, ...]:
    """The moments of two blocks together; equal means stay what they are."""
    if one is None:
        return two
    (n1, m1, s1, p1), (n2, m2, s2, p2) = one, two
    n = n1 + n2
    share = np.divide(n2, n, out=np.zeros_like(n), where=n > 0)
    apart, weight = np.where((n1 > 0) & (n2 > 0), m2 - m1, 0.0), n1 * share
    mean = np.where(n1 > 0, m1 + apart * share, m2)
    return n, mean, s1 + s2 + apart * apart * weight, p1 + p2 + apart * apart.T * weight


def gram_partials(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per task and pair of column numbers a <= b that have a common row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                held = merged_moments(held, block_moments(np.column_stack(
                    [c.to_numpy(zero_copy_only=False) for c in part.columns])))
        if held is None:
            return
        n, mean, square, product = held
        for a in range(len(n)):  # a row of the squares at a time
            b = a + np.flatnonzero(n[a, a:] > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(b), a), pa.int32()), pa.array(b, pa.int32()),
                 *(pa.array(v, pa.float64()) for v in (n[a, b], mean[a, b], mean[b, a], square[a, b],
                                                       square[b, a], product[a, b]))],
                names=["a", "b", "n", "mean_a", "mean_b", "square_a", "square_b", "product"])

    numbers = df.selectExpr(*[f"{measure_sql(df, c)} AS m{i}" for i, c in enumerate(cols)])
    return numbers.mapInArrow(run, PARTIAL)


def pair_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """a, b (column numbers, a <= b), n, square_a, square_b, product over the rows that have both.

    Means are merged as distances from the smallest one, so that equal means give exactly no
    deviation and a column constant over a pair's rows has exactly no square.
    """
    pair = Window.partitionBy("a", "b")
    n = F.col("n")

    def away(side: str) -> Column:
        return F.col(f"mean_{side}") - F.col(f"low_{side}") - F.col(f"shift_{side}")

    shifts = {f"shift_{s}": F.sum(n * (F.col(f"mean_{s}") - F.col(f"low_{s}"))).over(pair) / F.sum(n).over(pair)
              for s in "ab"}
    return (gram_partials(df, cols)
            .withColumns({f"low_{s}": F.min(f"mean_{s}").over(pair) for s in "ab"}).withColumns(shifts)
            .groupBy("a", "b").agg(
                F.sum("n").cast("long").alias("n"),
                *[F.sum(F.col(f"square_{s}") + n * away(s) * away(s)).alias(f"square_{s}") for s in "ab"],
                F.sum(F.col("product") + n * away("a") * away("b")).alias("product")))
