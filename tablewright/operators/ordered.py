"""Running sums over a global order without one global sort.

Rows get a bucket that follows the order. Each bucket is summed on its own, and the totals of
the buckets before it, a table of as many rows as buckets were asked for, are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "__bucket"


def order_buckets(df: DataFrame, order: str, buckets: int | None = None) -> DataFrame:
    """Add `__bucket`, which grows with the numeric column `order`; equal values share one.

    The cut points are a few sketched quantiles, read once by a job, so every use of the result has
    the same buckets. A poor sketch makes buckets uneven but never a sum wrong.
    """
    wanted = max(2, buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    probs = [i / wanted for i in range(1, wanted)]
    seen = df.agg(F.percentile_approx(F.col(order).cast("double"), probs, 10 * wanted).alias("q")).first()
    splitter = Bucketizer(splits=[float("-inf"), *sorted(set(seen.q or [0.0])), float("inf")], inputCol="__order",
                          outputCol=BUCKET, handleInvalid="keep")
    keyed = df.withColumn("__order", F.col(order).cast("double"))
    return splitter.transform(keyed).drop("__order")


def running_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """Add inclusive running sums over the global order of a table from `order_buckets`.

    `sums` maps new columns to the expressions to add up.
    """
    parts = {f"__part_{name}": value for name, value in sums.items()}
    keyed = df.withColumns(parts)
    totals = keyed.groupBy(BUCKET).agg(*[F.sum(p).alias(p) for p in parts])
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(BUCKET, *[
        F.coalesce(F.sum(p).over(before), F.lit(0)).alias(f"__before_{p}") for p in parts
    ])
    inside = Window.partitionBy(BUCKET).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    summed = keyed.withColumns({name: F.sum(f"__part_{name}").over(inside) for name in sums})
    joined = summed.join(F.broadcast(offsets), BUCKET)
    return joined.withColumns({
        name: F.col(name) + F.col(f"__before___part_{name}") for name in sums
    }).drop(*parts, *[f"__before_{p}" for p in parts])
