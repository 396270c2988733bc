"""Helpers of the training-data operators: native text forms, queues, staging."""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.session import staged

__all__ = ["ascii_lower", "documents", "free_name", "keep_rows", "queue_offsets", "ranked", "staged", "text_of"]

#: Slices of a queue. Sums of slices are prefixed, and rows are only ordered inside a slice, so a
#: source with a third of all rows is spread over this many groups.
QUEUE_SLICES = 4096


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, all other characters kept. Texts of single-byte characters take `lower`, which
    does the same there and is faster than `translate`."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of the table has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def queue_offsets(df: DataFrame, source: str, size: str, order: Iterable[str | Column],
                  slice_by: Column | None = None, start: str = "queue_start",
                  hold: str = "_slice") -> DataFrame:
    """Add `start`: the sum of `size` over the rows before this one in the queue of its source.

    A queue is ordered by (slice, `order`). The slice is `slice_by`, or a hash of the order
    columns. Only sums of slices are put in a row, and only rows of one slice are sorted
    together. `order` must settle every tie for the result to be repeatable.
    """
    order = [F.col(f"`{c}`") if isinstance(c, str) else c for c in order]
    by = slice_by if slice_by is not None else F.pmod(F.xxhash64(*order), F.lit(QUEUE_SLICES))
    rows = df.withColumn(hold, by)
    before = Window.partitionBy(f"`{source}`").orderBy(hold).rowsBetween(Window.unboundedPreceding, -1)
    base = (rows.groupBy(f"`{source}`", hold).agg(F.sum(f"`{size}`").alias("_total"))
            .select(F.col(f"`{source}`").alias("_source"), F.col(hold).alias("_held"),
                    F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base")))
    inside = (Window.partitionBy(f"`{source}`", hold).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    running = rows.withColumn("_inside", F.coalesce(F.sum(f"`{size}`").over(inside), F.lit(0)))
    joined = running.join(base, F.col(f"`{source}`").eqNullSafe(F.col("_source"))
                          & F.col(hold).eqNullSafe(F.col("_held")))
    return (joined.withColumn(start, (F.col("_base") + F.col("_inside")).cast("long"))
            .drop("_source", "_held", "_base", "_inside", hold))


def ranked(rows: DataFrame, group: str, order: Iterable[str]) -> DataFrame:
    """Add `rank` (from 0, in the given order, nulls first) within the group, and `total`, its rows.

    Rows are range-sorted by (group, order), so a group of any size lies in as many partitions as it
    needs; a row's rank is its place in its partition plus the group's rows in earlier ones, a table
    of one row per partition and group. `order` must tell all rows apart, as a number given to staged
    rows does, for equal rows to be spread too. The result is staged.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    placed = staged(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .withColumn("_place", F.monotonically_increasing_id())
                    .withColumn("_part", F.shiftright("_place", 33)), "placed")
    whole = Window.partitionBy("_group")
    earlier = whole.orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (placed.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_in"))
              .agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
              .select("_group", "_in", F.sum("_n").over(whole).alias("total"),
                      (F.col("_first") - F.coalesce(F.sum("_n").over(earlier), F.lit(0))).alias("_shift")))
    joined = placed.join(shifts, (F.col(group) == F.col("_group")) & (F.col("_part") == F.col("_in")))
    return staged(joined.withColumn("rank", F.col("_place") - F.col("_shift"))
                  .drop("_place", "_part", "_group", "_in", "_shift"), "ranked")


def keep_rows(docs: DataFrame, decided: DataFrame, key: str, digest: Column) -> DataFrame:
    """The rows of `docs` that `decided` (doc_id, digest, kept) keeps, in their columns.

    Keys that are unique and never null are matched alone. Otherwise rows are matched by key and
    `digest` of their text, and rows that agree in both are reduced to one."""
    kept = decided.where("kept")
    counts = decided.agg(F.count("*").alias("rows"), F.countDistinct("doc_id").alias("keys"))
    if not counts.where("rows = keys").isEmpty():
        one = kept.select(F.col("doc_id").alias("_kept"))
        return docs.join(one, F.col(f"`{key}`") == F.col("_kept"), "left_semi")
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{key}`").alias("id"), digest.alias("text_digest"))
    pairs = kept.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
    found = rows.join(pairs, F.col("id").eqNullSafe(F.col("_id"))
                      & (F.col("text_digest") == F.col("_digest")), "left_semi")
    return found.dropDuplicates(["id", "text_digest"]).select("row.*")
