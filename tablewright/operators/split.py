"""Seeded splits and samples (SPL1-SPL3)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.cleaning import col_of
from tablewright.session import staged

#: Hash digits used (60 bits) and the share of them that forms a bucket (20 bits).
HASH_DIGITS = 15
BUCKET_SHIFT = 40
#: Share of the hashes on each side of a cut's share whose keys are counted at once: four standard
#: deviations of the cut's place from some million rows on.
NEAR = 2 ** -9


def key_hash(keys: Sequence[str], seed: int = 42) -> Column:
    """A 60-bit hash of the row key as a long, the same in every run and engine."""
    text = F.concat_ws(":", F.lit(str(seed)), *[
        F.coalesce(col_of(k).cast("string"), F.lit("\\N")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("bigint")


def unit_hash(keys: Sequence[str], seed: int = 42) -> Column:
    """The hash of the row key as a number in [0, 1)."""
    return key_hash(keys, seed) / F.lit(float(16**HASH_DIGITS))


def hash_split(df: DataFrame, keys: Sequence[str], train: float = 0.7, val: float = 0.15,
               seed: int = 42) -> DataFrame:
    """SPL1: add `split` (train, val or test) by the key's hash.

    No shuffle; a row keeps its side however the table is stored, and copies of a key stay
    together. Sizes are approximate; `exact_split` gives exact ones.
    """
    u = unit_hash(keys, seed)
    return df.withColumn("split", F.when(u < F.lit(train), "train")
                         .when(u < F.lit(train + val), "val").otherwise("test"))


def exact_split(df: DataFrame, keys: Sequence[str], train: float = 0.7, val: float = 0.15,
                seed: int = 42, near: float = NEAR) -> DataFrame:
    """SPL1 with the sizes int(n * train), int(n * val) and the rest.

    Rows are cut in hash order. One scan counts the rows per hash bucket (2^20 at most) and, within
    `near` of the shares where the cuts are due, per key; both cuts are solved from that staged table.
    Hashes spread evenly, so a cut lies near its share unless the table is small or its keys repeat a
    lot; then another scan counts the keys of the bucket it lies in. These jobs run at once; the result
    places every row by comparison with the two cuts. Copies of one key stay together, so sizes are
    exact when the keys are unique.
    """
    h, u = key_hash(keys, seed), unit_hash(keys, seed)
    key = F.struct(h.alias("h"), F.to_json(F.struct(*[col_of(k) for k in keys])).alias("k"))
    rows = df.select(F.shiftright(h, BUCKET_SHIFT).alias("bucket"), key.alias("key"), u.alias("u"))
    due = [train, train + val]
    close = F.greatest(*[F.when(F.abs(F.col("u") - F.lit(d)) <= near, 1).otherwise(0) for d in due]) == 1
    counts = staged(rows.groupBy("bucket", F.when(close, F.col("key")).alias("key"))
                    .agg(F.count(F.lit(1)).alias("n")), "hashes")
    n = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    train_rows = math.floor(n * train)
    cuts = [_cut_place(counts, wanted) for wanted in (train_rows, train_rows + math.floor(n * val))]

    whole = 1 << HASH_DIGITS * 4 - BUCKET_SHIFT
    counted = [min(b / whole - d + near, d + near - (b + 1) / whole) > 0 if rank else True
               for d, (b, rank) in zip(due, cuts)]
    missed = sorted({b for (b, _), known in zip(cuts, counted) if not known})
    of_missed = staged(rows.filter(F.col("bucket").isin(missed)).groupBy("bucket", "key").agg(
        F.count(F.lit(1)).alias("n")), "bucket_keys") if missed else None
    last = [_last_key(counts if known else of_missed, b, rank) for (b, rank), known in zip(cuts, counted)]
    first, second = (F.struct(F.lit(a).cast("bigint").alias("h"), F.lit(k).alias("k")) for a, k in last)
    return df.withColumn("split", F.when(key <= first, "train").when(key <= second, "val").otherwise("test"))


def _cut_place(counts: DataFrame, wanted: int) -> tuple[int, int]:
    """The bucket in which the wanted number of rows is reached, and how many of its rows that takes."""
    up_to = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = counts.groupBy("bucket").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(up_to))
    place = buckets.filter(F.col("upto") >= wanted).agg(
        F.min_by(F.struct("bucket", (wanted - F.col("upto") + F.col("n")).alias("rank")), "bucket").alias("p")).first().p
    return (place.bucket, place.rank) if place else (0, 0)


def _last_key(counts: DataFrame, bucket: int, rank: int) -> tuple[int, str]:
    """Hash and key of the last key of a bucket whose rows all fit into `rank`; before the bucket, if none."""
    up_to = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.filter((F.col("bucket") == bucket) & F.col("key").isNotNull()).withColumn(
        "upto", F.sum("n").over(up_to))
    last = ranked.filter(F.col("upto") <= rank).agg(F.max("key").alias("last")).first().last
    return (last.h, last.k) if last else (bucket << BUCKET_SHIFT, "")


def fixed_sample(df: DataFrame, keys: Sequence[str], n: int = 1000, seed: int = 42) -> DataFrame:
    """SPL2: n rows in random but repeatable order: the n smallest hashes."""
    return df.orderBy(key_hash(keys, seed), *[col_of(c) for c in df.columns]).limit(n)


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    """SPL3: rows and percent per split."""
    sizes = df.groupBy(split).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return sizes.withColumn("percentage", F.try_divide(F.col("n") * F.lit(100.0), total))
