"""Sources (SRC1-SRC4, SRT6)."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.cleaning import col_of
from tablewright.operators.projection import normalize_table
from tablewright.operators.sketches import merge_column_sketches

ROW_ORDER = "__row_order"


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Names and sizes of the files under a folder; the contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option(
        "recursiveFileLookup", "true").load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", "length")


def latest_file(spark: SparkSession, path: str, pattern: str, skip: Sequence[str] = ()) -> str:
    """SRT6: the last by name of the drops in a folder; a drop is a file or a folder of parts."""
    root = path.rstrip("/")
    bare = re.sub(r"^[a-z0-9]+:/*(?=/)", "", root)
    name = F.regexp_extract("path", rf"\Q{bare}\E/([^/]+)", 1)
    found = list_files(spark, root).select(name.alias("name")).filter(
        F.col("name").rlike(fnmatch.translate(pattern))
        & ~F.col("name").isin(*skip)).agg(F.max("name")).first()[0]
    if found is None:
        raise FileNotFoundError(f"no file {pattern} in {path}")
    return f"{root}/{found}"


def header_groups(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files under a path by their header line; one file needs no look inside."""
    files = [r.path for r in list_files(spark, path).filter(~F.col("file_name").rlike("^[._]")).select("path").collect()]
    if len(files) < 2:
        return {"": files}
    lines = spark.read.text(files).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at")).filter("block = 0")
    heads = lines.groupBy("file").agg(F.min_by("value", "at").alias("head"))
    groups: dict[str, list[str]] = {}
    for row in heads.orderBy("file").collect():
        groups.setdefault(row.head, []).append(row.file)
    return groups


def read_csv(spark: SparkSession, path: str, cols: Sequence[str] | None = None,
             multi_line: bool = True, row_order: bool = False) -> DataFrame:
    """A CSV table with header, all text, missing texts as NULL; the cleaning step casts.

    Columns go by header name: files of a folder are read by groups of equal headers, and a column
    that only some files have is NULL for the others. `multi_line` allows line breaks inside quoted
    cells but reads a file in one task; turn it off for large files without such cells. `row_order`
    adds a column that follows the rows of the files (T8): file, start of the split, place within
    the split.
    """
    parts = []
    groups = header_groups(spark, path)
    for files in groups.values():
        part = spark.read.options(header="true", escape='"', multiLine=str(multi_line).lower()).csv(
            files if len(groups) > 1 else path)
        names = part.columns
        if row_order:
            part = part.withColumn(ROW_ORDER, F.struct("_metadata.file_path", "_metadata.file_block_start",
                                                       F.monotonically_increasing_id().alias("place")))
        parts.append((part, names))
    df, seen = parts[0][0], list(parts[0][1])
    for part, names in parts[1:]:
        df = df.unionByName(part, allowMissingColumns=True)
        seen += [n for n in names if n not in seen]
    return normalize_table(df.select(*[col_of(c) for c in (cols or seen)], *([ROW_ORDER] if row_order else [])))


def read_latest_csv(spark: SparkSession, path: str, pattern: str, skip: Sequence[str] = (),
                    cols: Sequence[str] | None = None, multi_line: bool = True,
                    row_order: bool = False) -> DataFrame:
    """SRC1: the newest raw CSV of a folder."""
    return read_csv(spark, latest_file(spark, path, pattern, skip), cols, multi_line, row_order)


def latest_snapshot(spark: SparkSession, path: str) -> str:
    """The name of the newest landed snapshot, from the folder names alone."""
    return latest_file(spark, path, "snapshot=*").rsplit("=", 1)[1]


def read_snapshot(spark: SparkSession, path: str, snapshot: str | None = None) -> DataFrame:
    """SRC1 over landed snapshots: only one is read, the newest by default."""
    wanted = snapshot or latest_snapshot(spark, path)
    return spark.read.parquet(f"{path.rstrip('/')}/snapshot={wanted}")


def read_sketches(spark: SparkSession, path: str, snapshots: Sequence[str]) -> DataFrame:
    """The merged quantile sketches that were kept with the given snapshots."""
    return merge_column_sketches([spark.read.parquet(f"{path.rstrip('/')}/_sketches/{s}") for s in snapshots])


def read_stage(spark: SparkSession, path: str, row_order: bool = False) -> DataFrame:
    """SRC2, SRC4: the Parquet output of an earlier stage; an absent one raises. `row_order` adds the
    place of each row, file and index within it, which is the same in every scan."""
    table = spark.read.parquet(path)
    return table.withColumn(ROW_ORDER, F.struct("_metadata.file_path", "_metadata.row_index")) if row_order else table


def read_splits(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """SRC3: the train, val and test parts written by `write_splits`; an absent one is an error."""
    table = spark.read.parquet(path)
    names = {row[0] for row in table.select("split").distinct().collect()}
    absent = {"train", "test"} - names
    if absent:
        raise FileNotFoundError(f"{path} has no {', '.join(sorted(absent))} rows")
    return {s: table.filter(F.col("split") == s).drop("split") for s in ("train", "val", "test")}
