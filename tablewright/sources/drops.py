"""Drops with a commit mark (SRC1, SRC5, SRT6): a ledger beside the data says what a folder holds.

A drop is a folder of CSV parts, or a single CSV file, below a landing folder. Its lines in the ledger
`_drops` are written after its last byte, so a drop without a line is not there yet, and readers take
name, header and size from the ledger: no listing of all drops, and no look into their text. One
writer lands a drop; two that land the same name at once are not told apart.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.cleaning import col_of
from tablewright.operators.projection import normalize_table
from tablewright.sources.facts import WriteFacts, observed_write
from tablewright.sources.readers import ROW_ORDER, list_files
from tablewright.sources.writers import write_csv

#: One line per drop and header. `files` names the parts with this header, NULL if all parts have it;
#: `n_rows` is NULL where the drop was written by others.
MARK_SCHEMA = "drop string, columns array<string>, files array<string>, n_files bigint, n_bytes bigint, n_rows bigint"
TAKEN_SCHEMA = "drop string"


def committed_drops(spark: SparkSession, path: str) -> DataFrame:
    """The ledger of a landing folder; empty where nothing was committed."""
    return _ledger(spark, f"{path.rstrip('/')}/_drops", MARK_SCHEMA)


def land_drop(df: DataFrame, path: str, drop: str) -> WriteFacts:
    """SRC5: write a table as a drop, then commit it. A committed drop is never replaced; what a
    failed writer left under the name is."""
    root, spark = path.rstrip("/"), df.sparkSession
    _refuse(spark, root, drop)
    facts = observed_write(df, f"{root}/{drop}", lambda d: write_csv(d, f"{root}/{drop}"))
    n_files, n_bytes = _size(_parts(spark, f"{root}/{drop}"))
    _mark(spark, root, [(drop, facts.columns, None, n_files, n_bytes, facts.rows)])
    return facts


def commit_drop(spark: SparkSession, path: str, drop: str) -> list[str]:
    """Commit a drop that others have written, a file or a folder of files; returns its columns.

    The header of each file is taken once, here, by a read that ends after the first line. A drop may
    mix headers: it gets a line for each. A file without a header line has no columns and raises.
    """
    root = path.rstrip("/")
    _refuse(spark, root, drop)
    parts, groups = _parts(spark, f"{root}/{drop}"), {}
    for part in parts.orderBy("path").collect():
        names = spark.read.options(header="true", escape='"').csv(part.path).columns
        if not names:
            raise ValueError(f"{part.path} has no header")
        groups.setdefault(tuple(names), []).append(part)
    if not groups:
        raise FileNotFoundError(f"{root}/{drop} holds no files")
    _mark(spark, root, [
        (drop, list(names), [p.file_name for p in files] if len(groups) > 1 else None,
         len(files), sum(p.length for p in files), None) for names, files in groups.items()])
    return list(dict.fromkeys(c for names in groups for c in names))


def latest_drop(spark: SparkSession, path: str, pattern: str = "*", skip: Sequence[str] = ()) -> str:
    """SRT6: the last by name of the committed drops."""
    name = F.col("drop")
    found = committed_drops(spark, path).filter(
        name.rlike(fnmatch.translate(pattern)) & ~name.isin(*skip)).agg(F.max("drop")).first()[0]
    if found is None:
        raise FileNotFoundError(f"no committed drop {pattern} in {path}")
    return found


def read_drop(spark: SparkSession, path: str, drop: str | None = None, cols: Sequence[str] | None = None,
              multi_line: bool = False, row_order: bool = False, check: bool = True) -> DataFrame:
    """SRC1: one committed drop, the newest by default, all text, as `read_csv` gives it.

    Columns go by the headers in the ledger, so planning reads no text. With `check`, files and bytes
    are compared with the ledger first, by a listing of this drop alone; a drop that was changed
    after its commit raises. `multi_line` and `row_order` as in `read_csv`.
    """
    root = path.rstrip("/")
    wanted = drop or latest_drop(spark, root)
    marks = committed_drops(spark, root).filter(F.col("drop") == wanted).collect()
    if not marks:
        raise FileNotFoundError(f"{wanted} is not committed in {root}")
    if check:
        held, told = _size(_parts(spark, f"{root}/{wanted}")), _told(marks)
        if held != told:
            raise ValueError(f"{wanted} has {held[0]} files of {held[1]} bytes, committed were {told[0]} of {told[1]}")
    tables = [_read_marked(spark, root, m, multi_line, row_order) for m in sorted(marks, key=lambda m: m.files or [])]
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    names = list(dict.fromkeys(c for m in marks for c in m.columns))
    return normalize_table(table.select(*[col_of(c) for c in (cols or names)], *([ROW_ORDER] if row_order else [])))


def pending_drops(spark: SparkSession, path: str, state: str) -> list[str]:
    """Names, in order, of the committed drops that the reader whose folder is `state` has not taken."""
    taken = _ledger(spark, state, TAKEN_SCHEMA)
    names = committed_drops(spark, path).select("drop").distinct().join(taken, "drop", "left_anti")
    return [r.drop for r in names.orderBy("drop").collect()]


def take_drop(spark: SparkSession, state: str, drop: str) -> None:
    """Note that a drop was taken. Called after the work on it is stored, so a reader that fails
    between meets the drop again: every drop is taken at least once."""
    spark.createDataFrame([(drop,)], TAKEN_SCHEMA).coalesce(1).write.mode("append").json(state)


def _ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _mark(spark: SparkSession, root: str, lines: list[tuple]) -> None:
    spark.createDataFrame(lines, MARK_SCHEMA).coalesce(1).write.mode("append").json(f"{root}/_drops")


def _refuse(spark: SparkSession, root: str, drop: str) -> None:
    if "/" in drop or drop[:1] in ("", "_", "."):
        raise ValueError(f"not a name of a drop: {drop!r}")
    if committed_drops(spark, root).filter(F.col("drop") == drop).take(1):
        raise FileExistsError(f"{drop} is committed in {root}")


def _parts(spark: SparkSession, path: str) -> DataFrame:
    return list_files(spark, path).filter(~F.col("file_name").rlike("^[._]"))


def _size(parts: DataFrame) -> tuple[int, int]:
    row = parts.agg(F.count("length").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("b")).first()
    return row.n, row.b


def _told(marks: Sequence[Row]) -> tuple[int, int]:
    return sum(m.n_files for m in marks), sum(m.n_bytes for m in marks)


def _read_marked(spark: SparkSession, root: str, mark: Row, multi_line: bool, row_order: bool) -> DataFrame:
    place = f"{root}/{mark.drop}"
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in mark.columns)
    table = spark.read.schema(schema).options(header="true", escape='"', multiLine=str(multi_line).lower()).csv(
        [f"{place}/{f}" for f in mark.files] if mark.files else place)
    if row_order:
        table = table.withColumn(ROW_ORDER, F.struct("_metadata.file_path", "_metadata.file_block_start",
                                                     F.monotonically_increasing_id().alias("place")))
    return table
