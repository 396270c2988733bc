"""Sinks (SNK1-SNK9, SRC5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.dedup import duplicate_counts
from tablewright.operators.profile import missing_summary
from tablewright.operators.projection import column_kind, select_lenient
from tablewright.operators.quantiles import as_scalar
from tablewright.operators.sketches import column_sketches
from tablewright.operators.split import split_sizes
from tablewright.sources.facts import SPLITS, WriteFacts, observed_write
from tablewright.sources.readers import list_files


def land_snapshot(df: DataFrame, path: str, snapshot: str, sketch: Sequence[str] = ()) -> str:
    """SRC5: add a dated snapshot to a folder; an existing one is never replaced. Quantile sketches of
    the columns `sketch` are kept beside it, in a folder that scans pass over."""
    target = f"{path.rstrip('/')}/snapshot={snapshot}"
    df.write.mode("errorifexists").parquet(target)
    if sketch:
        landed = df.sparkSession.read.parquet(target)
        column_sketches(landed, sketch).write.mode("overwrite").parquet(f"{path.rstrip('/')}/_sketches/{snapshot}")
    return target


def write_csv(df: DataFrame, path: str) -> None:
    """SNK1, SNK6: CSV with header. An empty table leaves a readable, empty output."""
    df.write.mode("overwrite").options(
        header="true", escape='"', ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false").csv(path)


def write_parquet(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """SNK2: Parquet, gzip by default."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def write_splits(df: DataFrame, path: str, splits: Sequence[str] = SPLITS) -> WriteFacts:
    """SNK3: one folder per value of `split`; returns the rows and missing cells of each."""
    return observed_write(
        df, path, lambda d: d.write.mode("overwrite").partitionBy("split").parquet(path), "split", splits)


def write_feature_groups(df: DataFrame, groups: Mapping[str, Sequence[str]], path: str) -> dict[str, WriteFacts]:
    """SNK4: one CSV table per group with the columns that exist; groups without any are skipped.
    Returns what was written, by group."""
    written = {}
    for name, cols in groups.items():
        part, target = select_lenient(df, cols), f"{path.rstrip('/')}/group={name}"
        if part.columns:
            written[name] = observed_write(part, target, lambda d, to=target: write_csv(d, to))
    return written


def write_json(report: DataFrame, path: str) -> None:
    """SNK5: one JSON document per row."""
    report.write.mode("overwrite").json(path)


def write_text(df: DataFrame, path: str, column: str, partition: str | None = None) -> None:
    """SNK9, SNK10: a text column as files, one folder per partition value if asked for."""
    if partition is None:
        df.select(column).write.mode("overwrite").text(path)
    else:
        df.select(column, partition).write.mode("overwrite").partitionBy(partition).text(path)


def stored_megabytes(df: DataFrame, path: str) -> float:
    """Size of the files of a written table."""
    total = list_files(df.sparkSession, path).agg(F.sum("length").alias("b")).first().b
    return (total or 0) / 1024 / 1024


def dataset_manifest(df: DataFrame, name: str, groups: Mapping[str, Sequence[str]] | None = None,
                     files: Mapping[str, str] | None = None,
                     splits: DataFrame | None = None) -> DataFrame:
    """SNK8: one row with sizes, groups, split sizes, files, missing cells, duplicates and kinds."""
    kinds = [column_kind(f.dataType) for f in df.schema]
    rows = as_scalar(duplicate_counts(df))
    missing = as_scalar(missing_summary(df))
    big = lambda n: F.lit(n).cast("bigint")
    columns = {
        "dataset_name": F.lit(name),
        "total_records": rows.getField("total_rows"),
        "total_features": big(len(df.columns)),
        "null_values": missing.getField("missing_cells"),
        "duplicate_rows": rows.getField("surplus_rows"),
        "numeric_columns": big(kinds.count("numeric")),
        "text_columns": big(kinds.count("text")),
        "datetime_columns": big(kinds.count("datetime")),
    }
    if groups:
        columns["feature_groups"] = F.struct(*[
            F.array(*[F.lit(c) for c in cols]).alias(g) for g, cols in groups.items()])
    if files:
        columns["files"] = F.struct(*[F.lit(v).alias(k) for k, v in files.items()])
    if splits is not None:
        columns["split_sizes"] = split_sizes(splits).agg(F.map_from_entries(F.array_sort(
            F.collect_list(F.struct("split", "n")))).alias("m")).scalar()
    return df.sparkSession.range(1).select(*[c.alias(k) for k, c in columns.items()])


def stored_files(df: DataFrame, paths: Mapping[str, str]) -> dict[str, tuple[int, int]]:
    """Number and bytes of the data files under each path, from listings alone."""
    found = {}
    for name, path in paths.items():
        files = list_files(df.sparkSession, path).filter(~F.col("file_name").rlike("^[._]"))
        row = files.agg(F.count("length").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
        found[name] = (row.n, row.bytes)
    return found


def written_manifest(df: DataFrame, name: str, table: WriteFacts, groups: Mapping[str, WriteFacts],
                     splits: WriteFacts, files: Mapping[str, str]) -> DataFrame:
    """SNK8 from the facts of the writes: the columns of `dataset_manifest`, and per group, split and
    file what was written.

    `df` is the written table; it is read for one thing that a write cannot tell, its repeated rows,
    and by digest, so that no text is shuffled. `files` names the written folders, of which only
    listings are read. Groups or splits that differ from the table in rows raise.
    """
    for label, facts in (*groups.items(), ("splits", splits)):
        if facts.rows != table.rows:
            raise ValueError(f"{label}: {facts.rows} rows written, {table.rows} in the table")
    kinds = list(table.kinds.values())
    stored = stored_files(df, files)
    big = lambda n: F.lit(n).cast("bigint")
    facts_of = lambda f: [big(f.rows).alias("rows"), big(f.missing_cells).alias("missing_cells")]
    per_group = {
        "feature_groups": F.struct(*[F.array(*[F.lit(c) for c in f.columns]).alias(g) for g, f in groups.items()]),
        "group_facts": F.struct(*[F.struct(*facts_of(f)).alias(g) for g, f in groups.items()]),
    } if groups else {}
    columns = {
        "dataset_name": F.lit(name),
        "total_records": big(table.rows),
        "total_features": big(len(kinds)),
        "null_values": big(table.missing_cells),
        "duplicate_rows": as_scalar(duplicate_counts(df, digest=True)).getField("surplus_rows"),
        "numeric_columns": big(kinds.count("numeric")),
        "text_columns": big(kinds.count("text")),
        "datetime_columns": big(kinds.count("datetime")),
        **per_group,
        "files": F.struct(*[F.lit(v).alias(k) for k, v in files.items()]),
        "file_facts": F.struct(*[F.struct(big(n).alias("files"), big(b).alias("bytes")).alias(k)
                                 for k, (n, b) in stored.items()]),
        "split_sizes": F.create_map(*[x for s, n in splits.splits.items() for x in (F.lit(s), big(n))]),
        "split_facts": F.struct(*[F.struct(
            big(n).alias("rows"), big(splits.split_missing[s]).alias("missing_cells"),
            F.lit(100.0 * n / splits.rows if splits.rows else None).cast("double").alias("percentage")).alias(s)
            for s, n in splits.splits.items()]),
    }
    return df.sparkSession.range(1).select(*[c.alias(k) for k, c in columns.items()])


def dataset_summary(manifest: DataFrame) -> DataFrame:
    """SNK9: the manifest's figures as a short Markdown text in column `text`."""
    def line(label: str, column: str):
        return F.concat(F.lit(f"- {label}: "), F.format_number(column, 0))

    return manifest.select(F.concat_ws(
        "\n", F.concat(F.lit("# "), F.col("dataset_name")), F.lit(""),
        line("Records", "total_records"), line("Features", "total_features"),
        line("Missing cells", "null_values"), line("Duplicate rows", "duplicate_rows"),
    ).alias("text"))
