"""Queries that write tables and read them back."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.cleaning import parse_iso_date, to_number
from tablewright.operators import quality
from tablewright.operators.split import hash_split
from tablewright.plans.pipeline import STEPS, PipelineConfig, check_artifacts, run_pipeline
from tablewright.queries.base import query, rounded, table
from tablewright.queries.features import AS_OF, FINAL_SQL, raw_catalogue
from tablewright.queries.modelling import QUERY_SIZES
from tablewright.queries.profiling import EVENT_CONFIG, RANGE_SQL, RULES
from tablewright.session import scratch_path
from tablewright.sources import drops, readers, writers
from tablewright.sources.facts import observed_write


@query("snapshot_roundtrip", "SELECT * FROM orders")
def snapshot_roundtrip(spark, sf):
    path = scratch_path(spark, "orders")
    orders = table(spark, sf, "orders")
    writers.land_snapshot(orders.filter("o_orderstatus = 'F'"), path, "20240101_000000")
    writers.land_snapshot(orders, path, "20240102_000000")
    return readers.read_snapshot(spark, path)


@query("csv_roundtrip", """
    SELECT p_partkey, p_name || ', "' || p_brand || '"' || chr(10) || p_type AS label,
        CASE WHEN p_partkey % 7 > 0 THEN p_type END AS kind, p_retailprice FROM part""")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "parts")
    label = F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"\n'), "p_type")
    kind = F.when(F.col("p_partkey") % 7 > 0, F.col("p_type")).otherwise("n/a")
    writers.write_csv(table(spark, sf, "part").select(
        "p_partkey", label.alias("label"), kind.alias("kind"), "p_retailprice"), path)
    back = readers.read_csv(spark, path)
    return back.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "label", "kind",
                       to_number("p_retailprice").alias("p_retailprice"))


@query("latest_csv", "SELECT o_orderkey, o_orderdate::DATE AS day FROM orders WHERE o_orderstatus = 'O'")
def latest_csv(spark, sf):
    path = scratch_path(spark, "drops")
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    orders = table(spark, sf, "orders").select("o_orderkey", day, "o_orderstatus")
    for drop, status in (("drop_1.csv", "F"), ("drop_2.csv", "O"), ("drop_old.csv", "P"), ("other", "P")):
        writers.write_csv(orders.filter(F.col("o_orderstatus") == status), f"{path}/{drop}")
    back = readers.read_latest_csv(spark, path, "drop_*.csv", ["drop_old.csv"], multi_line=False)
    return back.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                       parse_iso_date("day").alias("day"))


@query("committed_drops", """
    SELECT o_orderkey, o_orderstatus, o_orderpriority, 'F' AS "drop", 2 AS pending FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, o_orderstatus, NULL, 'O', 2 FROM orders WHERE o_orderstatus = 'O'""")
def committed_drops(spark, sf):
    """Drops by status with headers of their own: F and O are committed, P is only half there, N was
    taken before. All that a reader has not taken, with the number of such drops."""
    path, state = scratch_path(spark, "landing"), scratch_path(spark, "reader")
    orders = table(spark, sf, "orders")
    drops.land_drop(orders.filter("o_orderstatus = 'N'").select("o_orderkey"), path, "N")
    drops.take_drop(spark, state, "N")
    drops.land_drop(orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus", "o_orderpriority"), path, "F")
    writers.write_csv(orders.filter("o_orderstatus = 'O'").select("o_orderstatus", "o_orderkey"), f"{path}/O")
    drops.commit_drop(spark, path, "O")
    writers.write_csv(orders.filter("o_orderstatus = 'P'"), f"{path}/P")
    waiting = drops.pending_drops(spark, path, state)
    parts = [drops.read_drop(spark, path, name).withColumn("drop", F.lit(name)) for name in waiting]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderstatus", "o_orderpriority", "drop",
        F.lit(len(waiting)).alias("pending"))


@query("parquet_roundtrip", "SELECT * FROM lineitem")
def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "lines")
    writers.write_parquet(table(spark, sf, "lineitem"), path)
    return readers.read_stage(spark, path)


_HASH = "('0x' || substr(md5('42:' || o_orderkey), 1, 15))::BIGINT / 1152921504606846976.0::DOUBLE"


_SPLIT = f"""CASE WHEN {_HASH} < 0.7 THEN 'train'
    WHEN {_HASH} < 0.7::DOUBLE + 0.15::DOUBLE THEN 'val' ELSE 'test' END"""


@query("split_sink", f"SELECT o_orderkey, o_totalprice, {_SPLIT} AS split FROM orders")
def split_sink(spark, sf):
    """All three parts, each under the name it was read by."""
    path = scratch_path(spark, "splits")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    writers.write_splits(hash_split(orders, ["o_orderkey"]), path)
    parts = [part.withColumn("split", F.lit(name)) for name, part in readers.read_splits(spark, path).items()]
    return reduce(DataFrame.unionByName, parts)


GROUPS = {"ids": ["o_orderkey", "o_orderstatus"], "money": ["o_totalprice", "tax"], "none": ["tax"]}


@query("feature_groups", """
    SELECT 'ids' AS "group", 2 AS n_columns, o_orderkey, o_orderstatus, NULL::DOUBLE AS o_totalprice FROM orders
    UNION ALL SELECT 'money', 1, NULL, NULL, o_totalprice FROM orders""")
def feature_groups(spark, sf):
    """All rows of every group that was written, with the number of its columns."""
    path = scratch_path(spark, "groups")
    written = writers.write_feature_groups(table(spark, sf, "orders"), GROUPS, path)
    parts = []
    for name in written:
        back = readers.read_csv(spark, f"{path}/group={name}", multi_line=False)
        cell = lambda c, kind: F.col(c).cast(kind) if c in back.columns else F.lit(None).cast(kind)  # noqa: E731, B023
        parts.append(back.select(
            F.lit(name).alias("group"), F.lit(len(back.columns)).alias("n_columns"),
            cell("o_orderkey", "bigint").alias("o_orderkey"), cell("o_orderstatus", "string").alias("o_orderstatus"),
            cell("o_totalprice", "double").alias("o_totalprice")))
    return reduce(DataFrame.unionByName, parts)


@query("json_report", RANGE_SQL)
def json_report(spark, sf):
    path = scratch_path(spark, "report")
    checks = quality.range_check(table(spark, sf, "lineitem"), RULES)
    writers.write_json(checks, path)
    return spark.read.schema(checks.schema).json(path).select(*checks.columns)


@query("report_documents")
def report_documents(spark, sf):
    config = quality.ValidationConfig(**EVENT_CONFIG)
    return quality.report_documents(quality.validation_report(table(spark, sf, "events"), config))


@query("manifest", """
    SELECT 'orders' AS dataset_name, count(*) AS total_records, 6::BIGINT AS total_features,
        0::BIGINT AS null_values,
        (SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM orders GROUP BY ALL
            o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority))::BIGINT
            AS duplicate_rows,
        3::BIGINT AS numeric_columns, 2::BIGINT AS text_columns, 1::BIGINT AS datetime_columns
    FROM orders""".replace("GROUP BY ALL\n           ", "GROUP BY"))
def manifest(spark, sf):
    return writers.dataset_manifest(table(spark, sf, "orders"), "orders")


_PARTS = f"""SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS o_totalprice, {_SPLIT} AS split FROM orders"""


@query("written_manifest", f"""
    WITH t AS ({_PARTS}), s AS (SELECT split, count(*) AS n,
        count(*) FILTER (WHERE o_orderstatus IS NULL) + count(*) FILTER (WHERE o_totalprice IS NULL) AS gaps
        FROM t GROUP BY split)
    SELECT 'orders' AS dataset_name, count(*) AS total_records, 3::BIGINT AS total_features,
        (SELECT sum(gaps) FROM s)::BIGINT AS null_values,
        (SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM t
            GROUP BY o_orderkey, o_orderstatus, o_totalprice))::BIGINT AS duplicate_rows,
        2::BIGINT AS numeric_columns, 1::BIGINT AS text_columns, 0::BIGINT AS datetime_columns,
        'ids: o_orderkey, o_orderstatus, ' || count(*) || ' rows, '
            || count(*) FILTER (WHERE o_orderstatus IS NULL) || ' missing; money: o_totalprice, '
            || count(*) || ' rows, ' || count(*) FILTER (WHERE o_totalprice IS NULL) || ' missing' AS "groups",
        (SELECT string_agg(split || ': ' || n || ' rows, ' || gaps || ' missing', '; ' ORDER BY split) FROM s) AS splits,
        'table, splits' AS files, true AS files_hold_data FROM t""")
def written_manifest(spark, sf):
    """A table, its groups and its splits written, and the manifest from what the writes counted."""
    path = scratch_path(spark, "dataset")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice")).alias("o_totalprice"))
    facts = observed_write(orders, f"{path}/table", lambda d: writers.write_parquet(d, f"{path}/table"))
    stored = readers.read_stage(spark, f"{path}/table")
    groups = writers.write_feature_groups(stored, GROUPS, f"{path}/groups")
    splits = writers.write_splits(hash_split(stored, ["o_orderkey"]), f"{path}/splits")
    made = writers.written_manifest(stored, "orders", facts, groups, splits,
                                    {"table": f"{path}/table", "splits": f"{path}/splits"})

    as_groups = [F.concat(F.lit(f"{g}: "), F.array_join(f"feature_groups.{g}", ", "), F.lit(", "),
                          F.col(f"group_facts.{g}.rows"), F.lit(" rows, "),
                          F.col(f"group_facts.{g}.missing_cells"), F.lit(" missing")) for g in groups]
    as_splits = [F.concat(F.lit(f"{s}: "), F.element_at("split_sizes", s), F.lit(" rows, "),
                          F.col(f"split_facts.{s}.missing_cells"), F.lit(" missing")) for s in sorted(splits.splits)]
    names = made.schema["file_facts"].dataType.names
    whole = [F.col(f"file_facts.{n}.files") * F.col(f"file_facts.{n}.bytes") > 0 for n in names]
    return made.select(
        "dataset_name", "total_records", "total_features", "null_values", "duplicate_rows", "numeric_columns",
        "text_columns", "datetime_columns", F.concat_ws("; ", *as_groups).alias("groups"),
        F.concat_ws("; ", *as_splits).alias("splits"), F.lit(", ".join(names)).alias("files"),
        reduce(and_, whole).alias("files_hold_data"))


@query("dataset_summary", r"""
    SELECT '# orders' || chr(10) || chr(10) || '- Records: ' || format('{:,}', count(*)) || chr(10)
        || '- Features: 6' || chr(10) || '- Missing cells: 0' || chr(10) || '- Duplicate rows: 0' AS text
    FROM orders""")
def dataset_summary(spark, sf):
    return writers.dataset_summary(writers.dataset_manifest(table(spark, sf, "orders"), "orders"))


@query("artifact_check", """
    SELECT 'regions' AS artifact, count(*) > 0 AS "exists" FROM region
    UNION ALL SELECT 'nations', count(*) > 0 FROM nation UNION ALL SELECT 'absent', false""")
def artifact_check(spark, sf):
    path = scratch_path(spark, "outputs")
    writers.write_parquet(table(spark, sf, "region"), f"{path}/regions")
    writers.write_csv(table(spark, sf, "nation"), f"{path}/nations")
    return check_artifacts(spark, path, ["regions", "nations", "absent"])


def _full_run(spark, sf, steps):
    """Raw text files, in the order of `ord`, through the given steps."""
    root = scratch_path(spark, "run")
    raw = raw_catalogue(spark, sf).orderBy("ord").drop("ord")
    writers.write_csv(raw, f"{root}/raw/games_20240101_000000.csv")
    cfg = PipelineConfig(f"{root}/raw", f"{root}/out", AS_OF, sizes=QUERY_SIZES)
    return cfg, run_pipeline(spark, cfg, steps)


@query("full_run_final", FINAL_SQL)
def full_run_final(spark, sf):
    cfg, status = _full_run(spark, sf, {s: STEPS[s] for s in STEPS if s not in ("train", "evaluate")})
    failed = status.filter("status <> 'ok'").first()
    if failed:
        raise RuntimeError(f"{failed.step}: {failed.message}")
    return rounded(readers.read_stage(spark, cfg.path("final")))


@query("full_run_status")
def full_run_status(spark, sf):
    cfg, status = _full_run(spark, sf, STEPS)
    outputs = check_artifacts(spark, cfg.out_dir).select(
        F.concat(F.lit("output "), "artifact").alias("step"),
        F.when(F.col("exists"), "ok").otherwise("missing").alias("status"))
    return status.select("step", "status", "message").unionByName(outputs, allowMissingColumns=True)
