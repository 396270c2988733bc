"""Queries for profiles, outliers, correlation, histograms and quality."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tablewright.operators import correlation, outliers, profile, quality, sketches
from tablewright.operators.dedup import duplicate_counts
from tablewright.operators.models import best_row
from tablewright.operators.quantiles import quantile_sql, sql_text
from tablewright.queries.base import query, rounded, rounded_sql, table, union_sql
from tablewright.session import scratch_path, staged
from tablewright.sources import readers, writers

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LABELLED = """SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
LABELLED_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


def labelled(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").select(
        *LABELLED_COLUMNS)


@query("table_shape", """
    SELECT count(*) AS n_rows, 6::BIGINT AS n_columns, 3::BIGINT AS n_numeric, 2::BIGINT AS n_text,
        1::BIGINT AS n_datetime, 0::BIGINT AS n_boolean FROM orders""")
def table_shape(spark, sf):
    orders = table(spark, sf, "orders")
    kinds = {r.kind: r.n_columns for r in profile.kind_counts(orders).collect()}
    return profile.shape(orders).withColumns({f"n_{k}": F.lit(v).cast("bigint") for k, v in kinds.items()})


_MISSING = union_sql([
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, "
    f"(count(*) - count({c})) * 100.0::DOUBLE / count(*) AS missing_pct FROM ({LABELLED})"
    for c in LABELLED_COLUMNS])


@query("missing_profile", rounded_sql(_MISSING, ["missing_pct"]))
def missing_profile(spark, sf):
    return rounded(profile.missing_by_column(labelled(spark, sf)))


@query("missing_summary", rounded_sql(f"""
    SELECT sum(missing_count)::BIGINT AS missing_cells,
        count(*) FILTER (WHERE missing_count > 0) AS columns_affected,
        sum(missing_pct) / 7 AS missing_cell_pct FROM ({_MISSING})""", ["missing_cell_pct"]))
def missing_summary(spark, sf):
    return rounded(profile.missing_summary(labelled(spark, sf)))


@query("post_clean_check", f"""
    SELECT "column", missing_count, (SELECT count(*) - count(DISTINCT doc_id) FROM documents)
        AS key_duplicates FROM ({_MISSING}) WHERE missing_count > 0""")
def post_clean_check(spark, sf):
    df = labelled(spark, sf)
    dup = duplicate_counts(df, ["doc_id"]).select("surplus_rows").scalar()
    return profile.missing_by_column(df, only_affected=True).select(
        "column", "missing_count", dup.alias("key_duplicates"))


_ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
                "o_totalprice": "double", "o_orderdate": "timestamp_ntz",
                "o_orderpriority": "string"}


def _profile_sql(c: str) -> str:
    kind = _ORDER_TYPES.get(c)
    if kind is None:
        return f"""SELECT '{c}' AS "column", false AS "exists", NULL::VARCHAR AS data_type,
            NULL::BIGINT AS missing_count, NULL::DOUBLE AS missing_pct,
            NULL::DOUBLE AS sample_mean, NULL::VARCHAR AS sample_text"""
    mean = f"avg({c})" if kind in ("bigint", "double") else "NULL::DOUBLE"
    text = "NULL::VARCHAR" if kind in ("bigint", "double") else (
        f"strftime(arg_min({c}, o_orderkey), '%Y-%m-%d %H:%M:%S')" if "time" in kind
        else f"arg_min({c}, o_orderkey)")
    return f"""SELECT '{c}' AS "column", true AS "exists", '{kind}' AS data_type,
        count(*) - count({c}) AS missing_count,
        (count(*) - count({c})) * 100.0::DOUBLE / count(*) AS missing_pct,
        {mean} AS sample_mean, {text} AS sample_text FROM orders"""


@query("column_profile", rounded_sql(union_sql(
    [_profile_sql(c) for c in [*_ORDER_TYPES, "o_comment"]]), ["missing_pct", "sample_mean"]))
def column_profile(spark, sf):
    return rounded(profile.column_profile(table(spark, sf, "orders"),
                                          [*_ORDER_TYPES, "o_comment"], ["o_orderkey"]))


@query("column_documentation", union_sql([
    f"""SELECT '{c}' AS column_name, '{t}' AS data_type,
        '{'Unique id' if c == 'p_partkey' else ''}' AS description,
        count(*) - count({c}) AS missing_count, count(DISTINCT {c}) AS unique_values FROM part"""
    for c, t in [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"),
                 ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")]]))
def column_documentation(spark, sf):
    return profile.describe_columns(table(spark, sf, "part"), {"p_partkey": "Unique id"})


@query("numeric_describe", rounded_sql(union_sql([
    f"""SELECT '{c}' AS "column", count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std,
        min({c}) AS min, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50,
        quantile_cont({c}, 0.75) AS q75, max({c}) AS max FROM lineitem""" for c in MEASURES]),
    ["mean", "std", "min", "q25", "q50", "q75", "max"]))
def numeric_describe(spark, sf):
    return rounded(profile.numeric_describe(table(spark, sf, "lineitem"), MEASURES))


@query("exact_quantiles", rounded_sql(union_sql([
    f"""SELECT '{c}' AS "column", quantile_cont({c}, 0.1) AS q10, quantile_cont({c}, 0.5) AS q50,
        quantile_cont({c}, 0.99) AS q99 FROM lineitem"""
    for c in MEASURES]), ["q10", "q50", "q99"]))
def exact_quantiles(spark, sf):
    lines = table(spark, sf, "lineitem")
    q = quantile_sql(lines, MEASURES, [0.1, 0.5, 0.99])
    rows = [profile.row_sql(column=sql_text(c), q10=f"{q[c]}[0]", q50=f"{q[c]}[1]", q99=f"{q[c]}[2]")
            for c in MEASURES]
    return rounded(profile.long_rows(spark.range(1), rows))


@query("value_range", """
    SELECT min(l_shipdate) AS min_value, max(l_shipdate) AS max_value FROM lineitem""")
def value_range(spark, sf):
    return profile.value_range(table(spark, sf, "lineitem"), "l_shipdate")


_SUMMARY = [
    ("user_id", "unique", "count(DISTINCT user_id)"),
    ("user_id", "duplicates", "count(*) - count(DISTINCT user_id)"),
    ("value", "missing", "count(*) - count(value)"),
    ("value", "zero", "count(*) FILTER (WHERE value = 0)"),
    ("value", "min", "min(value)"), ("value", "max", "max(value)"),
    ("value", "mean", "avg(value)"), ("value", "median", "median(value)"),
    ("bought", "present", "count(bought)"),
    ("bought", "present_pct", "count(bought) * 100.0::DOUBLE / count(*)"),
    ("k", "missing", "count(*) - count(k)"), ("k", "mean", "avg(try_cast(k AS DOUBLE))"),
    ("props", "missing", "count(*) - count(props)"),
]


@query("targeted_summary", rounded_sql(union_sql([
    f"""SELECT '{c}' AS "column", '{m}' AS metric, ({e})::DOUBLE AS value FROM (
        SELECT *, CASE WHEN event_type = 'purchase' THEN 'yes' END AS bought,
            json_extract_string(props, '$.k') AS k FROM events)""" for c, m, e in _SUMMARY]),
    ["value"]))
def targeted_summary(spark, sf):
    events = table(spark, sf, "events").withColumns({
        "bought": F.when(F.col("event_type") == "purchase", "yes"),
        "k": F.get_json_object("props", "$.k")})
    return rounded(profile.targeted_summary(events, "user_id", "value", ["bought"], ["k"], ["props"]))


@query("observed_flags", rounded_sql("""
    SELECT count(*) AS n_rows, count(*) FILTER (WHERE l_discount > 0.05) AS sum_discounted,
        avg(l_quantity) AS mean_l_quantity FROM lineitem""", ["mean_l_quantity"]))
def observed_flags(spark, sf):
    """The figures ride on the job that runs the rows; a count stands for it here."""
    lines = table(spark, sf, "lineitem").withColumn(
        "discounted", (F.col("l_discount") > 0.05).cast("int"))
    watched, seen = profile.observe_flags(lines, "flags", ["discounted"], ["l_quantity"])
    watched.select("l_quantity").write.format("noop").mode("overwrite").save()
    got = seen.get
    return rounded(spark.createDataFrame(
        [(got["n_rows"], got["sum_discounted"], got["mean_l_quantity"])],
        "n_rows bigint, sum_discounted bigint, mean_l_quantity double"))


@query("drop_missing", """
    SELECT d.doc_id, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id
    WHERE l.quality IS NOT NULL""")
def drop_missing(spark, sf):
    return profile.drop_missing(labelled(spark, sf), "quality")[0].select("doc_id", "quality")


def _moment_sql(c: str, source: str) -> str:
    return f"""SELECT '{c}' AS "column", avg({c}) AS mean, median({c}) AS median,
        stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max, skewness({c}) AS skewness,
        kurtosis({c}) AS kurtosis, abs(skewness({c})) > 2 AS high_skew FROM {source}"""


_MOMENTS = ["mean", "median", "std", "min", "max", "skewness", "kurtosis"]


@query("distribution_moments", rounded_sql(union_sql(
    [_moment_sql(c, "lineitem") for c in MEASURES]
    + [_moment_sql("value", "events"), _moment_sql("n_chars::DOUBLE", "documents")]
).replace("'n_chars::DOUBLE'", "'n_chars'"), _MOMENTS, 5))
def distribution_moments(spark, sf):
    parts = [profile.distribution_moments(table(spark, sf, t), cols) for t, cols in
             (("lineitem", MEASURES), ("events", ["value"]), ("documents", ["n_chars"]))]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), 5)


def _counts_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", {c} AS category, count(*) AS n,
        count(*) * 100.0::DOUBLE / (SELECT count({c}) FROM orders) AS percentage
        FROM orders WHERE {c} IS NOT NULL GROUP BY {c}"""


_CATEGORIES = ["o_orderpriority", "o_orderstatus"]


@query("value_counts", rounded_sql(union_sql([_counts_sql(c) for c in _CATEGORIES]), ["percentage"]))
def value_counts(spark, sf):
    return rounded(profile.value_counts(table(spark, sf, "orders"), _CATEGORIES))


@query("category_totals", f"""
    SELECT "column", count(*) AS unique_values, sum(n)::BIGINT AS total
    FROM ({union_sql([_counts_sql(c) for c in _CATEGORIES])}) GROUP BY "column" """)
def category_totals(spark, sf):
    return profile.category_totals(table(spark, sf, "orders"), _CATEGORIES)


def fence_sql(c: str, source: str, k: float = 1.5) -> str:
    """Quartiles and fences of one column; joined to the rows below as a one-row table."""
    return f"""SELECT q1, md, q3, q1 - {k} * (q3 - q1) AS lo, q3 + {k} * (q3 - q1) AS hi FROM (
        SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS md,
            quantile_cont({c}, 0.75) AS q3 FROM {source})"""


def outlier_sql(c: str, source: str, k: float = 1.5) -> str:
    return f"""SELECT '{c}' AS "column",
        count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS outlier_count,
        count(*) FILTER (WHERE {c} < lo OR {c} > hi) * 100.0::DOUBLE / count(*) AS outlier_pct,
        any_value(lo) AS lower_bound, any_value(hi) AS upper_bound
        FROM {source}, ({fence_sql(c, source, k)}) f
        HAVING count(*) FILTER (WHERE {c} < lo OR {c} > hi) > 0"""


_BOUNDS = ["lower_bound", "upper_bound"]


_SKETCHED = [(c, p) for c in ("value", "user_id") for p in (0.05, 0.5, 0.9)]


@query("snapshot_quantiles", rounded_sql(union_sql([
    f"SELECT '{c}' AS \"column\", {p}::DOUBLE AS share, quantile_cont({c}, {p}) AS value FROM events"
    for c, p in _SKETCHED]), ["value"]))
def snapshot_quantiles(spark, sf):
    """Exact quantiles over two landed snapshots, started from the sketches kept with each."""
    events, path = table(spark, sf, "events"), scratch_path(spark, "landed")
    for i in range(2):
        writers.land_snapshot(events.where(F.pmod("event_id", F.lit(2)) == i), path, f"2024010{i + 1}",
                              sketch=["value", "user_id"])
    kept = staged(readers.read_sketches(spark, path, ["20240101", "20240102"]), "sketches")
    found = sketches.quantiles_from(spark.read.parquet(path), kept, {c: [0.05, 0.5, 0.9] for c in ("value", "user_id")})
    rows = [(c, p, found[c, p]) for c, p in _SKETCHED]
    return rounded(spark.createDataFrame(rows, "column string, share double, value double"))


@query("iqr_outliers", rounded_sql(union_sql(
    [outlier_sql("value", "events"), outlier_sql("user_id", "events")]), ["outlier_pct", *_BOUNDS]))
def iqr_outliers(spark, sf):
    return rounded(outliers.iqr_outliers(table(spark, sf, "events"), exclude=["event_id"]))


@query("iqr_outliers_none", rounded_sql(union_sql(
    [outlier_sql(c, "lineitem") for c in MEASURES]), ["outlier_pct", *_BOUNDS]))
def iqr_outliers_none(spark, sf):
    return rounded(outliers.iqr_outliers(table(spark, sf, "lineitem"), MEASURES))


@query("iqr_outliers_pct", f"""
    SELECT "column", outlier_count, printf('%.2f%%', outlier_pct) AS outlier_pct,
        round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound
    FROM ({outlier_sql('n_chars', 'documents', 2.0)})""")
def iqr_outliers_pct(spark, sf):
    return rounded(outliers.iqr_outliers_text(table(spark, sf, "documents"), k=2.0,
                                              exclude=["doc_id"]))


@query("outlier_rows", f"""
    SELECT doc_id, n_chars FROM documents, ({fence_sql('n_chars', 'documents')}) f
    WHERE n_chars < lo OR n_chars > hi""")
def outlier_rows(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return outliers.outlier_rows(docs, "n_chars")


def _box_sql(c: str, source: str) -> str:
    return f"""SELECT '{c}' AS "column", any_value(q1) AS q1, any_value(md) AS median,
        any_value(q3) AS q3, min({c}) FILTER (WHERE {c} >= lo AND {c} <= hi)::DOUBLE AS whisker_low,
        max({c}) FILTER (WHERE {c} >= lo AND {c} <= hi)::DOUBLE AS whisker_high,
        count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS outlier_count
        FROM {source}, ({fence_sql(c, source)}) f"""


@query("boxplot_stats", rounded_sql(union_sql(
    [_box_sql("value", "events"), _box_sql("user_id", "events")]),
    ["q1", "median", "q3", "whisker_low", "whisker_high"]))
def boxplot_stats(spark, sf):
    return rounded(outliers.boxplot_stats(table(spark, sf, "events"), ["value", "user_id"]))


CORR_COLUMNS = [*MEASURES, "net", "ship_charge"]
CORR_SOURCE = """(SELECT l_quantity, l_extendedprice, l_discount, l_tax,
    l_extendedprice * (1 - l_discount) AS net, l_extendedprice * l_tax AS ship_charge FROM lineitem)"""
PAIR_SQL = union_sql([
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS corr FROM {CORR_SOURCE}"
    for a, b in combinations(CORR_COLUMNS, 2)])


def charged(spark, sf):
    return table(spark, sf, "lineitem").select(
        *MEASURES, (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("ship_charge"))


@query("corr_pairs", rounded_sql(PAIR_SQL, ["corr"]))
def corr_pairs(spark, sf):
    return rounded(correlation.correlation_pairs(charged(spark, sf)))


@query("corr_matrix", rounded_sql(f"""
    SELECT col_a, col_b, corr FROM ({PAIR_SQL})
    UNION ALL SELECT col_b, col_a, corr FROM ({PAIR_SQL})
    UNION ALL SELECT c, c, 1.0::DOUBLE FROM unnest({CORR_COLUMNS}) t(c)""", ["corr"]))
def corr_matrix(spark, sf):
    return rounded(correlation.correlation_matrix(charged(spark, sf)))


@query("corr_with_missing", rounded_sql("""
    SELECT 'discount' AS col_a, 'tax' AS col_b, corr(nullif(l_discount, 0), nullif(l_tax, 0)) AS corr
    FROM lineitem""", ["corr"]))
def corr_with_missing(spark, sf):
    gaps = table(spark, sf, "lineitem").select(
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("tax"), F.lit(1.0).alias("constant"))
    return rounded(correlation.correlation_pairs(gaps))


@query("corr_significant", rounded_sql(f"""
    SELECT col_a, col_b, corr, abs(corr) AS abs_corr FROM ({PAIR_SQL}) WHERE abs(corr) >= 0.6""",
    ["corr", "abs_corr"]))
def corr_significant(spark, sf):
    return rounded(correlation.significant_pairs(charged(spark, sf), threshold=0.6))


def _histogram_sql(c: str, source: str, bins: int = 30) -> str:
    return f"""
    SELECT '{c}' AS "column", b.bin::INTEGER AS bin, any_value(low + b.bin * w) AS bin_start,
        any_value(low + (b.bin + 1) * w) AS bin_end, count(x) AS n
    FROM (SELECT min({c}) AS low, (max({c}) - min({c})) / {bins}.0::DOUBLE AS w FROM {source}) f
    CROSS JOIN range({bins}) b(bin)
    LEFT JOIN (SELECT x, CASE WHEN x < low + g * w THEN g - 1
            WHEN g < {bins} - 1 AND x >= low + (g + 1) * w THEN g + 1 ELSE g END AS bin
        FROM (SELECT {c} AS x, low, w, least(floor(({c} - low) / w), {bins} - 1)::INTEGER AS g
            FROM {source}, (SELECT min({c}) AS low, (max({c}) - min({c})) / {bins}.0::DOUBLE AS w
                FROM {source}))) r ON r.bin = b.bin
    GROUP BY b.bin"""


@query("histogram", rounded_sql(union_sql(
    [_histogram_sql(c, "lineitem") for c in ("l_extendedprice", "l_quantity")]),
    ["bin_start", "bin_end"]))
def histogram(spark, sf):
    return rounded(profile.histogram(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"]))


@query("corr_histogram", rounded_sql(_histogram_sql("corr", f"({PAIR_SQL})"),
                                     ["bin_start", "bin_end"], 5))
def corr_histogram(spark, sf):
    pairs = staged(correlation.correlation_pairs(charged(spark, sf)), "pairs")
    return rounded(profile.histogram(pairs, ["corr"]), 5)


@query("density")
def density(spark, sf):
    return profile.density(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"])


RULES = [quality.RangeRule("l_quantity", 0), quality.RangeRule("l_discount", 0, 0.05)]
RANGE_SQL = """
    SELECT 'l_quantity' AS "column", 'l_quantity >= 0' AS "check",
        count(*) FILTER (WHERE l_quantity < 0) AS invalid_count, min(l_quantity) AS min,
        max(l_quantity) AS max FROM lineitem
    UNION ALL SELECT 'l_discount', '0 <= l_discount <= 0.05',
        count(*) FILTER (WHERE l_discount < 0 OR l_discount > 0.05), min(l_discount),
        max(l_discount) FROM lineitem"""


@query("range_check", RANGE_SQL)
def range_check(spark, sf):
    return quality.range_check(table(spark, sf, "lineitem"), RULES)


EVENT_CONFIG = dict(key=["user_id"], rules=[quality.RangeRule("value", 1, 100)],
                    exclude=["event_id"], moments=["value"], categories=["event_type"])


def _score_sql(penalty: str) -> str:
    return f"""
    WITH f AS (SELECT 0.0::DOUBLE AS missing_pct,
        (SELECT count(*) - count(DISTINCT user_id) FROM events) AS dups,
        (SELECT coalesce(sum(outlier_pct), 0) FROM (
            {union_sql([outlier_sql('value', 'events'), outlier_sql('user_id', 'events')])}))
            AS outlier_pct,
        {penalty} AS term),
    p AS (SELECT *, least(10.0::DOUBLE, missing_pct) AS missing_penalty,
        CASE WHEN dups > 0 THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END AS duplicate_penalty,
        least(10.0::DOUBLE, outlier_pct / 10) AS outlier_penalty,
        least(5.0::DOUBLE, term::DOUBLE) AS range_penalty FROM f)
    SELECT greatest(0.0::DOUBLE, 100 - missing_penalty - duplicate_penalty - outlier_penalty
        - range_penalty) AS score, 100.0::DOUBLE AS max_score, * EXCLUDE (dups, outlier_pct, term, missing_pct),
        concat_ws('; ', CASE WHEN missing_pct > 0 THEN 'missing values: ' || printf('%.1f', missing_pct) || '%' END,
            CASE WHEN dups > 0 THEN 'duplicate keys' END,
            CASE WHEN outlier_pct > 0 THEN 'outliers: ' || printf('%.1f', outlier_pct) || '%' END,
            CASE WHEN term > 0 THEN 'range checks: ' || term END) AS issues FROM p"""


_PENALTIES = ["score", "max_score", "missing_penalty", "duplicate_penalty", "outlier_penalty",
              "range_penalty"]


@query("quality_score", rounded_sql(_score_sql("1"), _PENALTIES))
def quality_score(spark, sf):
    config = quality.ValidationConfig(**EVENT_CONFIG)
    return rounded(quality.quality_score(table(spark, sf, "events"), config).withColumn(
        "issues", F.concat_ws("; ", "issues")))


@query("quality_score_violations", rounded_sql(_score_sql(
    "(SELECT count(*) FROM events WHERE value < 1 OR value > 100)"), _PENALTIES))
def quality_score_violations(spark, sf):
    config = quality.ValidationConfig(**EVENT_CONFIG, range_penalty="violations")
    return rounded(quality.quality_score(table(spark, sf, "events"), config).withColumn(
        "issues", F.concat_ws("; ", "issues")))


def _tidy_sql(check: str, source: str, column: str, metrics: list[str]) -> str:
    return union_sql([
        f"""SELECT '{check}' AS "check", {column} AS "column", '{m}' AS metric,
            "{m}"::DOUBLE AS value FROM ({source})""" for m in metrics])


_EVENT_COUNTS = """SELECT 'event_type=' || event_type AS label, count(*) AS n,
    count(*) * 100.0::DOUBLE / (SELECT count(*) FROM events) AS percentage FROM events GROUP BY event_type"""


@query("validation_report", rounded_sql(union_sql([
    _tidy_sql("missing", "SELECT 0 AS missing_cells, 0 AS columns_affected, 0 AS missing_cell_pct",
              "'*'", ["missing_cells", "columns_affected", "missing_cell_pct"]),
    _tidy_sql("key_duplicates",
              "SELECT count(*) - count(DISTINCT user_id) AS surplus_rows FROM events", "'*'",
              ["surplus_rows"]),
    _tidy_sql("row_duplicates", """SELECT coalesce(sum(n) FILTER (WHERE n > 1), 0) AS member_rows
        FROM (SELECT count(*) AS n FROM events GROUP BY event_id, ts, user_id, event_type, value,
            props)""", "'*'", ["member_rows"]),
    _tidy_sql("types", "SELECT * FROM (VALUES ('numeric', 3), ('text', 2), ('datetime', 1), "
              "('boolean', 0)) t(kind, n_columns)", "kind", ["n_columns"]),
    _tidy_sql("outliers", union_sql([outlier_sql("value", "events"),
                                     outlier_sql("user_id", "events")]), '"column"',
              ["outlier_count", "outlier_pct", "lower_bound", "upper_bound"]),
    _tidy_sql("range", """SELECT count(*) FILTER (WHERE value < 1 OR value > 100) AS invalid_count,
        min(value) AS min, max(value) AS max FROM events""", "'value'",
              ["invalid_count", "min", "max"]),
    _tidy_sql("quality", _score_sql("1"), "'*'", ["score", "max_score"]),
    _tidy_sql("distribution", _moment_sql("value", "events"), '"column"', _MOMENTS),
    _tidy_sql("categories", "SELECT count(DISTINCT event_type) AS unique_values, "
              "count(event_type) AS total FROM events", "'event_type'", ["unique_values", "total"]),
    _tidy_sql("coverage", _EVENT_COUNTS, "label", ["n", "percentage"]),
]), ["value"], 5))
def validation_report(spark, sf):
    config = quality.ValidationConfig(**EVENT_CONFIG)
    return rounded(quality.validation_report(table(spark, sf, "events"), config), 5)


@query("topk_missing", f"""
    SELECT "column", missing_count, missing_pct FROM ({_MISSING})
    ORDER BY missing_count DESC, "column" LIMIT 5""")
def topk_missing(spark, sf):
    return profile.missing_by_column(labelled(spark, sf)).orderBy(
        F.desc("missing_count"), "column").limit(5)


@query("topk_parts", """
    SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 15""")
def topk_parts(spark, sf):
    return profile.top_rows(table(spark, sf, "part").select("p_partkey", "p_retailprice"), ["p_retailprice"], 15,
                            ["p_partkey"])


@query("argmax", """
    SELECT o_orderpriority AS best, total FROM (
        SELECT o_orderpriority, round(avg(o_totalprice), 4) AS total FROM orders GROUP BY 1)
    ORDER BY total DESC, o_orderpriority DESC LIMIT 1""")
def argmax(spark, sf):
    means = table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.round(F.avg("o_totalprice"), 4).alias("total"))
    return best_row(means, "o_orderpriority", ["total", "o_orderpriority"]).withColumnRenamed("o_orderpriority", "best")
