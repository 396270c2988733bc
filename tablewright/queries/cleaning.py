"""Queries for deduplication, projection and the cleaning functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import cleaning as fc
from tablewright.functions.shaping import bin_numeric
from tablewright.operators import dedup, projection
from tablewright.operators.profile import value_counts
from tablewright.queries.base import query, rounded, rounded_sql, table
from tablewright.sources.readers import ROW_ORDER, read_stage

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus", "l_shipdate"]
FIRST_LINES = f"""
    SELECT * FROM lineitem QUALIFY row_number() OVER (
        PARTITION BY {', '.join(LINE_KEY)} ORDER BY {', '.join(LINE_ORDER)}) = 1"""
TIER_EDGES = [0, 20000, 40000, 60000, float("inf")]
TIER_LABELS = ["low", "middle", "high", "top"]


def first_lines(spark, sf):
    return dedup.keep_first(table(spark, sf, "lineitem"), LINE_KEY, LINE_ORDER)


@query("dedup_keep_first_late", """
    SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY n_chars, doc_id) = 1""")
def dedup_keep_first_late(spark, sf):
    """One document per text; only (text, n_chars, place) takes part in finding it."""
    docs = read_stage(spark, f"{sf}/documents.parquet", row_order=True)
    return dedup.keep_first(docs, ["text"], ["n_chars", "doc_id"], place=ROW_ORDER).drop(ROW_ORDER)


@query("dedup_keep_first", FIRST_LINES)
def dedup_keep_first(spark, sf):
    return first_lines(spark, sf)


@query("price_tier_coverage", rounded_sql(f"""
    WITH tiers AS (SELECT CASE WHEN l_extendedprice < 0 THEN 'Unknown'
            WHEN l_extendedprice <= 20000 THEN 'low' WHEN l_extendedprice <= 40000 THEN 'middle'
            WHEN l_extendedprice <= 60000 THEN 'high' ELSE 'top' END AS category
        FROM ({FIRST_LINES}))
    SELECT 'tier' AS "column", category, count(*) AS n,
        count(*) * 100.0::DOUBLE / (SELECT count(*) FROM tiers) AS percentage
    FROM tiers GROUP BY category""", ["percentage"]))
def price_tier_coverage(spark, sf):
    tier = bin_numeric("l_extendedprice", TIER_EDGES, TIER_LABELS).alias("tier")
    return rounded(value_counts(first_lines(spark, sf).select(tier), ["tier"]))


def _dup_sql(what: str, cols: str, source: str) -> str:
    return f"""
    SELECT '{what}' AS what, sum(n)::BIGINT AS total_rows, count(*) AS distinct_groups,
        sum(n - 1)::BIGINT AS surplus_rows, coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT
        AS member_rows FROM (SELECT count(*) AS n FROM {source} GROUP BY {cols})"""


@query("dup_counts", " UNION ALL ".join([
    _dup_sql("line key", "l_orderkey, l_linenumber", "lineitem"),
    _dup_sql("line row", "ALL", "(SELECT * FROM lineitem)").replace(
        "GROUP BY ALL", "GROUP BY " + ", ".join(LINE_KEY + LINE_ORDER)),
    _dup_sql("text", "text", "documents"),
    _dup_sql("quality", "quality", "(SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l "
             "ON d.doc_id = l.doc_id)"),
]))
def dup_counts(spark, sf):
    lines, docs = table(spark, sf, "lineitem"), table(spark, sf, "documents")
    labelled = docs.select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    parts = [("line key", lines, LINE_KEY), ("line row", lines, None), ("text", docs, ["text"]),
             ("quality", labelled, ["quality"])]
    out = None
    for what, df, cols in parts:
        part = dedup.duplicate_counts(df, cols, digest=what == "text").select(F.lit(what).alias("what"), "*")
        out = part if out is None else out.unionByName(part)
    return out


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                 "o_orderpriority"]


@query("distinct_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS unique_values FROM orders"
    for c in ORDER_COLUMNS))
def distinct_counts(spark, sf):
    return dedup.distinct_counts(table(spark, sf, "orders"))


@query("distinct_sketches", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", true AS close FROM orders HAVING count(*) > 0" for c in ORDER_COLUMNS))
def distinct_sketches(spark, sf):
    """Estimates merged from the sketches of two drops, the even and the odd years, beside the exact counts."""
    orders = table(spark, sf, "orders")
    drops = [dedup.distinct_sketches(orders.where(F.year("o_orderdate") % 2 == i)) for i in range(2)]
    found = dedup.estimated_counts(dedup.merge_sketches(drops)).withColumnRenamed("unique_values", "estimate")
    return dedup.distinct_counts(orders).join(found, "column").select(
        "column", (F.abs(F.col("estimate") - F.col("unique_values")) <= 0.03 * F.col("unique_values")).alias("close"))


@query("select_strict", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def select_strict(spark, sf):
    return projection.select_strict(table(spark, sf, "orders"),
                                    ["o_orderkey", "o_orderdate", "o_totalprice"])


@query("select_lenient", "SELECT o_totalprice, o_orderkey FROM orders")
def select_lenient(spark, sf):
    return projection.select_lenient(table(spark, sf, "orders"),
                                     ["o_totalprice", "no_such_column", "o_orderkey"])


@query("select_features", """
    SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""")
def select_features(spark, sf):
    lines = projection.drop_present(table(spark, sf, "lineitem"), ["l_shipdate", "absent"])
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return lines.select(*projection.numeric_columns(lines, keys))


@query("align_schema", """
    SELECT o_totalprice, 0 AS missing_flag, o_orderkey FROM orders""")
def align_schema(spark, sf):
    return projection.align_columns(table(spark, sf, "orders"),
                                    ["o_totalprice", "missing_flag", "o_orderkey"])


@query("bind_columns", """
    SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
        l_extendedprice * l_tax AS tax_charge FROM lineitem""")
def bind_columns(spark, sf):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return projection.bind_columns(table(spark, sf, "lineitem"), {
        "net": net, "tax_charge": F.col("l_extendedprice") * F.col("l_tax"),
    }).select("l_orderkey", "l_linenumber", "net", "tax_charge")


@query("parse_dates", """
    WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN strftime(o_orderdate, '%b %Y')
            WHEN o_orderkey % 23 = 0 THEN 'Feb 30, 2001'
            WHEN o_orderkey % 29 = 0 THEN 'October 21, 2008'
            ELSE strftime(o_orderdate, '%b %-d, %Y') END AS raw FROM orders)
    SELECT o_orderkey, raw, try_strptime(raw, '%b %d, %Y')::DATE AS parsed FROM t
    WHERE try_strptime(raw, '%b %d, %Y') IS NOT NULL""")
def parse_dates(spark, sf):
    key = F.col("o_orderkey")
    raw = (F.when(key % 17 == 0, F.date_format("o_orderdate", "MMM yyyy"))
           .when(key % 23 == 0, "Feb 30, 2001").when(key % 29 == 0, "October 21, 2008")
           .otherwise(F.date_format("o_orderdate", "MMM d, yyyy")))
    return table(spark, sf, "orders").select("o_orderkey", raw.alias("raw")).withColumn(
        "parsed", fc.parse_month_date("raw")).filter("parsed is not null")


@query("parse_iso_dates", """
    SELECT o_orderkey, o_orderdate::DATE AS parsed FROM orders""")
def parse_iso_dates(spark, sf):
    text = F.date_format("o_orderdate", "yyyy-MM-dd").alias("raw")
    return table(spark, sf, "orders").select("o_orderkey", text).select(
        "o_orderkey", fc.parse_iso_date("raw").alias("parsed"))


_PRICE_TEXT = """
    SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN 'about ' || p_size
        WHEN p_partkey % 11 = 0 THEN '-' || (p_partkey % 100) || '.' || (p_partkey % 7)
        WHEN p_partkey % 7 = 0 THEN '  ' || (p_partkey % 90) || '.125 '
        WHEN p_partkey % 5 = 0 THEN '0 - 20000'
        ELSE (p_partkey * 3) || '.' || (p_partkey % 1000) END AS raw FROM part"""


def _price_text(spark, sf):
    key = F.col("p_partkey")
    raw = (F.when(key % 13 == 0, F.concat(F.lit("about "), F.col("p_size")))
           .when(key % 11 == 0, F.concat(F.lit("-"), key % 100, F.lit("."), key % 7))
           .when(key % 7 == 0, F.concat(F.lit("  "), key % 90, F.lit(".125 ")))
           .when(key % 5 == 0, "0 - 20000")
           .otherwise(F.concat(key * 3, F.lit("."), key % 1000)))
    return table(spark, sf, "part").select("p_partkey", raw.alias("raw"))


@query("to_number_clip_round", f"""
    WITH n AS (SELECT p_partkey, raw, try_cast(raw AS DOUBLE) AS number FROM ({_PRICE_TEXT}))
    SELECT p_partkey, raw, number,
        round_even(greatest(coalesce(number, 0), 0) * 100, 0) / 100 AS price,
        CASE WHEN number < 0 THEN 0.0 WHEN number > 100 THEN 100.0 ELSE number END AS score,
        CASE WHEN number < 0 THEN 0.0 ELSE number END AS rank,
        greatest(trunc(coalesce(number, 0)), 0)::BIGINT AS quantity FROM n""")
def to_number_clip_round(spark, sf):
    return _price_text(spark, sf).select(
        "p_partkey", "raw", fc.to_number("raw").alias("number"),
        fc.clean_price("raw").alias("price"), fc.clean_score("raw", 100.0).alias("score"),
        fc.clean_score("raw").alias("rank"), fc.clean_count("raw").alias("quantity"))


@query("safe_ratio", """
    WITH u AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase' AND value > 200) AS pos,
        count(*) FILTER (WHERE event_type = 'error' AND value > 200) AS neg FROM events GROUP BY user_id)
    SELECT user_id, pos, neg, CASE WHEN pos + neg > 0 THEN pos::DOUBLE / (pos + neg) END AS ratio,
        coalesce(CASE WHEN pos + neg > 0 THEN pos::DOUBLE / (pos + neg) END, 0.5) AS ratio_filled
    FROM u""")
def safe_ratio(spark, sf):
    big = F.col("value") > 200
    users = table(spark, sf, "events").groupBy("user_id").agg(
        F.count_if((F.col("event_type") == "purchase") & big).alias("pos"),
        F.count_if((F.col("event_type") == "error") & big).alias("neg"))
    ratio = fc.safe_ratio("pos", "neg")
    return users.withColumns({"ratio": ratio, "ratio_filled": fc.fill(ratio, 0.5)})


@query("trim_text", """
    SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN '' ELSE p_name END AS cleaned FROM part""")
def trim_text(spark, sf):
    padded = F.when(F.col("p_partkey") % 9 != 0,
                    F.concat(F.lit("\t  "), F.col("p_name"), F.lit(" \n ")))
    return table(spark, sf, "part").select("p_partkey", fc.trim_text(padded).alias("cleaned"))


@query("safe_name", r"""
    SELECT p_partkey, replace(rtrim(regexp_replace(p_name || ' (' || p_brand || ') / ',
        '[^\p{L}\p{N} ]', '', 'g')), ' ', '_') AS safe FROM part""")
def safe_name(spark, sf):
    name = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(") / "))
    return table(spark, sf, "part").select("p_partkey", fc.safe_identifier(name).alias("safe"))


@query("presence_flags", """
    SELECT d.doc_id, quality IS NOT NULL AS has_quality, coalesce(toxic <> 0, false) AS is_toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def presence_flags(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    joined = docs.join(table(spark, sf, "labels"), "doc_id", "left")
    return joined.select("doc_id", fc.presence_flag("quality").alias("has_quality"),
                         fc.presence_flag("toxic", "value").alias("is_toxic"))


@query("missing_tokens", """
    SELECT event_id, CASE WHEN event_id % 6 IN (1, 2, 3, 4) THEN NULL WHEN event_id % 6 = 5 THEN '-'
        ELSE event_type END AS cleaned FROM events""")
def missing_tokens(spark, sf):
    turn = F.col("event_id") % 6
    raw = (F.when(turn == 1, "").when(turn == 2, "NA").when(turn == 3, "null")
           .when(turn == 4, "n/a").when(turn == 5, "-").otherwise(F.col("event_type")))
    return table(spark, sf, "events").select("event_id", fc.normalize_missing(raw).alias("cleaned"))


@query("percent_money_text", """
    SELECT o_orderkey, printf('$%.2f', o_totalprice) AS money,
        printf('%.2f%%', o_totalprice / 5000) AS percent FROM orders""")
def percent_money_text(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", fc.money_text("o_totalprice").alias("money"),
        fc.percent_text(F.col("o_totalprice") / 5000).alias("percent"))
