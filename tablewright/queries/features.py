"""Queries for features, fitted features, the catalogue plans, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import shaping
from tablewright.functions.cleaning import nan_to_null
from tablewright.operators import fitted, profile, split
from tablewright.plans import catalogue as cat
from tablewright.plans.cleaning import clean_catalogue
from tablewright.plans.engineering import engineer_features, final_table
from tablewright.queries.base import query, rounded, rounded_sql, table
from tablewright.session import staged

AS_OF = "2001-12-31"


@query("date_features", f"""
    SELECT o_orderkey, year(o_orderdate)::INTEGER AS y, month(o_orderdate)::INTEGER AS m,
        quarter(o_orderdate)::INTEGER AS q,
        date_diff('day', o_orderdate::DATE, DATE '{AS_OF}') AS age,
        (date_diff('day', o_orderdate::DATE, DATE '{AS_OF}') < 365)::INTEGER AS recent
    FROM orders""")
def date_features(spark, sf):
    age = shaping.age_days("o_orderdate", AS_OF)
    return table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"),
        F.quarter("o_orderdate").alias("q"), age.alias("age"), shaping.flag(age < 365).alias("recent"))


@query("flag_sums", """
    SELECT l_orderkey, l_linenumber, a + f + d AS flags, a AS has_a, f AS has_f, d AS has_d,
        (a + f + d > 1)::INTEGER AS several
    FROM (SELECT l_orderkey, l_linenumber, (l_returnflag = 'A')::INTEGER AS a,
        (l_linestatus = 'F')::INTEGER AS f, (l_discount > 0)::INTEGER AS d FROM lineitem)""")
def flag_sums(spark, sf):
    parts = {"has_a": F.col("l_returnflag") == "A", "has_f": F.col("l_linestatus") == "F",
             "has_d": F.col("l_discount") > 0}
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", *[shaping.flag(p).alias(n) for n, p in parts.items()])
    total = F.col("has_a") + F.col("has_f") + F.col("has_d")
    return lines.withColumns({"flags": total, "several": shaping.flag(total > 1)})


_USERS = """SELECT user_id, count(*) FILTER (WHERE event_type IN ('purchase', 'view')) AS pos,
    count(*) AS total FROM events GROUP BY user_id"""


@query("threshold_label", f"""
    SELECT user_id, pos::DOUBLE / total AS ratio, total,
        (pos::DOUBLE / total >= 0.4 AND total >= 60)::INTEGER AS label FROM ({_USERS})""")
def threshold_label(spark, sf):
    good = F.count_if(F.col("event_type").isin("purchase", "view")).cast("double")
    users = table(spark, sf, "events").groupBy("user_id").agg(
        (good / F.count(F.lit(1))).alias("ratio"), F.count(F.lit(1)).alias("total"))
    return users.withColumn("label", shaping.threshold_label("ratio", "total", 0.4, 60))


@query("heavy_flag", """
    SELECT event_id, value, (value > q)::INTEGER AS heavy
    FROM events, (SELECT quantile_cont(value, 0.75) AS q FROM events) s""")
def heavy_flag(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value")
    return fitted.above_quantile(events, "value", "heavy")


_TIER = """CASE WHEN {c} IS NULL OR {c} < -0.01 THEN 'Unknown' WHEN {c} <= 0 THEN 'Free'
    WHEN {c} <= 9.99 THEN 'Budget' WHEN {c} <= 19.99 THEN 'Standard'
    WHEN {c} <= 49.99 THEN 'Premium' ELSE 'AAA' END"""
_GRADE = """CASE WHEN {c} IS NULL OR {c} < 0 THEN 'Unknown' WHEN {c} <= 50 THEN 'Poor'
    WHEN {c} <= 70 THEN 'Fair' WHEN {c} <= 80 THEN 'Good' WHEN {c} <= 100 THEN 'Excellent'
    ELSE 'Unknown' END"""


@query("bins", f"""
    SELECT event_id, {_TIER.format(c='value')} AS tier,
        {_GRADE.format(c="nullif(value, 12.31)")} AS grade FROM events""")
def bins(spark, sf):
    grade = F.nullif("value", F.lit(12.31))
    return table(spark, sf, "events").select(
        "event_id", shaping.bin_numeric("value", cat.PRICE_EDGES, cat.PRICE_LABELS).alias("tier"),
        shaping.bin_numeric(grade, cat.SCORE_EDGES, cat.SCORE_LABELS).alias("grade"))


@query("price_features", rounded_sql(f"""
    SELECT l_orderkey, l_linenumber, price, (price = 0)::INTEGER AS is_free,
        {_TIER.format(c='price')} AS tier,
        CASE WHEN price > 0 THEN ln(1 + price) ELSE 0 END::DOUBLE AS log_price
    FROM (SELECT l_orderkey, l_linenumber, l_discount * 1000 AS price FROM lineitem)""",
    ["price", "log_price"]))
def price_features(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_discount") * 1000).alias("price"))
    return rounded(lines.withColumns({
        "is_free": shaping.flag(F.col("price") == 0),
        "tier": shaping.bin_numeric("price", cat.PRICE_EDGES, cat.PRICE_LABELS),
        "log_price": shaping.paid_log("price")}))


@query("one_hot", """
    SELECT o_orderkey, o_orderstatus, (o_orderstatus = 'F')::INTEGER AS "o_orderstatus_F",
        (o_orderstatus = 'O')::INTEGER AS "o_orderstatus_O",
        (o_orderstatus = 'P')::INTEGER AS "o_orderstatus_P" FROM orders""")
def one_hot(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return fitted.one_hot(orders, "o_orderstatus")


@query("list_count", """
    SELECT doc_id, CASE WHEN listed = '' THEN 0
        ELSE (length(listed) - length(replace(listed, ', ', ''))) // 2 + 1 END::INTEGER AS entries
    FROM (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN '' ELSE text END AS listed FROM documents)""")
def list_count(spark, sf):
    listed = F.when(F.col("doc_id") % 10 != 0, F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", shaping.list_length(listed, ", ").alias("entries"))


@query("log_features", rounded_sql("""
    SELECT p_partkey, ln(1 + p_retailprice) AS log_price, (p_size > 25)::INTEGER AS big,
        (p_size * 1.0)::DOUBLE AS size_again FROM part""", ["log_price", "size_again"]))
def log_features(spark, sf):
    size = F.expm1(F.log1p(F.col("p_size").cast("double")))
    return rounded(table(spark, sf, "part").select(
        "p_partkey", F.log1p("p_retailprice").alias("log_price"),
        shaping.flag(F.col("p_size") > 25).alias("big"), size.alias("size_again")))


@query("zscore", rounded_sql("""
    SELECT l_orderkey, l_linenumber, (l_quantity - mq) / sq AS quantity_z,
        (coalesce(nullif(l_discount, 0.05), 0) - md) / sd AS discount_z, 0.0::DOUBLE AS constant_z
    FROM lineitem, (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq,
        avg(coalesce(nullif(l_discount, 0.05), 0)) AS md,
        stddev_pop(coalesce(nullif(l_discount, 0.05), 0)) AS sd FROM lineitem) s""",
    ["quantity_z", "discount_z", "constant_z"]))
def zscore(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.nullif("l_discount", F.lit(0.05)).alias("l_discount"), F.lit(7.0).alias("constant"))
    names = {"l_quantity": "quantity_z", "l_discount": "discount_z", "constant": "constant_z"}
    return rounded(fitted.standardise(lines, names).drop("l_quantity", "l_discount", "constant"))


@query("interactions", rounded_sql("""
    SELECT l_orderkey, l_linenumber, l_extendedprice / (nullif(l_quantity, 1) + 1) AS price_ratio,
        nullif(l_quantity, 1) / 100 * l_discount AS rating, ln(1 + l_extendedprice) * l_discount AS owners
    FROM lineitem""", ["price_ratio", "rating", "owners"], 9))
def interactions(spark, sf):
    score = F.nullif("l_quantity", F.lit(1.0))
    return rounded(table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        shaping.ratio_of("l_extendedprice", score + 1).alias("price_ratio"),
        (score / 100 * F.col("l_discount")).alias("rating"),
        (F.log1p("l_extendedprice") * F.col("l_discount")).alias("owners")), 9)


# A raw catalogue made of the orders and their customers: every text column with the faults the
# cleaning step is there for.
RAW_SQL = """
    SELECT (o_orderkey // 2) AS "AppID", o_orderkey AS ord,
        '  ' || o_orderpriority || ' ' AS "Name",
        CASE WHEN o_orderkey % 19 = 0 THEN 'Aug 2012' ELSE strftime(o_orderdate, '%b %-d, %Y') END
            AS "Release date",
        CASE WHEN o_orderkey % 13 = 0 THEN 'free' WHEN o_orderkey % 7 = 0 THEN '0.0'
            ELSE (o_custkey % 70) || '.' || (o_orderkey % 1000) END AS "Price",
        CASE WHEN o_custkey % 3 > 0 THEN 'True' END AS "Windows",
        CASE WHEN o_custkey % 5 = 0 THEN 'False' END AS "Mac",
        CASE WHEN o_custkey % 7 = 0 THEN 'x' END AS "Linux",
        CASE WHEN o_orderkey % 4 > 0 THEN (o_custkey % 120 - 5)::VARCHAR END AS "Metacritic score",
        (o_custkey % 40 - 3)::VARCHAR AS "Achievements",
        c_name AS "Developers", coalesce(c_mktsegment, '') AS "Publishers",
        replace(o_orderpriority, ' ', ',') AS "Categories",
        CASE WHEN o_orderkey % 5 > 0 THEN replace(o_orderpriority, '-', ',') END AS "Genres",
        (o_custkey % 13)::VARCHAR AS "User score", '' AS "Score rank",
        (o_custkey % 90)::VARCHAR AS "Positive", (o_orderkey % 12)::VARCHAR AS "Negative",
        CASE WHEN o_orderkey % 3 = 0 THEN '0 - 20000' ELSE (o_custkey * 7)::VARCHAR END AS "Estimated owners"
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""


def raw_catalogue(spark, sf):
    order, cust = F.col("o_orderkey"), F.col("o_custkey")
    joined = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    text = {
        "Name": F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")),
        "Release date": F.when(order % 19 == 0, "Aug 2012").otherwise(
            F.date_format("o_orderdate", "MMM d, yyyy")),
        "Price": F.when(order % 13 == 0, "free").when(order % 7 == 0, "0.0").otherwise(
            F.concat(cust % 70, F.lit("."), order % 1000)),
        "Windows": F.when(cust % 3 > 0, "True"),
        "Mac": F.when(cust % 5 == 0, "False"),
        "Linux": F.when(cust % 7 == 0, "x"),
        "Metacritic score": F.when(order % 4 > 0, (cust % 120 - 5).cast("string")),
        "Achievements": (cust % 40 - 3).cast("string"),
        "Developers": F.col("c_name"),
        "Publishers": F.coalesce("c_mktsegment", F.lit("")),
        "Categories": F.translate("o_orderpriority", " ", ","),
        "Genres": F.when(order % 5 > 0, F.translate("o_orderpriority", "-", ",")),
        "User score": (cust % 13).cast("string"),
        "Score rank": F.lit(""),
        "Positive": (cust % 90).cast("string"),
        "Negative": (order % 12).cast("string"),
        "Estimated owners": F.when(order % 3 == 0, "0 - 20000").otherwise((cust * 7).cast("string")),
    }
    return joined.select(F.floor(order / 2).cast("string").alias("AppID"), order.alias("ord"),
                         *[c.alias(n) for n, c in text.items()])


CLEAN_SQL = f"""
    WITH first_rows AS (SELECT * FROM ({RAW_SQL}) QUALIFY
            row_number() OVER (PARTITION BY "AppID" ORDER BY ord) = 1),
    c AS (SELECT "AppID", trim("Name") AS "Name",
        try_strptime("Release date", '%b %d, %Y')::DATE AS "Release date",
        round_even(greatest(coalesce(try_cast("Price" AS DOUBLE), 0), 0) * 100, 0) / 100 AS "Price",
        "Windows" IS NOT NULL AS "Windows", "Mac" IS NOT NULL AS "Mac", "Linux" IS NOT NULL AS "Linux",
        CASE WHEN try_cast("Metacritic score" AS DOUBLE) < 0 THEN 0.0
            WHEN try_cast("Metacritic score" AS DOUBLE) > 100 THEN 100.0
            ELSE try_cast("Metacritic score" AS DOUBLE) END AS "Metacritic score",
        greatest(try_cast("Achievements" AS BIGINT), 0) AS "Achievements",
        coalesce(trim("Developers"), '') AS "Developers", trim("Publishers") AS "Publishers",
        trim("Categories") AS "Categories", coalesce(trim("Genres"), '') AS "Genres",
        least(try_cast("User score" AS DOUBLE), 10.0) AS "User score",
        NULL::DOUBLE AS "Score rank", "Positive"::BIGINT AS "Positive", "Negative"::BIGINT AS "Negative",
        coalesce(try_cast("Estimated owners" AS BIGINT), 0) AS "Estimated owners"
        FROM first_rows)
    SELECT *, CASE WHEN "Positive" + "Negative" > 0
        THEN "Positive"::DOUBLE / ("Positive" + "Negative") END AS "Review_ratio"
    FROM c WHERE "Release date" IS NOT NULL"""


def cleaned_catalogue(spark, sf):
    return clean_catalogue(raw_catalogue(spark, sf), ["ord"])


@query("clean_catalogue", CLEAN_SQL)
def clean_catalogue_query(spark, sf):
    return cleaned_catalogue(spark, sf)


_FEATURED = f"""
    WITH t AS (SELECT *, "Positive" + "Negative" AS "Total_reviews",
        date_diff('day', "Release date", DATE '{AS_OF}') AS "Days_since_release",
        coalesce("Review_ratio", 0.5) AS ratio,
        "Windows"::INTEGER + "Mac"::INTEGER + "Linux"::INTEGER AS "Platform_count",
        {_GRADE.format(c='"Metacritic score"')} AS grade, {_TIER.format(c='"Price"')} AS tier
        FROM ({CLEAN_SQL})),
    s AS (SELECT quantile_cont("Total_reviews", 0.75) AS q, avg("Price") AS mp, stddev_pop("Price") AS sp,
        avg(coalesce("User score", 0)) AS mu, stddev_pop(coalesce("User score", 0)) AS su,
        avg(coalesce("Metacritic score", 0)) AS mm, stddev_pop(coalesce("Metacritic score", 0)) AS sm
        FROM t)"""


@query("engineered_catalogue", rounded_sql(f"""{_FEATURED}
    SELECT "AppID" AS id, month("Release date")::INTEGER AS release_month, "Days_since_release" AS age,
        ("Days_since_release" < 365)::INTEGER AS recent, ("Platform_count" > 1)::INTEGER AS several,
        ("Total_reviews" > q)::INTEGER AS heavy, ("Metacritic score" IS NOT NULL)::INTEGER AS scored,
        grade, tier, (grade = 'Good')::INTEGER AS good, (grade = 'Unknown')::INTEGER AS unknown,
        (tier = 'AAA')::INTEGER AS aaa, "User score" / 10 AS user_share,
        ln(1 + "Achievements") AS log_achievements,
        CASE WHEN "Price" > 0 THEN ln(1 + "Price") ELSE 0 END::DOUBLE AS log_price,
        CASE WHEN "Categories" = '' THEN 0 ELSE length("Categories")
            - length(replace("Categories", ',', '')) + 1 END::INTEGER AS categories,
        ("Price" - mp) / sp AS price_z, (coalesce("User score", 0) - mu) / su AS user_z,
        (coalesce("Metacritic score", 0) - mm) / sm AS meta_z,
        "Price" / ("Metacritic score" + 1) AS price_rating,
        "Metacritic score" / 100 * ratio AS rating_review,
        ln(1 + "Estimated owners") * ratio AS owners_review FROM t, s""",
    ["user_share", "log_achievements", "log_price", "price_z", "user_z", "meta_z", "price_rating",
     "rating_review", "owners_review"], 9))
def engineered_catalogue(spark, sf):
    names = {
        "AppID": "id", "Release_month": "release_month", "Days_since_release": "age",
        "Is_recent": "recent", "Is_multiplatform": "several", "Is_heavily_reviewed": "heavy",
        "Has_metacritic": "scored", "Metacritic_category": "grade", "Price_category": "tier",
        "Metacritic_category_Good": "good", "Metacritic_category_Unknown": "unknown",
        "Price_category_AAA": "aaa", "User_score_normalized": "user_share",
        "Log_achievements": "log_achievements", "Log_price": "log_price",
        "Category_count": "categories", "Price_normalized": "price_z", "user_score_z": "user_z",
        "Metacritic score_normalized": "meta_z", "Price_Rating_ratio": "price_rating",
        "Rating_Review_score": "rating_review", "Owners_Review_ratio": "owners_review",
    }
    made = engineer_features(staged(cleaned_catalogue(spark, sf), "cleaned"), AS_OF)
    return rounded(made.select(*[F.col(c).alias(n) for c, n in names.items()]), 9)


FINAL_SQL = rounded_sql(f"""{_FEATURED}
    SELECT "AppID", "Name", nullif("Genres", '') AS "Genres", year("Release date")::INTEGER AS "Release_year",
        "Days_since_release", "Platform_count", "Price", ("Price" = 0)::INTEGER AS "Is_free",
        "Total_reviews", ratio AS "Review_ratio",
        (ratio >= 0.8 AND "Total_reviews" >= 30)::INTEGER AS "Is_highly_rated",
        ln(1 + "Estimated owners") AS "Log_owners", ("Achievements" > 0)::INTEGER AS "Has_achievements",
        ln(1 + "Total_reviews") AS "Log_total_reviews",
        CASE WHEN "Genres" = '' THEN 0 ELSE length("Genres") - length(replace("Genres", ',', '')) + 1
            END::INTEGER AS "Genre_count" FROM t""",
    ["Price", "Review_ratio", "Log_owners", "Log_total_reviews"])


@query("final_catalogue", FINAL_SQL)
def final_catalogue(spark, sf):
    return rounded(final_table(engineer_features(staged(cleaned_catalogue(spark, sf), "cleaned"), AS_OF)))


@query("nan_as_missing", """
    SELECT count(v) AS n, round(avg(v), 6) AS mean, max(v) AS largest
    FROM (SELECT CASE WHEN l_discount > 0 THEN l_quantity END AS v FROM lineitem)""")
def nan_as_missing(spark, sf):
    spoiled = F.when(F.col("l_discount") > 0, F.col("l_quantity")).otherwise(F.lit(float("nan")))
    clean = table(spark, sf, "lineitem").select(nan_to_null(spoiled).alias("v"))
    return clean.agg(F.count("v").alias("n"), F.round(F.avg("v"), 6).alias("mean"),
                     F.max("v").alias("largest"))


_HASH = "('0x' || substr(md5('42:' || o_orderkey), 1, 15))::BIGINT"
_SPLIT = f"""SELECT o_orderkey, CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.7::DOUBLE + 0.15::DOUBLE
    THEN 'val' ELSE 'test' END AS split
    FROM (SELECT o_orderkey, {_HASH} / 1152921504606846976.0::DOUBLE AS u FROM orders)"""


@query("hash_split", _SPLIT)
def hash_split(spark, sf):
    return split.hash_split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


@query("exact_split", f"""
    SELECT o_orderkey, CASE WHEN r <= a THEN 'train' WHEN r <= a + b THEN 'val' ELSE 'test' END AS split
    FROM (SELECT o_orderkey, row_number() OVER (ORDER BY {_HASH}, o_orderkey) AS r,
        floor(count(*) OVER () * 0.7::DOUBLE) AS a, floor(count(*) OVER () * 0.15::DOUBLE) AS b
        FROM orders)""")
def exact_split(spark, sf):
    return split.exact_split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


@query("split_sizes", rounded_sql(f"""
    SELECT split, count(*) AS n, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM orders) AS percentage
    FROM ({_SPLIT}) GROUP BY split""", ["percentage"]))
def split_sizes(spark, sf):
    return rounded(split.split_sizes(hash_split(spark, sf)))


@query("fixed_sample", f"""
    SELECT o_orderkey, o_custkey FROM orders ORDER BY {_HASH}, o_orderkey LIMIT 1000""")
def fixed_sample(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return split.fixed_sample(orders, ["o_orderkey"], 1000)
