"""Golden values of the cleaning and shaping functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablewright.functions import cleaning as fc
from tablewright.functions import shaping as fs


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr.alias("x")).collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("policy", ["EXCEPTION", "CORRECTED", "LEGACY"])
def test_dates_do_not_depend_on_the_session(spark, ansi, policy):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    spark.conf.set("spark.sql.legacy.timeParserPolicy", policy)
    try:
        good = column(spark, ["Oct 1, 2008", "oct 21, 2008", "Oct 01, 2008", "Oct  21, 2008"],
                      "string", fc.parse_month_date("v"))
        bad = column(spark, ["October 21, 2008", "Feb 30, 2009", "2008-10-21", "", "Sept 5, 2020",
                             "Aug 2012", "Oct 21, 2008 ", "Oct 21, 08", None],
                     "string", fc.parse_month_date("v"))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
        spark.conf.unset("spark.sql.legacy.timeParserPolicy")
    assert good == [dt.date(2008, 10, 1), dt.date(2008, 10, 21), dt.date(2008, 10, 1),
                    dt.date(2008, 10, 21)]
    assert bad == [None] * 9


def test_numbers(spark):
    texts = ["  2 ", "1e3", ".5", "+4", "1,000", "0x10", "0 - 20000", "1.0d", "1.0f", "0x1p3",
             "nan", "", None, "inf", "-Infinity"]
    inf = float("inf")
    assert column(spark, texts, "string", fc.to_number("v")) == [
        2, 1000, .5, 4, None, None, None, None, None, None, None, None, None, inf, -inf]


def test_only_numbers_are_parsed(spark):
    """A text that does not parse costs an exception, so none such may reach the cast."""
    texts = ["1", " 2.5 ", "+.5", "4.", "1.e5", "1E-3", "-inf", "Infinity", "\t7\n", "8d\r", "", ".", "+", "e5", "1e", "free",
             "0 - 20000", "1,000", "0x10", "1.0d", "3f", "nan", "+NaN", "1_0", "1 2", "\u0661", "inff", None]
    assert column(spark, texts, "string", fc.to_number("v")) == [
        1.0, 2.5, 0.5, 4.0, 1e5, 1e-3, float("-inf"), float("inf"), 7.0, 8.0] + [None] * 18
    taken = column(spark, texts[:-1], "string", F.lower(F.trim(F.col("v"))).rlike(fc.NUMBER))
    assert taken == [True] * 10 + [False] * 17


def test_rounding_ties(spark):
    assert column(spark, [2.675, 0.125, 1.005, 0.375, 2.5, 19.985, None], "double",
                  fc.round_places("v")) == [2.68, 0.12, 1.0, 0.38, 2.5, 19.98, None]


def test_clip_keeps_missing(spark):
    assert column(spark, [None, -3.0, 120.0, 7.0], "double", fc.clip("v", 0.0, 100.0)) == [
        None, 0, 100, 7]


def test_price_and_count(spark):
    texts = ["-3.50", "12.345", "free", None, "7"]
    assert column(spark, texts, "string", fc.clean_price("v")) == [0, 12.34, 0, 0, 7]
    assert column(spark, ["0 - 20000", "-4", "7.9", None, "inf"], "string",
                  fc.clean_count("v")) == [0, 0, 7, 0, 0]


def test_missing_tokens(spark):
    assert column(spark, ["NA", "null", "None", "n/a", "-", "", "nan"], "string",
                  fc.normalize_missing("v")) == [None] * 4 + ["-"] + [None] * 2


def test_trim_takes_all_blanks(spark):
    assert column(spark, ["\t a b \n", None, "　x"], "string", fc.trim_text("v")) == [
        "a b", "", "x"]


def test_safe_identifier(spark):
    assert column(spark, ["My Game: 2! ", "Żółw (x)"], "string", fc.safe_identifier("v")) == [
        "My_Game_2", "Żółw_x"]


def test_presence_modes(spark):
    values = ["True", "False", None]
    assert column(spark, values, "string", fc.presence_flag("v")) == [True, True, False]
    assert column(spark, values, "string", fc.presence_flag("v", "value")) == [True, False, False]


def test_iso_date_fails_on_other_text(spark):
    assert column(spark, ["2008-10-21", None], "string", fc.parse_iso_date("v")) == [
        dt.date(2008, 10, 21), None]
    with pytest.raises(Exception, match="not an ISO date"):
        column(spark, ["21.10.2008"], "string", fc.parse_iso_date("v"))


def test_ratio_of_no_reviews(spark):
    df = spark.createDataFrame([(0, 0), (3, 1)], "p long, n long")
    assert [r[0] for r in df.select(fc.safe_ratio("p", "n")).collect()] == [None, 0.75]


SCORE = ([0, 50, 70, 80, 100], ["Poor", "Fair", "Good", "Excellent"])
PRICE = ([-0.01, 0, 9.99, 19.99, 49.99, float("inf")],
         ["Free", "Budget", "Standard", "Premium", "AAA"])


def test_bins(spark):
    assert column(spark, [0.0, 50.0, 50.1, None, 101.0, -1.0], "double",
                  fs.bin_numeric("v", *SCORE)) == ["Poor", "Poor", "Fair"] + ["Unknown"] * 3
    prices = [0.0, 0.005, 9.99, 9.995, 19.99, 49.99, 50.0]
    assert column(spark, prices, "double", fs.bin_numeric("v", *PRICE)) == [
        "Free", "Budget", "Budget", "Standard", "Standard", "Premium", "AAA"]
    assert column(spark, [None], "double", fs.bin_numeric("v", *SCORE, "nan")) == ["nan"]


def test_list_length(spark):
    assert column(spark, [None, "", "A", "A,B", "A,B,,", "ż,ó"], "string",
                  fs.list_length("v")) == [0, 0, 1, 2, 4, 2]
    assert column(spark, ["a, b, c", "a,b"], "string", fs.list_length("v", ", ")) == [3, 1]


def test_label_boundary(spark):
    df = spark.createDataFrame([(.80, 30), (.80, 29), (.7999, 30), (None, 99)], "r double, t long")
    assert [r[0] for r in df.select(fs.threshold_label("r", "t")).collect()] == [1, 0, 0, 0]


def test_age_of_a_future_date(spark):
    days = column(spark, [dt.date(2024, 1, 11), dt.date(2023, 1, 10)], "date",
                  fs.age_days("v", "2024-01-10"))
    assert days == [-1, 365]
    recent = column(spark, [dt.date(2024, 1, 11), dt.date(2023, 1, 10)], "date",
                    fs.flag(fs.age_days("v", "2024-01-10") < 365))
    assert recent == [1, 0]


def test_division_by_zero_is_missing(spark):
    assert column(spark, [0.0, 4.0], "double", fs.ratio_of(F.lit(2.0), "v")) == [None, 0.5]
