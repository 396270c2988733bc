"""Profiles, quantiles, duplicates, correlation, outliers and quality on small tables."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.operators import correlation, dedup, fitted, outliers, profile, quality
from tablewright.operators.quantiles import LAST_VALUES, exact_quantiles, quantile_row
from tablewright.sources.readers import ROW_ORDER, read_stage


def numbers(spark, values, parts=3):
    cells = [(None if v is None else float(v),) for v in values]
    return spark.createDataFrame(cells, "x double").repartition(parts)


GOLDEN = [1.0, 2.0, 2.0, 3.0, 10.0, 50.0, 7.0]


def test_moments(spark):
    row = profile.distribution_moments(numbers(spark, GOLDEN), ["x"]).first()
    assert row.skewness == pytest.approx(2.467592666)
    assert row.kurtosis == pytest.approx(6.241450478)
    assert row.median == 3 and row.high_skew


def test_moments_of_a_constant_and_of_few(spark):
    row = profile.distribution_moments(numbers(spark, [5.0] * 4), ["x"]).first()
    assert (row.skewness, row.kurtosis, row.std) == (0, 0, 0)
    row = profile.distribution_moments(numbers(spark, [5.0, 6.0]), ["x"]).first()
    assert row.skewness is None and row.kurtosis is None


def test_quantile_interpolates_and_skips_nan(spark):
    df = numbers(spark, [*GOLDEN, float("nan"), None])
    assert quantile_row(df, ["x"], [0.75]).first().x == [8.5]


def _cases():
    rng = random.Random(3)
    n = 4000
    yield "uniform", [rng.random() for _ in range(n)]
    yield "third on one value", [0.5 if i % 3 == 0 else rng.random() for i in range(n)]
    yield "few values", [float(rng.randint(0, 4)) for _ in range(n)]
    yield "long tail", [rng.paretovariate(0.7) for _ in range(n)]
    yield "constant", [2.0] * 50
    yield "two", [1.0, 3.0]
    yield "gap", [0.0] * 2000 + [1.0] * 2000


@pytest.mark.parametrize("name,values", list(_cases()), ids=[c[0] for c in _cases()])
@pytest.mark.parametrize("held", [16, 140, LAST_VALUES])
def test_quantiles_are_exact(spark, name, values, held):
    probs = [0, 0.1, 0.25, 0.5, 0.75, 0.999, 1]
    df = numbers(spark, [*values, None])
    got = exact_quantiles(df, ["x"], probs, held)["x"]
    assert got == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)


def test_selection_of_an_empty_column(spark):
    assert exact_quantiles(numbers(spark, [None]), ["x"], [0.5], 20) == {"x": [None]}


def test_quantiles_of_columns_of_different_length(spark):
    df = spark.range(1000).selectExpr("double(id) AS long", "IF(id < 5, double(id), NULL) AS short")
    got = exact_quantiles(df, ["long", "short"], [0.25, 0.5], 200)
    assert got == {"long": [249.75, 499.5], "short": [1, 2]}


def test_outliers(spark):
    rows = outliers.iqr_outliers(numbers(spark, GOLDEN)).collect()
    assert [(r.column, r.outlier_count, r.upper_bound) for r in rows] == [("x", 1, 18.25)]


def test_distinct_counts_move_digests_only(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, "x" * 3000, "ab", "a", "", "b"]), rng.choice([0.0, -0.0, 1.5, float("nan"), None]),
             rng.randint(1, 40) if i % 3 else 7, i % 2 == 0, i) for i in range(900)]
    df = spark.createDataFrame(rows, "text string, x double, k int, flag boolean, id long").repartition(5)
    made = dedup.distinct_counts(df)
    plan = plan_of(made)  # before it runs
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "Expand" not in plan and sum("digest" in line for line in moved) == 1
    assert not [line for line in moved if "text" in line]
    assert {r.column: r.unique_values for r in made.collect()} == {"text": 5, "x": 2, "k": 40, "flag": 2, "id": 900}
    documented = {r.column_name: (r.missing_count, r.unique_values) for r in profile.describe_columns(df).collect()}
    assert documented["text"] == (sum(r[0] is None for r in rows), 5)
    assert documented["x"] == (sum(r[1] is None or math.isnan(r[1]) for r in rows), 2)
    none = {r.column: r.unique_values for r in dedup.distinct_counts(df.limit(0)).collect()}
    assert none == dict.fromkeys(df.columns, 0)


def test_distinct_sketches_merge(spark):
    df = spark.range(60_000).selectExpr("id % 30000 AS k", "string(id % 7) AS s", "IF(id < 5, id, NULL) AS few")
    parts = [dedup.distinct_sketches(df.where(f"id % 3 = {i}")) for i in range(3)]
    got = {r.column: r.unique_values for r in dedup.estimated_counts(dedup.merge_sketches(parts)).collect()}
    assert got["k"] == pytest.approx(30_000, rel=0.03) and (got["s"], got["few"]) == (7, 5)
    whole = {r.column: r.unique_values for r in dedup.distinct_counts(df, mode="approx").collect()}
    assert whole == got  # a merged sketch is that of all rows


def test_duplicates_with_missing(spark):
    rows = [(1, "x"), (1, "x"), (None, None), (None, None), (2, "y")]
    df = spark.createDataFrame(rows, "k long, v string")
    full = dedup.duplicate_counts(df).first()
    assert (full.total_rows, full.distinct_groups, full.surplus_rows, full.member_rows) == (5, 3, 2, 4)
    assert dedup.duplicate_counts(df, ["k"]).first().surplus_rows == 2
    assert {r.column: r.unique_values for r in dedup.distinct_counts(df).collect()} == {"k": 2, "v": 2}


def test_digest_tells_cells_apart_but_not_signs_of_zero(spark):
    df = spark.createDataFrame([("ab", "c", 0.0), ("a", "bc", 0.0), ("a", None, 0.0), ("a", "", 0.0),
                                ("a", "", -0.0)], "a string, b string, x double")
    assert dedup.duplicate_counts(df, digest=True).first() == dedup.duplicate_counts(df).first()
    assert dedup.duplicate_counts(df).first().distinct_groups == 4


@pytest.mark.parametrize("parts", [1, 16])
def test_keep_first_with_a_hot_key(spark, parts):
    rows = [(0 if i % 3 == 0 else i, i, f"r{i}") for i in range(3000)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k long, ord long, v string").repartition(parts)
    got = {r.k: (r.ord, r.v) for r in dedup.keep_first(df, ["k"], ["ord"]).collect()}
    want = {k: (k, f"r{k}") for k in {r[0] for r in rows}}
    assert got == want
    again = dedup.keep_first(dedup.keep_first(df, ["k"], ["ord"]), ["k"], ["ord"])
    assert again.count() == len(want)


@pytest.mark.parametrize("kind", ["hot", "unique", "none"])
def test_keep_first_fetches_wide_columns_late(spark, tmp_path, kind):
    key = {"hot": "IF(id % 3 = 0, NULL, id % 50)", "unique": "id", "none": "id"}[kind]
    df = spark.range(0 if kind == "none" else 3000).selectExpr(
        f"{key} AS k", "string(id % 4) AS k2", "(id * 7919) % 10 AS ord", "repeat(string(id), 50) AS wide")
    df.repartition(6).write.parquet(f"{tmp_path}/t")
    stage = read_stage(spark, f"{tmp_path}/t", row_order=True)
    made = dedup.keep_first(stage, ["k", "k2"], ["ord"], place=ROW_ORDER)
    for threshold in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        got = dedup.keep_first(stage, ["k", "k2"], ["ord"], place=ROW_ORDER).collect()
        first = {}
        for r in stage.collect():
            at = (r.ord, *r[ROW_ORDER])
            first[r.k, r.k2] = min(first.get((r.k, r.k2), at), at)
        assert {(r.k, r.k2): (r.ord, *r[ROW_ORDER]) for r in got} == first and len(got) == len(first)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert made.columns == stage.columns
    moved = [line for line in plan_of(made).splitlines() if "Aggregate" in line]
    assert moved and not [line for line in moved if "wide" in line]


def test_correlation_uses_complete_pairs(spark):
    rows = [(1.0, 1.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (4.0, 2.0, 5.0)]
    df = spark.createDataFrame(rows, "y double, z double, c double")
    pairs = {(r.col_a, r.col_b): r.corr for r in correlation.correlation_pairs(df).collect()}
    assert list(pairs) == [("y", "z")]
    assert pairs["y", "z"] == pytest.approx(0.142857142857)
    assert {(r.col_a, r.col_b) for r in correlation.correlation_matrix(df).collect()} == {
        ("y", "y"), ("z", "z"), ("y", "z"), ("z", "y")}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_correlation_of_many_columns_in_one_scan(spark, tmp_path):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(700, 100)) @ rng.normal(size=(100, 100)) + 1e7 * rng.random(100)
    data[rng.random(data.shape) < 0.3] = np.nan  # gaps in every column
    data[:, 3], data[::7, 4] = 0.1, np.nan  # a constant
    table = pd.DataFrame(data, columns=[f"c{i:02}" for i in range(100)])
    spark.createDataFrame(table).repartition(5).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    pairs = correlation.correlation_pairs(df)
    assert plan_of(pairs).count("FileScan") == 1 and plan_of(correlation.correlation_matrix(df)).count("FileScan") == 1
    want, got = table.corr(), {(r.col_a, r.col_b): r.corr for r in pairs.collect()}
    assert len(got) == 99 * 98 / 2
    assert all(r == pytest.approx(want.loc[a, b], rel=1e-9, abs=1e-9) for (a, b), r in got.items())
    assert correlation.correlation_matrix(df).count() == 99 * 99


def test_correlation_of_awkward_pairs(spark):
    rng = random.Random(7)
    rows = []
    for i in range(6000):  # more than one block a task
        x = rng.random()
        gap = i % 3 == 0
        # b is constant where c is there; d stands far from zero; e holds an infinite value where f is missing
        rows.append((x, 0.1 if gap else rng.random(), x if gap else None, 1e12 + x, math.inf if i == 5 else x,
                     None if i == 5 else 1 - x, None))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double, g double")
    got = {(r.col_a, r.col_b): r.corr for r in correlation.correlation_pairs(df.repartition(3)).collect()}
    assert ("b", "c") not in got and got["a", "c"] == pytest.approx(1)
    assert got["a", "d"] == pytest.approx(np.corrcoef([r[0] for r in rows], [r[3] - 1e12 for r in rows])[0, 1], abs=1e-7)
    assert got["e", "f"] == pytest.approx(-1) and ("a", "e") not in got
    assert not [p for p in got if "g" in p] and all(-1 <= r <= 1 for r in got.values())
    assert correlation.correlation_pairs(df.limit(0)).count() == correlation.correlation_matrix(df.limit(1)).count() == 0


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(1)
    for values in ([0.0, 1.0, 2.0, 3.0], list(rng.normal(size=500)), [4.0] * 3,
                   [i / 10 for i in range(31)]):
        for bins in (3, 30):
            got = profile.histogram(numbers(spark, [*values, None]), ["x"], bins).orderBy("bin").collect()
            want, edges = np.histogram(values, bins)
            assert [r.n for r in got] == list(want)
            assert [r.bin_start for r in got] == pytest.approx(list(edges[:-1]))


def test_density_integrates_to_about_one(spark):
    values = list(np.random.default_rng(2).normal(size=2000))
    rows = profile.density(numbers(spark, values), ["x"]).orderBy("x").collect()
    area = sum((b.x - a.x) * (a.density + b.density) / 2 for a, b in zip(rows, rows[1:]))
    assert 0.97 < area < 1.01


def test_value_counts_ignore_missing(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    got = {r.category: (r.n, r.percentage) for r in profile.value_counts(df, ["c"]).collect()}
    assert got == {"a": (2, pytest.approx(200 / 3)), "b": (1, pytest.approx(100 / 3))}


def test_names_with_quotes(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, "y")], "`it's a ``col``` double, `b c` string")
    names = df.columns
    assert [r.column for r in profile.missing_by_column(df, only_affected=True).collect()] == names[:1]
    assert profile.numeric_describe(df).first().n == 1


def test_zscores(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (None, 7.0)], "x double, c double")
    out = fitted.standardise(df, ["x", "c"]).agg(
        F.avg("x_normalized"), F.stddev_pop("x_normalized"), F.max("c_normalized")).first()
    assert out[0] == pytest.approx(0) and out[1] == pytest.approx(1) and out[2] == 0


def test_one_hot_takes_every_label(spark):
    many = spark.range(1200).selectExpr("string(id) AS s")
    assert len(fitted.observed_labels(many, ["s"])["s"]) == 1200
    cased = fitted.one_hot(spark.createDataFrame([("a",), ("A",)], "s string"), "s")
    assert cased.columns == ["s", "s_A", "s_a_2"]
    assert sorted(tuple(r) for r in cased.collect()) == [("A", 1, 0), ("a", 0, 1)]
    three = spark.createDataFrame([("b",), ("a",), (None,)], "s string")
    assert fitted.one_hot(three, "s").columns == ["s", "s_a", "s_b"]
    assert [tuple(r)[1:] for r in fitted.one_hot(three, "s").collect()] == [(0, 1), (1, 0), (0, 0)]


def test_quality_penalties(spark):
    rows = [(i // 2, float(i), None) for i in range(100)]
    df = spark.createDataFrame(rows, "k long, x double, gone double")
    rules = [quality.RangeRule("x", 10), quality.RangeRule("absent", 0)]
    row = quality.quality_score(df, quality.ValidationConfig(["k"], rules)).first()
    assert (row.missing_penalty, row.duplicate_penalty, row.outlier_penalty, row.range_penalty) == (
        10, 5, 0, 1)
    assert row.score == 84 and len(row.issues) == 3
    config = quality.ValidationConfig(["k"], rules, range_penalty="violations")
    assert quality.quality_score(df, config).first().range_penalty == 5


def test_removed_rows_are_counted(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "x double")
    kept, seen = profile.drop_missing(df, "x", "removed_test")
    assert kept.count() == 1
    assert seen.get == {"removed": 2, "n_rows": 3}


def test_boxplot_whiskers_lie_inside(spark):
    row = outliers.boxplot_stats(numbers(spark, GOLDEN)).first()
    assert (row.q1, row.median, row.q3, row.whisker_low, row.whisker_high, row.outlier_count) == (
        2, 3, 8.5, 1, 10, 1)
    assert math.isclose(outliers.outlier_rows(numbers(spark, GOLDEN), "x").first().x, 50)
