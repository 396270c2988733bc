"""Splits, running sums, classifier metrics, models and attribution."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from scans import scans_of

from tablewright.operators import explain, metrics, models, profile, scenarios, split
from tablewright.operators.ordered import order_buckets, running_sums


@pytest.mark.parametrize("split_fn", [split.hash_split, split.exact_split])
def test_split_does_not_depend_on_partitions(spark, split_fn):
    df = spark.range(3000)
    one = {r.id: r.split for r in split_fn(df.coalesce(1), ["id"]).collect()}
    many = {r.id: r.split for r in split_fn(df.repartition(16), ["id"]).collect()}
    assert one == many and len(one) == 3000


@pytest.mark.parametrize("n", [1, 2, 7, 1001])
def test_exact_sizes(spark, n):
    sizes = {r.split: r["count"] for r in
             split.exact_split(spark.range(n), ["id"]).groupBy("split").count().collect()}
    train, val = int(n * 0.7), int(n * 0.15)
    assert [sizes.get(s, 0) for s in ("train", "val", "test")] == [train, val, n - train - val]


@pytest.mark.parametrize("near,scans", [(0.25, 2), (0.0, 3)])
def test_exact_split_scans(spark, tmp_path, near, scans):
    spark.range(5000).repartition(4).write.parquet(f"{tmp_path}/keys")
    df = spark.read.parquet(f"{tmp_path}/keys")
    rows, seen = scans_of(spark, f"{tmp_path}/keys", lambda: split.exact_split(df, ["id"], near=near).collect())
    assert seen == scans
    order = [r.id for r in df.orderBy(split.key_hash(["id"])).collect()]
    want = dict(zip(order, ["train"] * 3500 + ["val"] * 750 + ["test"] * 750))
    assert {r.id: r.split for r in rows} == want


def test_exact_split_of_none(spark):
    assert split.exact_split(spark.range(0), ["id"]).collect() == []


def test_copies_of_a_key_stay_together(spark):
    df = spark.range(900).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS id")
    sides = split.exact_split(df, ["id"]).groupBy("id").agg(F.count_distinct("split").alias("n"))
    assert sides.filter("n > 1").count() == 0


def test_running_sums_over_buckets(spark):
    rng = random.Random(5)
    rows = [(rng.random(), rng.randint(0, 5)) for _ in range(500)]
    df = spark.createDataFrame(rows, "x double, v long").repartition(7)
    want = np.cumsum([v for _, v in sorted(rows)])
    for buckets in (2, 8):
        made = running_sums(order_buckets(df, "x", buckets), [F.col("x")], {"s": F.col("v")})
        assert [r.s for r in made.select("x", "s").orderBy("x").collect()] == list(want)
        assert "NestedLoop" not in made._jdf.queryExecution().executedPlan().toString()


def scores(spark, pairs):
    return spark.createDataFrame([(float(p), int(y)) for p, y in pairs], "score double, label int")


def test_curves_with_ties(spark):
    df = scores(spark, zip([.1, .4, .35, .8, .4, .1], [0, 0, 1, 1, 1, 0]))
    assert metrics.roc_auc(df).first()[0] == pytest.approx(0.8333333333)
    assert metrics.pr_auc(df).first()[0] == pytest.approx(0.8472222222)
    mixed = scores(spark, zip([.9, .9, .5], [0, 1, 1]))
    assert metrics.pr_auc(mixed).first()[0] == pytest.approx(2 / 3)


def test_curves_against_brute_force(spark):
    rng = random.Random(9)
    pairs = [(rng.choice([0.3, round(rng.random(), 3)]), rng.random() < 0.4) for _ in range(600)]
    df = scores(spark, pairs).repartition(5)
    pos = [p for p, y in pairs if y]
    neg = [p for p, y in pairs if not y]
    won = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    for how in ({}, {"buckets": 16}):
        assert metrics.roc_auc(df, **how).first()[0] == pytest.approx(won)
        flipped = df.withColumn("score", 1 - F.col("score"))
        assert metrics.roc_auc(flipped, **how).first()[0] == pytest.approx(1 - won)
        points = metrics.roc_points(df, **how).orderBy(F.desc("threshold")).collect()
        area = sum((b.fpr - a.fpr) * (a.tpr + b.tpr) / 2 for a, b in zip(points, points[1:]))
        assert area == pytest.approx(won)
        every = metrics.roc_points(df, drop_collinear=False, **how).count()
        assert len(points) < every == len({p for p, _ in pairs}) + 1


def test_one_class_has_no_auc(spark):
    assert metrics.roc_auc(scores(spark, [(.2, 1), (.4, 1)])).first()[0] is None


def test_confusion_is_complete(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 1)], "label int, prediction int")
    got = {(r.label, r.prediction): r.n for r in metrics.confusion_matrix(df).collect()}
    assert got == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 2}
    row = metrics.binary_metrics(df.filter("label = 0").withColumn("prediction", F.lit(0))).first()
    assert (row.accuracy, row.precision, row.recall, row.f1_score) == (1, 0, 0, 0)


SIZES = models.ModelSizes(lr_iterations=50, trees=5, depth=4, rounds=3)


@pytest.fixture(scope="module")
def training(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 3))
    y = (x[:, 0] + 0.3 * x[:, 1] > 0).astype(int)
    df = spark.createDataFrame(
        [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))],
        "id long, a double, b double, c double, y int").cache()
    parts = split.hash_split(df, ["id"])
    train, val = parts.filter("split = 'train'"), parts.filter("split <> 'train'")
    done = models.train_and_compare(train, val, ["a", "b", "c"], "y", sizes=SIZES)
    return done, val


def test_models_learn_and_the_best_is_kept(spark, training):
    done, _ = training
    rows = {r.model: r for r in done.results.collect()}
    assert set(rows) == {"logistic_regression", "random_forest", "gradient_boosting"}
    assert min(r.roc_auc for r in rows.values()) > 0.9
    assert rows[done.best].roc_auc == max(r.roc_auc for r in rows.values())
    table = models.importances(done.models["random_forest"], ["a", "b", "c"], spark).collect()
    assert table[0].feature == "a" and sum(r.importance for r in table) == pytest.approx(1)
    assert models.importances(done.models["logistic_regression"], ["a", "b", "c"], spark, 1).count() == 1


def test_first_of_equal_models_wins(spark):
    rows = [("one", 0, .5, .5, .5, .5, .9, 1.), ("two", 1, .5, .5, .5, .5, .9, 1.)]
    assert models.best_of(spark.createDataFrame(rows, models.RESULT_SCHEMA)) == "one"


def test_model_survives_saving(training, tmp_path):
    done, val = training
    models.save_model(done.best_model, str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"))
    ready = models.model_input(val, ["a", "b", "c"], "y")
    a = {r.id: r.score for r in models.predict(done.best_model, ready).collect()}
    b = {r.id: r.score for r in models.predict(again, ready).collect()}
    assert a == pytest.approx(b)
    with pytest.raises(Exception):
        models.load_model(str(tmp_path / "absent"))


def test_shapley_shares_add_up(training):
    done, val = training
    ready = models.model_input(val, ["a", "b", "c"], "y")
    forest = done.models["random_forest"]
    shares = explain.shapley_attribution(forest, ready, ["a", "b", "c"], ["id"], 40, 5)
    per_row = {r.id: r.s for r in shares.groupBy("id").agg(F.sum("contribution").alias("s")).collect()}
    scored = {r.id: r.score for r in models.predict(forest, ready).collect()}
    assert len(per_row) == 40
    # Each share sum is the prediction less a mean of predictions, which lies in [0, 1].
    assert all(-1e-9 <= scored[i] - s <= 1 + 1e-9 for i, s in per_row.items())
    assert explain.mean_attribution(shares).first().feature == "a"


def test_linear_shares_have_mean_zero(training):
    done, val = training
    ready = models.model_input(val, ["a", "b", "c"], "y")
    shares = explain.linear_attribution(done.models["logistic_regression"], ready, ["a", "b", "c"], ["id"])
    for r in explain.mean_attribution(shares).collect():
        assert r.mean_contribution == pytest.approx(0, abs=1e-9)


def test_scenario_rules(spark):
    df = spark.createDataFrame(
        [("", "", "", "", "TAK", "", "", ""), ("X", "9.99", "4", "0", "n", "-1", "1.5", "ten"),
         ("Y", "-2", "3", "10", "yes", "0", "1", "0"), ("Z", "1.0d", "1.5", "2", "?", "5", "0", "1")],
        "name string, price string, platforms string, genres string, achievements string, "
        "reviews string, ratio string, owners string")
    rows = scenarios.validate_scenarios(df).collect()
    first = rows[0]
    assert (first.name, first.price, first.platforms, first.genres, first.reviews, first.ratio,
            first.owners, first.achievements) == ("Projekt_Nieznany", 0, 1, 1, 100, 0.8, 10000, True)
    assert [len(r.errors) for r in rows] == [0, 5, 0, 3]
    spaced = spark.createDataFrame([("\tN ", "2\t", "1_0", "tak\n")], "name string, platforms string, genres string, achievements string")
    row = scenarios.validate_scenarios(spaced).first()
    assert (row.name, row.platforms, row.genres, row.achievements, row.errors) == ("N", 2, 10, True, [])
    made = scenarios.scenario_features(scenarios.validate_scenarios(df).limit(1), "2024-05-01").first()
    assert (made.Release_year, made.Is_free, made.Has_achievements) == (2024, 1, 1)


def test_best_and_top_rows(spark):
    rows = [("a", 0.5, 1), ("b", 0.9, 3), ("c", 0.9, 2), ("d", None, 0), ("e", float("nan"), 0), ("b", 0.9, 3)]
    df = spark.createDataFrame(rows, "model string, `roc.auc` double, rank int")
    finite = df.filter("model <> 'e'")
    assert tuple(models.best_row(finite, "model", ["roc.auc"], ["rank"]).first()) == ("c", 0.9)
    assert tuple(models.best_row(df.limit(0), "model", ["roc.auc"]).first()) == (None, None)
    got = [(r.model, r.rank) for r in profile.top_rows(df, ["roc.auc"], 5, ["rank"]).collect()]
    assert got == [("c", 2), ("b", 3), ("b", 3), ("a", 1), ("d", 0)]
    assert profile.top_rows(df.limit(0), ["roc.auc"], 3).collect() == []
