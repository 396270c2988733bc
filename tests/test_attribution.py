"""Shapley values against all subsets of features, with their errors."""

from itertools import combinations
from math import factorial

import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablewright.operators.explain import mean_attribution, shapley_attribution
from tablewright.operators.models import fit_model, spread

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def points(spark, tmp_path_factory):
    made = spark.range(240).select(
        "id", *[(F.pmod(F.xxhash64("id", F.lit(f)), F.lit(100)) / 50.0).alias(f) for f in FEATURES]).withColumn(
        "label", (F.col("a") * F.col("b") + F.col("c") > 1.9).cast("double"))
    path = str(tmp_path_factory.mktemp("points") / "t")
    made.coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def exact(spark, model, sample, output):
    """Mean over all backgrounds of the Shapley values by their definition."""
    rows = sample.collect()
    asked = [(i, j, m, *[float(rows[i if m >> f & 1 else j][n]) for f, n in enumerate(FEATURES)])
             for i in range(len(rows)) for j in range(len(rows)) for m in range(16)]
    scored = model.transform(spark.createDataFrame(asked, ["i", "j", "m", *FEATURES]))
    values = {(r.i, r.m): r.p for r in scored.select("i", "m", output.alias("p")).groupBy("i", "m").agg(
        F.avg("p").alias("p")).collect()}
    found = {}
    for i, row in enumerate(rows):
        for f, name in enumerate(FEATURES):
            rest = [g for g in range(4) if g != f]
            found[row.id, name] = sum(
                factorial(k) * factorial(3 - k) / 24 * (values[i, m | 1 << f] - values[i, m])
                for k in range(4) for m in (sum(1 << g for g in some) for some in combinations(rest, k)))
    return found


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_within_three_errors_of_all_subsets(spark, points, kind):
    share = vector_to_array("probability")
    if kind == "forest":
        estimator, output = RandomForestClassifier(numTrees=4, maxDepth=4, seed=1), share[1]
    else:
        estimator, output = GBTClassifier(maxIter=4, maxDepth=3, seed=1), F.log(share[1] / share[0])
    model = fit_model(points, estimator, FEATURES)
    sample = points.filter("id < 20")
    want = exact(spark, model, sample, output)
    made = shapley_attribution(model, sample, FEATURES, ["id"], pairs=16, tolerance=0.0, most_rounds=2)
    got = {(r.id, r.feature): r for r in made.collect()}
    assert set(got) == set(want) and {r.pairs for r in got.values()} == {32}
    for r in mean_attribution(made).collect():
        mean = sum(want[i, r.feature] for i in range(20)) / 20
        assert abs(r.mean_contribution - mean) <= 3 * r.standard_error + 1e-9
    inside = sum(abs(got[key].contribution - want[key]) <= 3 * got[key].standard_error + 1e-9 for key in want)
    assert inside >= 0.95 * len(want)


def test_rounds_end_when_the_errors_are_small(spark, points):
    model = fit_model(points, RandomForestClassifier(numTrees=3, maxDepth=3, seed=1), FEATURES)
    sample = points.filter("id < 40")
    rough = shapley_attribution(model, sample, FEATURES, ["id"], pairs=2, tolerance=10.0)
    assert {r.pairs for r in rough.select("pairs").collect()} == {2}
    single = shapley_attribution(model, sample, FEATURES, ["id"], pairs=1, tolerance=10.0, most_rounds=1)
    assert single.filter("standard_error is not null").count() == 0
    again = shapley_attribution(model, sample, FEATURES, ["id"], pairs=2, tolerance=10.0)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rough.collect()))


def test_no_rows_and_no_features(spark, points):
    model = fit_model(points, RandomForestClassifier(numTrees=2, maxDepth=2, seed=1), FEATURES)
    assert shapley_attribution(model, points.filter("id < 0"), FEATURES, ["id"]).count() == 0
    with pytest.raises(ValueError, match="no features"):
        shapley_attribution(model, points, [], ["id"])


def test_fits_see_the_same_partitions_on_every_machine(points):
    for rows, tasks in ((0, 1), (240, 1), (45_000, 4), (10 ** 6, 64), (10 ** 9, 1000)):
        assert spread(points.limit(3), rows).rdd.getNumPartitions() == tasks
    parts = [p for p in spread(points, 45_000).rdd.glom().collect()]
    assert parts == [p for p in spread(points.orderBy(F.desc("id")), 45_000).rdd.glom().collect()]
