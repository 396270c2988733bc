"""Quantile sketches that merge, and searches that are shared."""

import random

import numpy as np
import pytest
from scans import scans_of

from tablewright.operators import profile, quality, quantiles, sketches
from tablewright.plans import pipeline
from tablewright.sources.readers import read_sketches
from tablewright.sources.writers import land_snapshot


def values(kind, n, seed):
    rng = random.Random(seed)
    return {"even": lambda: rng.random(), "tail": lambda: rng.paretovariate(0.8), "few": lambda: float(rng.randint(0, 3)),
            "third": lambda: 5.0 if rng.random() < 0.34 else rng.gauss(5, 9)}[kind]


@pytest.mark.parametrize("kind", ["even", "tail", "few", "third"])
def test_merged_sketches_hold_the_ranks(spark, tmp_path, kind):
    draw, drops = values(kind, 0, 3), []
    for i, n in enumerate((9000, 40, 3000)):
        drops.append([draw() for _ in range(n)])
        df = spark.createDataFrame([(v, None) for v in drops[-1]] + [(None, None), (float("nan"), None)], "x double, e double")
        land_snapshot(df.repartition(3), f"{tmp_path}", f"d{i}", sketch=["x", "e"])
    probs = [0, 0.01, 0.25, 0.5, 0.75, 0.999, 1]
    merged = read_sketches(spark, f"{tmp_path}", ["d0", "d1", "d2"])
    whole = np.sort(np.concatenate(drops))
    for r in sketches.sketch_quantiles(merged, {"x": probs, "e": [0.5]}).collect():
        assert r.column == "x"
        at = r.share * (len(whole) - 1)
        assert r.low <= whole[int(np.floor(at))] and whole[int(np.ceil(at))] <= r.high
        assert np.searchsorted(whole, r.high) - np.searchsorted(whole, r.low, "right") < 4 * sketches.RANK_BOUND * len(whole) + 4
    table = spark.read.parquet(f"{tmp_path}")
    kept = sketches.search_starts(merged, {"x": probs, "e": [0.5]})
    found, seen = scans_of(spark, tmp_path, lambda: quantiles.search_quantiles(table, {"x": probs, "e": [0.5]}, starts=kept))
    assert [found["x", p] for p in probs] == pytest.approx(list(np.quantile(whole, probs)), rel=1e-12)
    assert found["e", 0.5] is None
    plain, scans = scans_of(spark, tmp_path, lambda: quantiles.search_quantiles(table, {"x": probs, "e": [0.5]}))
    assert plain == found and seen == scans - 1


def test_a_bracket_that_misses_is_widened(spark):
    df = spark.range(5000).selectExpr("double(id) AS x")
    start = {"x": quantiles.ColumnStart(5000, 0.0, 4999.0, {0.5: (10.0, 20.0), 0.9: (4600.0, 4700.0)})}
    got = quantiles.search_quantiles(df, {"x": [0.5, 0.9]}, 64, start)
    assert got == {("x", 0.5): 2499.5, ("x", 0.9): pytest.approx(4499.1)}


def test_a_sketch_must_be_there(spark):
    with pytest.raises(KeyError, match="no sketch of y"):
        sketches.search_starts(sketches.column_sketches(spark.range(3), ["id"]), {"y": [0.5]})


def test_one_search_a_step(spark, monkeypatch):
    searches = []

    def counted(df, wishes, *rest, **more):
        searches.append(wishes)
        return quantiles.search_quantiles(df, wishes, *rest, **more)

    for module in (pipeline, quality):
        monkeypatch.setattr(module, "search_quantiles", counted)
    monkeypatch.setattr(quantiles, "exact_quantiles", None)
    df = spark.range(200).selectExpr("id AS k", "double(id * id) AS a", "IF(id % 3 = 0, NULL, id / 7) AS b")
    config = quality.ValidationConfig(key=["k"], moments=["a", "b"], exclude=["k"])
    report = quality.validation_report(df, config).collect()
    assert len(searches) == 1 and searches[0] == {"a": [0.25, 0.5, 0.75], "b": [0.25, 0.5, 0.75]}
    medians = {r.column: r.value for r in report if r.check == "distribution" and r.metric == "median"}
    assert medians == {c: quantiles.search_quantiles(df, {c: [0.5]})[c, 0.5] for c in "ab"}
    described = {r.column: r.q50 for r in profile.numeric_describe(df, ["a", "b"]).collect()}
    assert described == medians
