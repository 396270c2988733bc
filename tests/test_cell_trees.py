"""Trees grown over cells against those of `pyspark.ml` over rows."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tablewright.operators import cell_trees, metrics, models

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(7)
    a, b, c = rng.integers(0, 40, 4000) / 2, rng.random(4000), rng.integers(0, 4, 4000)
    y = (a / 20 + b + rng.normal(0, 0.3, 4000) > 1.2).astype(int)
    rows = [(float(i), float(j), float(k), float(z)) for i, j, k, z in zip(a, b, c, y)]
    plain = spark.createDataFrame(rows, "a double, b double, c double, label double")
    return models.staged(models.class_weights(plain), "points")


def nodes(model):
    """Per tree, the nodes in order: cut, prediction, sums and rows. A cut whose gain is no more
    than the rounding of sums counts as none."""
    def walk(n):
        own = [n.prediction(), *n.impurityStats().stats(), n.impurityStats().rawCount()]
        if n.subtreeDepth() == 0 or n.gain() < 1e-12:
            return [(None, own)]
        cut = (n.split().featureIndex(), n.split().threshold(), n.gain(), n.impurity())
        return [(cut, own), *walk(n.leftChild()), *walk(n.rightChild())]
    return [walk(t._java_obj.rootNode()) for t in model.trees]


@pytest.mark.parametrize("own", [{"weightCol": models.WEIGHT, "maxDepth": 5, "minInstancesPerNode": 20}, {"maxDepth": 6}])
def test_boosted_trees_are_those_of_the_library(spark, points, own):
    estimator = GBTClassifier(maxIter=4, stepSize=0.1, seed=42, **own)
    plain = estimator.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(models.spread(points, 4000)))
    over_cells = cell_trees.fit_cells(points, estimator, FEATURES)
    assert over_cells.treeWeights == plain.treeWeights
    for mine, theirs in zip(nodes(over_cells), nodes(plain), strict=True):
        assert len(mine) == len(theirs)
        for (cut, stats), (other, values) in zip(mine, theirs):
            assert (cut is None) == (other is None)
            assert cut is None or cut == pytest.approx(other, rel=1e-6, abs=1e-9)
            assert stats == pytest.approx(values, rel=1e-6, abs=1e-9)


def test_rows_of_one_cell_cost_one_cell(spark, points):
    """Repeated rows, and rows in the same bins, weigh as many times as much and make no further cell."""
    many = points.crossJoin(spark.range(2)).drop("id")
    once, often = (cell_trees.make_cells(d, FEATURES, models.WEIGHT, 32, 42) for d in (points, many))
    assert [list(c) for c in often.cuts] == [list(c) for c in once.cuts]
    assert often.count == once.count <= 32 * 32 * 4 * 2
    rows = lambda c: c.blocks.flatMap(lambda b: [(bytes(x), k, int(n)) for x, k, n in zip(b[0].T, b[1], b[2])]).collect()
    assert sorted((b, k, 2 * n) for b, k, n in rows(once)) == sorted(rows(often))


def area(model, points):
    features = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(points)
    from pyspark.ml.functions import vector_to_array
    return metrics.roc_auc(model.transform(features).withColumn("score", vector_to_array("probability")[1])).first().roc_auc


def test_forest_fits_as_well_as_over_rows(spark, points):
    estimator = RandomForestClassifier(numTrees=12, maxDepth=6, seed=42, weightCol=models.WEIGHT)
    plain = estimator.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(models.spread(points, 4000)))
    over_cells = cell_trees.fit_cells(points, estimator, FEATURES)
    assert over_cells.getNumTrees == 12 and all(t.depth <= 6 for t in over_cells.trees)
    assert area(over_cells, points) == pytest.approx(area(plain, points), abs=0.01)
    assert list(over_cells.featureImportances) == pytest.approx(list(plain.featureImportances), abs=0.06)
    drawn = [tree[0][1][-1] for tree in nodes(over_cells)]
    assert len(set(drawn)) > 1 and np.mean(drawn) == pytest.approx(4000, rel=0.02)
    for tree in nodes(over_cells):
        leaves = [own for cut, own in tree if cut is None]
        assert sum(own[-1] for own in leaves) == tree[0][1][-1]


@pytest.mark.parametrize("block", [100_000, 500])
def test_nodes_above_a_task_are_searched_over_all_blocks(spark, points, monkeypatch, block):
    """With two features every node looks at both, so a forest depends on its draws alone."""
    estimator = RandomForestClassifier(numTrees=3, maxDepth=7, seed=1, weightCol=models.WEIGHT)
    monkeypatch.setattr(cell_trees, "BLOCK_CELLS", block)
    whole = nodes(cell_trees.fit_cells(points, estimator, ["a", "b"]))
    for most in (400, 3):
        monkeypatch.setattr(cell_trees, "LOCAL_CELLS", most)
        parts = nodes(cell_trees.fit_cells(points, estimator, ["a", "b"]))
        for mine, other in zip(parts, whole, strict=True):
            assert [c for c, _ in mine] == [c for c, _ in other]
            assert all(a == pytest.approx(b) for (_, a), (_, b) in zip(mine, other))


def test_large_training_tables_go_through_cells(spark, points, monkeypatch):
    seen = []
    fit = cell_trees.fit_cells
    monkeypatch.setattr(cell_trees, "fit_cells", lambda rows, e, f, made: seen.append(len(made)) or fit(rows, e, f, made))
    monkeypatch.setattr(models, "CELL_ROWS", 4000)
    names = ["logistic_regression", "random_forest", "gradient_boosting"]
    sizes = models.ModelSizes(lr_iterations=5, trees=3, depth=4, rounds=2)
    done = models.train_and_compare(points, points, FEATURES, "label", names, sizes)
    assert seen == [0, 1]  # the second estimator takes the cells of the first
    assert {r.model for r in done.results.filter("roc_auc > 0.8").collect()} == set(names)
    assert models.feature_contract(done.models["random_forest"]) == FEATURES


def test_what_cannot_be_put_into_cells(spark, points):
    other = points.withColumn("label", F.col("label") + 1)
    assert cell_trees.fit_cells(other, GBTClassifier(maxIter=1), FEATURES) is None
    assert cell_trees.fit_cells(points.withColumn("a", F.lit(1.0)), GBTClassifier(maxIter=1), ["a"]) is None
    assert cell_trees.fit_cells(points.withColumn("w", F.lit(0.0)), GBTClassifier(maxIter=1, weightCol="w"), FEATURES) is None
    assert cell_trees.fit_cells(points.limit(0), GBTClassifier(maxIter=1), FEATURES) is None
    assert not cell_trees.fits(GBTClassifier(subsamplingRate=0.5))
    assert not cell_trees.fits(RandomForestClassifier(featureSubsetStrategy="all"))


def test_candidate_cuts():
    assert list(cell_trees.candidate_cuts(np.array([3.0, 1.0, 1.0, 2.0]), np.ones(4), 31)) == [1.5, 2.5]
    assert list(cell_trees.candidate_cuts(np.array([5.0, 5.0]), np.ones(2), 31)) == []
    assert list(cell_trees.candidate_cuts(np.arange(8.0), np.ones(8), 3)) == [1.5, 3.5, 5.5]
    inf = float("inf")
    assert list(cell_trees.candidate_cuts(np.array([inf, -inf]), np.ones(2), 31)) == []
    assert list(cell_trees.candidate_cuts(np.array([-inf, 1.0, inf]), np.ones(3), 31)) == [-inf, inf]
