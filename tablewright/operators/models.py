"""Binary classifiers on `pyspark.ml` (MDL1-MDL12)."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.cleaning import col_of
from tablewright.operators import cell_trees
from tablewright.operators.metrics import binary_metrics, roc_auc
from tablewright.operators.projection import align_columns, drop_present, numeric_columns
from tablewright.operators.quantiles import sql_name, with_stats
from tablewright.operators.scenarios import verdict_text
from tablewright.session import ensure_checkpoint_dir, scratch_path, staged

WEIGHT = "class_weight"
#: Training rows from which trees are grown over cells of equal bins (`cell_trees`).
CELL_ROWS = 500_000


def feature_columns(df: DataFrame, label: str, drop: Sequence[str] = ()) -> list[str]:
    """MDL1: the numeric columns left after dropping ids, texts and the label."""
    return numeric_columns(drop_present(df, [*drop, label]))


def model_input(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    """MDL1: features as double with missing values as 0, and the label."""
    filled = {c: F.nanvl(F.coalesce(col_of(c).cast("double"), F.lit(0.0)), F.lit(0.0))
              for c in features}
    if label is not None:
        filled["label"] = col_of(label).cast("double")
    return df.withColumns(filled)


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """MDL2: add the balanced weight n / (2 * rows of the class)."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(col_of(label) == 1).alias("one"))
    s = F.col("__stats")
    own = F.when(col_of(label) == 1, s.getField("one")).otherwise(s.getField("n") - s.getField("one"))
    return with_stats(df, counts).withColumn(
        WEIGHT, F.try_divide(s.getField("n").cast("double"), own * F.lit(2))).drop("__stats")


@dataclass(frozen=True)
class ModelSizes:
    """Training effort. The defaults are the full setting."""

    lr_iterations: int = 1000
    trees: int = 100
    depth: int = 15
    rounds: int = 100
    step: float = 0.1
    boosted_depth: int = 5
    boosted_leaf_rows: int = 20
    plain_boosted_depth: int = 6
    seed: int = 42


def define_models(train_rows: int, sizes: ModelSizes = ModelSizes()) -> dict[str, object]:
    """MDL3-MDL6: the estimators by name.

    An L2 strength of C = 1 on summed losses is regParam = 1 / rows here, as the loss is averaged
    by weight and balanced weights add up to the rows. Weighted boosting grows trees of at most 32
    leaves of 20 rows or more; the unweighted fallback grows them to depth 6 without that bound.
    """
    common = {"featuresCol": "features", "labelCol": "label"}
    forest = RandomForestClassifier(numTrees=sizes.trees, maxDepth=sizes.depth, seed=sizes.seed,
                                    weightCol=WEIGHT, cacheNodeIds=False, **common)
    boosted = {"maxIter": sizes.rounds, "stepSize": sizes.step, "seed": sizes.seed, **common}
    return {
        "logistic_regression": LogisticRegression(
            maxIter=sizes.lr_iterations, regParam=1.0 / max(train_rows, 1), elasticNetParam=0.0,
            standardization=False, weightCol=WEIGHT, **common),
        "random_forest": forest,
        "gradient_boosting": GBTClassifier(
            weightCol=WEIGHT, maxDepth=sizes.boosted_depth, minInstancesPerNode=sizes.boosted_leaf_rows, **boosted),
        "gradient_boosting_unweighted": GBTClassifier(maxDepth=sizes.plain_boosted_depth, **boosted),
    }


def _training_columns(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    return model_input(df, features, label).select(*[col_of(f) for f in features], "label")


def spread(df: DataFrame, rows: int) -> DataFrame:
    """The rows in partitions by hash, and in order within each, so that fits draw the same samples on
    every machine. Their number depends on the rows alone: up to 64 of at least 10,000 rows, and
    beyond 64 million rows one per million."""
    columns = [col_of(c) for c in df.columns]
    tasks = max(1, min(64, rows // 10_000), -(-rows // 1_000_000))
    return df.repartition(tasks, *columns).sortWithinPartitions(*columns)


def input_stage(features: Sequence[str]) -> SQLTransformer:
    """`model_input` as a stage that is stored with a model."""
    names = [sql_name(f) for f in features]
    filled = [f"nanvl(coalesce(CAST({n} AS DOUBLE), 0D), 0D) AS {n}" for n in names]
    return SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(names)}), {', '.join(filled)} FROM __THIS__")


def feature_contract(model: PipelineModel) -> list[str]:
    """The features a stored model wants, in its order."""
    found = [s for s in model.stages if isinstance(s, VectorAssembler)]
    if not found:
        raise ValueError("the model has no stage that assembles features")
    return found[-1].getInputCols()


def fit_model(train: DataFrame, estimator, features: Sequence[str],
              before: Sequence[Transformer] = ()) -> PipelineModel:
    """Fit one estimator on a table made by `model_input` and `class_weights`.

    The model holds all that scoring needs: the stages `before`, the filling of missing values, the
    list and order of the features.

    A fitted model may carry its training summary and with it the session, which cannot be sent
    to the executors once the session has observed a query. Storing and loading it drops both.
    """
    ensure_checkpoint_dir(train.sparkSession)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    model = Pipeline(stages=[*before, input_stage(features), assembler, estimator]).fit(train)
    if getattr(model.stages[-1], "hasSummary", False):
        path = scratch_path(train.sparkSession, "model")
        save_model(model, path)
        model = load_model(path)
    return model


def fit_large(train: DataFrame, estimator, features: Sequence[str], made: dict) -> PipelineModel | None:
    """As `fit_model`, with trees grown over cells; None where that cannot be done. `made` keeps the cells
    for further estimators over the same rows."""
    grown = cell_trees.fit_cells(train, estimator, features, made) if cell_trees.fits(estimator) else None
    if grown is None:
        return None
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return PipelineModel([input_stage(features), assembler, grown])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """MDL9: add `prediction` and `score`, the probability of class 1."""
    scored = model.transform(df).withColumn("score", vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction", "probability")


@dataclass
class Training:
    """Fitted models, their metrics and the name of the best one."""

    models: dict[str, PipelineModel]
    results: DataFrame
    best: str

    @property
    def best_model(self) -> PipelineModel:
        return self.models[self.best]


RESULT_SCHEMA = ("model string, rank int, accuracy double, precision double, recall double, "
                 "f1_score double, roc_auc double, training_time_seconds double")


def train_and_compare(train: DataFrame, select_on: DataFrame, features: Sequence[str], label: str,
                      names: Sequence[str] | None = None, sizes: ModelSizes = ModelSizes(),
                      define: Callable[..., Mapping] = define_models) -> Training:
    """MDL7, MDL8: fit every model on `train`, measure all on `select_on`, keep the best ROC-AUC.

    Choosing on the validation rows leaves the test rows unseen; pass the test rows instead to
    choose the way a two-way split does. The first of equal models wins. From CELL_ROWS training rows on
    trees are grown over cells.
    """
    # The fits read their rows many times: from written tables, not through the plans above them.
    stored = class_weights(staged(_training_columns(train, features, label), "train"))
    rows = stored.count()
    ready = spread(stored, rows)
    held = staged(_training_columns(select_on, features, label), "held")
    estimators = define(rows, sizes)
    models, measured, cells = {}, [], {}
    for rank, name in enumerate(names or ["logistic_regression", "random_forest",
                                          "gradient_boosting"]):
        started = time.monotonic()
        grown = fit_large(stored, estimators[name], features, cells) if rows >= CELL_ROWS else None
        models[name] = grown or fit_model(ready, estimators[name], features)
        seconds = time.monotonic() - started
        scored = staged(predict(models[name], held).select("label", "prediction", "score"), "scored")
        figures = binary_metrics(scored).first()
        auc = roc_auc(scored).first().roc_auc
        measured.append((name, rank, *figures, auc, seconds))
    cell_trees.drop_cells(cells)
    results = train.sparkSession.createDataFrame(measured, RESULT_SCHEMA)
    return Training(models, results, best_of(results))


def best_of(results: DataFrame) -> str:
    """SRT5, MDL8: the model with the highest ROC-AUC, the first of equal ones."""
    return best_row(results, "model", ["roc_auc"], ["rank"]).first().model


def best_row(df: DataFrame, label: str, largest: Sequence[str], smallest: Sequence[str] = ()) -> DataFrame:
    """SRT5: one row: the label with the largest value of the first of the columns `largest`, and that
    value; ties go to the further ones, then to the least of `smallest`. Each task hands on one row.
    NULL figures lose; an empty table gives NULL."""
    first = col_of(largest[0])
    order = F.struct(*[col_of(c) for c in largest], *[-col_of(c) for c in smallest])
    return df.agg(F.max_by(col_of(label), order).alias(label), F.max(first).alias(largest[0]))


def importances(model: PipelineModel, features: Sequence[str], spark: SparkSession,
                top: int | None = None) -> DataFrame:
    """MDL11, MDL12, SRT4: weight per feature, largest first: tree importance or |coefficient|."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        weights = last.featureImportances.toArray()
    else:
        weights = abs(last.coefficients.toArray())
    table = spark.createDataFrame(
        [(f, float(w)) for f, w in zip(features, weights)], "feature string, importance double")
    ordered = table.orderBy(F.desc("importance"), "feature")
    return ordered.limit(top) if top else ordered


def score_scenarios(model: PipelineModel, scenarios: DataFrame, features: Sequence[str] | None = None,
                    keep: Sequence[str] = ("name",)) -> DataFrame:
    """MDL10: score any number of feature rows: class, both probabilities in percent, verdict.

    Features are those the model was stored with, unless given; those the scenarios lack are 0.
    """
    features = feature_contract(model) if features is None else features
    kept = [c for c in keep if c in scenarios.columns and c not in features]
    aligned = align_columns(scenarios, [*kept, *features])
    return predict(model, model_input(aligned, features)).select(
        "*", (F.col("score") * 100).alias("prob_success"),
        ((1 - F.col("score")) * 100).alias("prob_fail"),
        verdict_text("prediction").alias("verdict"))


def save_model(model: PipelineModel, path: str) -> None:
    """SNK11: write a model, replacing an older one."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """SRC6: read a model; an absent one raises."""
    return PipelineModel.load(path)
