"""Scoring hypothetical items with a stored model (SRC6, FLT10, FE15, PRJ6, MDL10, SNK10).

The stored model is the only thing loaded: its stages fill missing values, know the features and
their order, and score. Every step works on single rows, so the plan serves batches and streams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.cleaning import safe_identifier
from tablewright.operators.fitted import label_columns
from tablewright.operators.models import feature_contract, load_model, score_scenarios
from tablewright.operators.quantiles import sql_double, sql_name, sql_text
from tablewright.operators.scenarios import render_report, scenario_features, validate_scenarios
from tablewright.plans import catalogue as cat
from tablewright.sources import writers

RESULT = ["prediction", "score", "prob_success", "prob_fail", "verdict", "report"]


def statistics_stage(statistics: DataFrame, labels: dict[str, Sequence[str]]) -> Transformer:
    """`plans.engineering.fitted_features` as a stage that is stored with a model: the one row of
    statistics and the labels become constants of its statement."""
    row = statistics.first()
    made = {"Is_heavily_reviewed": f"int(coalesce(Total_reviews > {sql_double(row['__heavy'])}, false))"}
    for c in cat.CATEGORIES:
        for label, name in label_columns(c, labels[c]).items():
            made[name] = f"int(coalesce({sql_name(c)} = {sql_text(label)}, false))"
    for c, target in cat.SCALED.items():
        mean, std = row[c]
        made[target] = (f"(coalesce(nullif(CAST({sql_name(c)} AS DOUBLE), double('NaN')), 0D) - {sql_double(mean)})"
                        f" / {sql_double(std or 1.0)}")
    columns = ", ".join(f"{v} AS {sql_name(k)}" for k, v in made.items())
    return SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")


def model_name(model: PipelineModel) -> str:
    """The kind of a stored model in words."""
    kind = type(model.stages[-1]).__name__
    return {"LogisticRegressionModel": "logistic_regression", "RandomForestClassificationModel": "random_forest",
            "GBTClassificationModel": "gradient_boosting"}.get(kind, kind)


def score_plan(scenarios: DataFrame, model: PipelineModel, as_of: str, keep: Sequence[str] = (),
               advice: Sequence[str] = ()) -> DataFrame:
    """One row per scenario: the columns `keep`, name, errors (empty if it could be scored), prediction,
    score, both probabilities in percent, verdict and report. A scenario that breaks an input rule has
    none of the latter. Scenarios lacking a feature get 0 for it."""
    checked = validate_scenarios(scenarios)
    ready = scenario_features(checked, as_of)
    held = [c for c in keep if c != "name"]
    scored = score_scenarios(model, ready, feature_contract(model), [*held, "name", "errors"])
    reported = render_report(scored, model_name(model), advice)
    fine = F.size("errors") == 0
    return reported.select(*held, "name", "errors", *[F.when(fine, F.col(c)).alias(c) for c in RESULT])


def run_scoring(spark: SparkSession, model_path: str, scenarios: DataFrame, as_of: str, out_dir: str,
                keep: Sequence[str] = (), advice: Sequence[str] = ()) -> DataFrame:
    """Load the model, score, and leave `scored` (Parquet) and `reports` (a folder of Markdown per safe
    name) under `out_dir`; an absent model raises. Returns the scored table as it was written."""
    scored = score_plan(scenarios, load_model(model_path), as_of, keep, advice)
    root = out_dir.rstrip("/")
    writers.write_parquet(scored, f"{root}/scored")
    written = spark.read.parquet(f"{root}/scored")
    reports = written.filter("report IS NOT NULL").withColumn("scenario", safe_identifier("name"))
    writers.write_text(reports, f"{root}/reports", "report", "scenario")
    return written
