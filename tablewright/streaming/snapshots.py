"""Landed snapshots as a stream through the row-wise plans.

Only work that needs one row at a time runs here; statistics come fitted from a batch table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablewright.operators.models import model_input, predict
from tablewright.operators.projection import normalize_table
from tablewright.plans.cleaning import clean_rows
from tablewright.plans.engineering import fitted_features, row_features


def snapshot_stream(spark: SparkSession, path: str, schema: T.StructType,
                    files_per_trigger: int = 1000) -> DataFrame:
    """New files under a snapshot folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def feature_stream(rows: DataFrame, as_of: str, statistics: DataFrame,
                   labels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Clean and engineer raw rows with statistics fitted on a batch table."""
    featured = row_features(normalize_table(clean_rows(rows)), as_of)
    return fitted_features(featured, statistics, labels)


def scored_stream(features: DataFrame, model: PipelineModel, columns: Sequence[str]) -> DataFrame:
    """Score engineered rows with a fitted model."""
    return predict(model, model_input(features, columns))
