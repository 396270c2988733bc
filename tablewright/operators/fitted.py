"""Features that need a statistic of the whole table (FLT4, FE12, FE13).

Each has a fit that yields a one-row table and an apply that takes it, so the statistic can come
from the training rows alone and serve new rows or a stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.cleaning import col_of
from tablewright.functions.shaping import flag
from tablewright.operators.quantiles import measure, quantile_row, with_stats


def above_quantile(df: DataFrame, col: str, out: str, prob: float = 0.75,
                   fitted: DataFrame | None = None, mode: str = "exact") -> DataFrame:
    """FLT4: 1 where the value is strictly above the column's own quantile."""
    fitted = quantile_row(df, [col], [prob], mode) if fitted is None else fitted
    return with_stats(df, fitted).withColumn(
        out, flag(measure(df, col) > F.col("__stats").getField(col)[0])).drop("__stats")


def observed_labels(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """The sorted labels of category columns, by one job. Every label becomes a column later, so
    what the driver holds is as wide as the result."""
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), col_of(c).cast("string").alias("label")) for c in cols])))
    found = cells.filter("label is not null").distinct().collect()
    return {c: sorted(r.label for r in found if r.column == c) for c in cols}


def label_columns(col: str, labels: Sequence[str], taken: Sequence[str] = ()) -> dict[str, str]:
    """A column name per label. Column names ignore case, so a label whose name is taken gets the
    next free number behind it."""
    names, used = {}, {t.lower() for t in taken}
    for label in labels:
        name, n = f"{col}_{label}", 2
        while name.lower() in used:
            name, n = f"{col}_{label}_{n}", n + 1
        used.add(name.lower())
        names[label] = name
    return names


def one_hot(df: DataFrame, col: str, labels: Sequence[str] | None = None) -> DataFrame:
    """FE12: a 0/1 column `<col>_<label>` per label; missing gives all zeros.

    Without given labels they come from a job over the column.
    """
    labels = observed_labels(df, [col])[col] if labels is None else labels
    return df.withColumns({name: flag(col_of(col) == F.lit(v)) for v, name in label_columns(col, labels).items()})


def scaling_row(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FE13, fit: one row with mean and population deviation per column, missing counted as 0."""
    return df.agg(*[
        F.struct(F.avg(filled).alias("mean"), F.stddev_pop(filled).alias("std")).alias(c)
        for c, filled in ((c, F.coalesce(measure(df, c), F.lit(0.0))) for c in cols)
    ])


def standardise(df: DataFrame, names: Mapping[str, str] | Sequence[str],
                fitted: DataFrame | None = None) -> DataFrame:
    """FE13: (x - mean) / deviation into new columns; a constant column gives 0.

    `names` maps input to output columns; a plain list means `<col>_normalized`.
    """
    if not isinstance(names, Mapping):
        names = {c: f"{c}_normalized" for c in names}
    fitted = scaling_row(df, list(names)) if fitted is None else fitted
    out = {}
    for c, target in names.items():
        s = F.col("__stats").getField(c)
        divisor = F.when(s.getField("std") == 0, F.lit(1.0)).otherwise(s.getField("std"))
        out[target] = (F.coalesce(measure(df, c), F.lit(0.0)) - s.getField("mean")) / divisor
    return with_stats(df, fitted).withColumns(out).drop("__stats")
