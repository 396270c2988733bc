"""Rule checks, the quality score and the validation report (FLT5, QLT1, QLT2)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.cleaning import col_of
from tablewright.operators.dedup import duplicate_counts
from tablewright.operators.outliers import fences_of, iqr_outliers
from tablewright.operators.profile import (
    MEDIAN, QUARTILES, kind_counts, long_rows, missing_rows, missing_summary, missing_totals, moment_rows, report_of,
    row_sql, totals_of, value_counts,
)
from tablewright.operators.projection import numeric_columns
from tablewright.operators.quantiles import (
    all_wishes, as_scalar, measure_sql, quantile_sql, search_quantiles, sql_double, sql_name, sql_text,
)
from tablewright.session import staged


@dataclass(frozen=True)
class RangeRule:
    """Allowed range of a column; an open end is None."""

    column: str
    lower: float | None = None
    upper: float | None = None

    @property
    def text(self) -> str:
        if self.upper is None:
            return f"{self.column} >= {self.lower:g}"
        if self.lower is None:
            return f"{self.column} <= {self.upper:g}"
        return f"{self.lower:g} <= {self.column} <= {self.upper:g}"


@dataclass(frozen=True)
class ValidationConfig:
    """What to check: key, range rules, columns for moments and categories."""

    key: Sequence[str]
    rules: Sequence[RangeRule] = ()
    moments: Sequence[str] = ()
    categories: Sequence[str] = ()
    outlier_columns: Sequence[str] | None = None
    outlier_k: float = 1.5
    range_penalty: str = "checks"
    quantile_mode: str = "exact"
    exclude: Iterable[str] = field(default_factory=tuple)


def range_check(df: DataFrame, rules: Sequence[RangeRule]) -> DataFrame:
    """FLT5: per rule the rows outside it and the column's range. Rules on absent columns go."""
    rows = range_rows(df, rules)
    if not rows:
        return df.sparkSession.createDataFrame(
            [], "column string, check string, invalid_count bigint, min double, max double")
    return long_rows(df, rows)


def range_rows(df: DataFrame, rules: Sequence[RangeRule]) -> list[str]:
    rows = []
    for rule in rules:
        if rule.column not in df.columns:
            continue
        m = measure_sql(df, rule.column)
        broken = []
        if rule.lower is not None:
            broken.append(f"{m} < {sql_double(float(rule.lower))}")
        if rule.upper is not None:
            broken.append(f"{m} > {sql_double(float(rule.upper))}")
        rows.append(row_sql(
            column=sql_text(rule.column), check=sql_text(rule.text),
            invalid_count=f"count_if({' OR '.join(broken) or 'false'})",
            min=f"min({m})", max=f"max({m})"))
    return rows


def quality_score(df: DataFrame, config: ValidationConfig) -> DataFrame:
    """QLT1: one row: score out of 100, the penalties behind it and the list of issues.

    The range penalty counts the checks made ('checks') or the rows that break one
    ('violations').
    """
    return score_from(
        missing_summary(df), duplicate_counts(df, config.key),
        iqr_outliers(df, _outlier_columns(df, config), config.outlier_k, mode=config.quantile_mode),
        range_check(df, config.rules), config)


def _outlier_columns(df: DataFrame, config: ValidationConfig) -> list[str]:
    return list(config.outlier_columns or numeric_columns(df, config.exclude))


def score_from(missing: DataFrame, duplicates: DataFrame, outliers: DataFrame, ranges: DataFrame,
               config: ValidationConfig) -> DataFrame:
    """QLT1 from the reports it rests on."""
    spark = missing.sparkSession
    missing, duplicates = as_scalar(missing), as_scalar(duplicates)
    outliers = as_scalar(outliers.agg(F.coalesce(F.sum("outlier_pct"), F.lit(0.0)).alias("pct")))
    ranges = as_scalar(ranges.agg(F.count(F.lit(1)).alias("checks"),
                                  F.coalesce(F.sum("invalid_count"), F.lit(0)).alias("violations")))
    term = ranges.getField(config.range_penalty)

    facts = spark.range(1).select(
        F.coalesce(missing.getField("missing_cell_pct"), F.lit(0.0)).alias("missing_pct"),
        duplicates.getField("surplus_rows").alias("key_duplicates"),
        outliers.getField("pct").alias("outlier_pct"),
        term.cast("bigint").alias("range_term"))
    scored = facts.withColumns({
        "missing_penalty": F.least(F.lit(10.0), F.col("missing_pct")),
        "duplicate_penalty": F.when(F.col("key_duplicates") > 0, 5.0).otherwise(0.0),
        "outlier_penalty": F.least(F.lit(10.0), F.col("outlier_pct") / 10),
        "range_penalty": F.least(F.lit(5.0), F.col("range_term").cast("double")),
    })
    issue = F.array_compact(F.array(
        F.when(F.col("missing_pct") > 0,
               F.format_string("missing values: %.1f%%", "missing_pct")),
        F.when(F.col("key_duplicates") > 0, F.lit("duplicate keys")),
        F.when(F.col("outlier_pct") > 0, F.format_string("outliers: %.1f%%", "outlier_pct")),
        F.when(F.col("range_term") > 0, F.format_string("range checks: %d", "range_term")),
    ))
    score = (F.lit(100.0) - F.col("missing_penalty") - F.col("duplicate_penalty")
             - F.col("outlier_penalty") - F.col("range_penalty"))
    return scored.select(
        F.greatest(F.lit(0.0), score).alias("score"), F.lit(100.0).alias("max_score"),
        "missing_penalty", "duplicate_penalty", "outlier_penalty", "range_penalty",
        issue.alias("issues"))


def _tidy(table: DataFrame, check: str, name: str, metrics: Sequence[str]) -> DataFrame:
    rows = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
            for m in metrics]
    return table.select(F.lit(check).alias("check"), F.col(name).alias("column"),
                        F.inline(F.array(*rows)))


def validation_report(df: DataFrame, config: ValidationConfig) -> DataFrame:
    """QLT2: every check in one long table (check, column, metric, value)."""
    whole = F.lit("*").alias("column")
    cols = _outlier_columns(df, config)
    moments = [c for c in config.moments if c in df.columns]
    found = None
    if config.quantile_mode == "exact":  # one search for the fences and the medians
        found = search_quantiles(df, all_wishes(dict.fromkeys(cols, QUARTILES), dict.fromkeys(moments, MEDIAN)))
    quartiles = quantile_sql(df, cols, QUARTILES, config.quantile_mode, found=found)
    reports = {"missing": missing_rows(df)}
    if range_rows(df, config.rules):
        reports["ranges"] = range_rows(df, config.rules)
    if config.moments:
        reports["moments"] = moment_rows(df, moments, config.quantile_mode, found)
    # One pass for all that needs the rows once, after the search; the outliers need the quartiles.
    facts = staged(df.selectExpr(
        *[f"array({', '.join(rows)}) AS {name}" for name, rows in reports.items()],
        *[f"{q} AS {sql_name('__q_' + c)}" for c, q in quartiles.items()]), "facts")
    missing = report_of(facts, "missing")
    ranges = report_of(facts, "ranges") if "ranges" in reports else range_check(df, ())
    fitted = fences_of(facts.select(*[col_of(f"__q_{c}").alias(c) for c in cols]), cols,
                       config.outlier_k)
    outliers = staged(iqr_outliers(df, cols, fitted=fitted), "outliers")
    keys = staged(duplicate_counts(df, config.key), "keys")
    quality = score_from(missing_totals(missing), keys, outliers, ranges, config)
    parts = [
        _tidy(missing.filter("missing_count > 0"), "missing", "column",
              ["missing_count", "missing_pct"]),
        _tidy(missing_totals(missing).select("*", whole), "missing", "column",
              ["missing_cells", "columns_affected", "missing_cell_pct"]),
        _tidy(keys.select("*", whole), "key_duplicates", "column", ["surplus_rows"]),
        _tidy(duplicate_counts(df).select("*", whole), "row_duplicates", "column",
              ["member_rows"]),
        _tidy(kind_counts(df), "types", "kind", ["n_columns"]),
        _tidy(outliers, "outliers", "column",
              ["outlier_count", "outlier_pct", "lower_bound", "upper_bound"]),
        _tidy(ranges, "range", "column", ["invalid_count", "min", "max"]),
        _tidy(quality.select("*", whole), "quality", "column", ["score", "max_score"]),
    ]
    if config.moments:
        parts.append(_tidy(report_of(facts, "moments"), "distribution", "column",
                           ["mean", "median", "std", "min", "max", "skewness", "kurtosis"]))
    if config.categories:
        shares = staged(value_counts(df, config.categories), "shares")
        parts.append(_tidy(totals_of(shares), "categories", "column", ["unique_values", "total"]))
        labelled = shares.withColumn("label", F.concat_ws("=", "column", "category"))
        parts.append(_tidy(labelled, "coverage", "label", ["n", "percentage"]))
    return reduce(DataFrame.unionByName, parts)


def report_documents(report: DataFrame) -> DataFrame:
    """SNK5: the long report as one nested document per check and column."""
    entries = F.array_sort(F.collect_list(F.struct("metric", "value")))
    return report.groupBy("check", "column").agg(F.map_from_entries(entries).alias("metrics"))
