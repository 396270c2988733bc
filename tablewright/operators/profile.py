"""Profiles of whole tables (AGG1-AGG12, HIS1-HIS3, SNK7).

One wide aggregate serves all columns and is then laid out in long form from its single row, so
neither the number of jobs nor the rows shuffled grow with the number of columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.cleaning import col_of, to_number
from tablewright.operators.dedup import distinct_counts
from tablewright.operators.projection import column_kind, numeric_columns
from tablewright.operators.quantiles import (
    Found, measure, measure_sql, quantile_sql, sql_name, sql_text, with_stats,
)

#: What reports want of a column.
MEDIAN, QUARTILES = (0.5,), (0.25, 0.5, 0.75)


def missing_sql(df: DataFrame, name: str) -> str:
    """NULL, or NaN in a floating column, as SQL text."""
    c = sql_name(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return f"({c} IS NULL OR isnan({c}))"
    return f"({c} IS NULL)"


def is_missing(df: DataFrame, name: str) -> Column:
    """The same as a Column."""
    return F.expr(missing_sql(df, name))


def row_sql(**fields: str) -> str:
    """A struct of SQL expressions by field name."""
    return f"named_struct({', '.join(f'{sql_text(k)}, {v}' for k, v in fields.items())})"


def long_rows(df: DataFrame, rows: Sequence[str]) -> DataFrame:
    """Aggregate the table once and lay the given structs out as rows."""
    return df.selectExpr(f"array({', '.join(rows)}) AS r").selectExpr("inline(r)")


def one_pass(df: DataFrame, reports: Mapping[str, Sequence[str]]) -> DataFrame:
    """Several reports from one aggregate: one row with one array of structs per report."""
    return df.selectExpr(*[f"array({', '.join(rows)}) AS {name}" for name, rows in reports.items()])


def report_of(facts: DataFrame, name: str) -> DataFrame:
    """One report out of a `one_pass` row."""
    return facts.selectExpr(f"inline({name})")


def percent_sql(part: str, whole: str = "count(1)") -> str:
    return f"try_divide({part} * double('100'), {whole})"


def shape(df: DataFrame) -> DataFrame:
    """AGG1: rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).cast("bigint").alias("n_columns"))


def missing_rows(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    rows = []
    for c in cols or df.columns:
        n = f"count_if({missing_sql(df, c)})"
        rows.append(row_sql(column=sql_text(c), missing_count=n, missing_pct=percent_sql(n)))
    return rows


def missing_by_column(df: DataFrame, cols: Sequence[str] | None = None,
                      only_affected: bool = False) -> DataFrame:
    """AGG2, AGG12, FLT8: missing cells per column, count and percent of rows."""
    out = long_rows(df, missing_rows(df, cols))
    return out.filter("missing_count > 0") if only_affected else out


def missing_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AGG3: missing cells, columns that have any, and percent of all cells; one row."""
    return missing_totals(missing_by_column(df, cols))


def missing_totals(cells: DataFrame) -> DataFrame:
    """AGG3 from the rows of `missing_by_column`."""
    return cells.agg(
        F.sum("missing_count").alias("missing_cells"),
        F.count_if(F.col("missing_count") > 0).alias("columns_affected"),
        F.avg("missing_pct").alias("missing_cell_pct"),
    )


def profile_rows(df: DataFrame, cols: Sequence[str], order_by: Sequence[str]) -> list[str]:
    order = f"struct({', '.join(sql_name(c) for c in order_by)})"
    types = dict(df.dtypes)
    rows = []
    for c in cols:
        known = c in types
        numeric = known and isinstance(df.schema[c].dataType, T.NumericType)
        n = f"count_if({missing_sql(df, c)})" if known else "CAST(NULL AS BIGINT)"
        text = "CAST(NULL AS STRING)"
        if known and not numeric:
            text = f"min_by(string({sql_name(c)}), CASE WHEN {sql_name(c)} IS NOT NULL THEN {order} END)"
        rows.append(row_sql(
            column=sql_text(c), exists=str(known).lower(),
            data_type=sql_text(types[c]) if known else "CAST(NULL AS STRING)",
            missing_count=n, missing_pct=percent_sql(n),
            sample_mean=f"avg({measure_sql(df, c)})" if numeric else "CAST(NULL AS DOUBLE)",
            sample_text=text))
    return rows


def column_profile(df: DataFrame, cols: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """AGG4: per listed column its type, missing cells and a sample value.

    The sample is the mean of a numeric column, else the first value in the given order.
    A listed column the table lacks yields a row with exists = false.
    """
    return long_rows(df, profile_rows(df, cols, order_by))


def summary_rows(df: DataFrame, price: str, flags: Sequence[str] = (), scores: Sequence[str] = (),
                 texts: Sequence[str] = (), found: Found | None = None) -> list[str]:
    median = quantile_sql(df, [price], MEDIAN, found=found)[price]
    p = measure_sql(df, price)
    missing = {c: f"count_if({missing_sql(df, c)})" for c in [price, *flags, *scores, *texts]}
    found = [
        (price, "missing", missing[price]),
        (price, "zero", f"count_if({p} = 0)"),
        (price, "min", f"min({p})"),
        (price, "max", f"max({p})"),
        (price, "mean", f"avg({p})"),
        (price, "median", f"{median}[0]"),
    ]
    for c in flags:
        present = f"(count(1) - {missing[c]})"
        found += [(c, "present", present), (c, "present_pct", percent_sql(present))]
    for c in scores:
        mean = f"avg({measure_sql(df, c)})"
        found += [(c, "missing", missing[c]), (c, "mean", mean)]
    found += [(c, "missing", missing[c]) for c in texts]
    rows = [row_sql(column=sql_text(c), metric=sql_text(m), value=f"double({v})")
            for c, m, v in found]
    return rows


def targeted_summary(df: DataFrame, key: str, price: str, flags: Sequence[str] = (),
                     scores: Sequence[str] = (), texts: Sequence[str] = ()) -> DataFrame:
    """AGG5: the figures an analyst looks at first, as (column, metric, value)."""
    scored = df.withColumns({c: to_number(c) for c in scores})
    return key_counts(df, key).unionByName(
        long_rows(scored, summary_rows(scored, price, flags, scores, texts)))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """AGG5: distinct values of the key, missing ones not counted, and its surplus rows."""
    n = F.col("n")
    return df.groupBy(col_of(key)).agg(F.count(F.lit(1)).alias("n")).agg(F.array(
        F.struct(F.lit(key).alias("column"), F.lit("unique").alias("metric"),
                 F.count(col_of(key)).cast("double").alias("value")),
        F.struct(F.lit(key).alias("column"), F.lit("duplicates").alias("metric"),
                 F.coalesce(F.sum(n - 1), F.lit(0)).cast("double").alias("value")),
    ).alias("r")).select(F.inline("r"))


def describe_rows(df: DataFrame, cols: Sequence[str], mode: str = "exact",
                  found: Found | None = None) -> list[str]:
    quartiles = quantile_sql(df, cols, QUARTILES, mode, found=found)
    rows = []
    for c in cols:
        m, q = measure_sql(df, c), quartiles[c]
        rows.append(row_sql(
            column=sql_text(c), n=f"count({m})", mean=f"avg({m})", std=f"stddev_samp({m})",
            min=f"min({m})", q25=f"{q}[0]", q50=f"{q}[1]", q75=f"{q}[2]", max=f"max({m})"))
    return rows


def numeric_describe(df: DataFrame, cols: Sequence[str] | None = None,
                     mode: str = "exact") -> DataFrame:
    """AGG6: count, mean, sample deviation, minimum, quartiles and maximum per column."""
    return long_rows(df, describe_rows(df, list(cols or numeric_columns(df)), mode))


def value_range(df: DataFrame, c: str) -> DataFrame:
    """AGG11: smallest and largest value of a column."""
    return df.agg(F.min(col_of(c)).alias("min_value"), F.max(col_of(c)).alias("max_value"))


def sample_skewness_sql(m: str) -> str:
    """Bias-corrected skewness (T2): NULL below 3 values, 0 for a constant column."""
    n = f"double(count({m}))"
    return (f"CASE WHEN count({m}) >= 3 THEN try_divide("
            f"coalesce(skewness({m}), double('0')) * sqrt({n} * ({n} - 1)), {n} - 2) END")


def sample_kurtosis_sql(m: str) -> str:
    """Bias-corrected excess kurtosis (T2): NULL below 4 values, 0 for a constant column."""
    n = f"double(count({m}))"
    return (f"CASE WHEN count({m}) >= 4 THEN coalesce(try_divide(({n} - 1) * (({n} + 1) * "
            f"kurtosis({m}) + 6), ({n} - 2) * ({n} - 3)), double('0')) END")


def moment_rows(df: DataFrame, cols: Sequence[str], mode: str = "exact",
                found: Found | None = None) -> list[str]:
    medians = quantile_sql(df, cols, MEDIAN, mode, found=found)
    rows = []
    for c in cols:
        m = measure_sql(df, c)
        rows.append(row_sql(
            column=sql_text(c), mean=f"avg({m})", median=f"{medians[c]}[0]",
            std=f"stddev_samp({m})", min=f"min({m})", max=f"max({m})",
            skewness=sample_skewness_sql(m), kurtosis=sample_kurtosis_sql(m)))
    return rows


def distribution_moments(df: DataFrame, cols: Sequence[str], mode: str = "exact",
                         skew_limit: float = 2.0) -> DataFrame:
    """AGG7: mean, median, deviation, range, skewness and kurtosis; flags a high skew."""
    return long_rows(df, moment_rows(df, cols, mode)).withColumn(
        "high_skew", F.coalesce(F.abs("skewness") > F.lit(skew_limit), F.lit(False)))


def kind_counts(df: DataFrame) -> DataFrame:
    """AGG8: number of columns per class, from the schema alone."""
    kinds = [column_kind(f.dataType) for f in df.schema]
    rows = [row_sql(kind=sql_text(k), n_columns=f"{kinds.count(k)}L")
            for k in ("numeric", "text", "datetime", "boolean")]
    return df.sparkSession.range(1).selectExpr(f"inline(array({', '.join(rows)}))")


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG9: rows per category and their percent of the rows that have one."""
    present = df.agg(*[F.count(col_of(c)).alias(c) for c in cols])
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), col_of(c).cast("string").alias("category"))
        for c in cols
    ]))).filter("category is not null")
    counts = cells.groupBy("column", "category").agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(*[F.when(F.col("column") == c, F.col("__stats").getField(c)) for c in cols])
    return with_stats(counts, present).select(
        "column", "category", "n",
        F.try_divide(F.col("n") * F.lit(100.0), total).alias("percentage"))


def category_totals(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG9: categories and rows with one, per column."""
    return totals_of(value_counts(df, cols))


def totals_of(counts: DataFrame) -> DataFrame:
    """AGG9 from the rows of `value_counts`."""
    return counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("unique_values"), F.sum("n").alias("total"))


def observe_flags(df: DataFrame, name: str, sums: Iterable[str] = (),
                  means: Iterable[str] = ()) -> tuple[DataFrame, Observation]:
    """AGG10: sums of flags and means of measures, collected while another job runs the rows."""
    seen = Observation(name)
    exprs = [F.sum(col_of(c).cast("bigint")).alias(f"sum_{c}") for c in sums]
    exprs += [F.avg(col_of(c).cast("double")).alias(f"mean_{c}") for c in means]
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *exprs), seen


def top_rows(df: DataFrame, largest: Sequence[str], n: int, ties: Sequence[str] = ()) -> DataFrame:
    """SRT3: the n rows with the largest values, equal ones by the columns `ties` upwards, then by all
    others, so that the choice is repeatable; NULL and NaN values rank last. Each task keeps n rows."""
    down = [F.desc_nulls_last(F.when(~is_missing(df, c), col_of(c))) for c in largest]
    rest = [c for c in df.columns if c not in (*largest, *ties) and not dict(df.dtypes)[c].startswith("map")]
    return df.orderBy(*down, *[col_of(c) for c in (*ties, *rest)]).limit(n)


def drop_missing(df: DataFrame, col: str, name: str = "drop_missing") -> tuple[DataFrame, Observation]:
    """FLT1: the rows that have a value; `removed` is counted while they are read."""
    seen = Observation(name)
    gone = F.count_if(is_missing(df, col))
    watched = df.observe(seen, gone.alias("removed"), F.count(F.lit(1)).alias("n_rows"))
    return watched.filter(~is_missing(df, col)), seen


def describe_columns(df: DataFrame, descriptions: Mapping[str, str] | None = None,
                     mode: str = "exact") -> DataFrame:
    """SNK7: the documentation table: name, type, description, missing and distinct values.

    One aggregate counts missing cells, `distinct_counts` the values: two scans, and of the values
    only digests are shuffled."""
    notes = descriptions or {}
    rows = [row_sql(column_name=sql_text(name), data_type=sql_text(data_type),
                    description=sql_text(notes.get(name, "")), missing_count=f"count_if({missing_sql(df, name)})")
            for name, data_type in df.dtypes]
    counts = distinct_counts(df, mode=mode).withColumnRenamed("column", "column_name")
    return long_rows(df, rows).join(counts, "column_name", "left").withColumn(
        "unique_values", F.coalesce("unique_values", F.lit(0)).cast("bigint"))


def _bin_limits(df: DataFrame, cols: Sequence[str], bins: int) -> DataFrame:
    """One row: per column its bins' start and width, and what a density needs besides."""
    structs = []
    for c in cols:
        m = measure_sql(df, c)
        structs.append(row_sql(a=f"min({m})", b=f"max({m})", n=f"count({m})",
                               std=f"stddev_samp({m})") + f" AS {sql_name(c)}")
    return df.selectExpr(*structs).select(*[_bin_frame(col_of(c), bins).alias(c) for c in cols])


def _bin_counts(df: DataFrame, cols: Sequence[str], bins: int) -> DataFrame:
    """Rows per column and bin, and the column's frame; every bin is there."""
    limits = _bin_limits(df, cols, bins)
    stats = F.col("__stats")
    counts = with_stats(df, limits).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), _bin_index(measure(df, c), stats.getField(c), bins)
                 .alias("bin")) for c in cols
    ]))).filter("bin is not null").groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))
    frame = limits.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), col_of(c).alias("f")) for c in cols
    ]))).filter("f.low is not null").select(
        "column", "f", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return frame.join(F.broadcast(counts), ["column", "bin"], "left")


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 30) -> DataFrame:
    """HIS1, HIS2: equal-width bins over each column's range; the last bin is closed.

    A constant column gets a range of one around its value. Empty bins are rows with n = 0.
    """
    i = F.col("bin")
    return _bin_counts(df, cols, bins).select(
        "column", "bin",
        (F.col("f.low") + i * F.col("f.width")).alias("bin_start"),
        (F.col("f.low") + (i + 1) * F.col("f.width")).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"))


def _bin_frame(limits: Column, bins: int) -> Column:
    a, b = limits.getField("a"), limits.getField("b")
    low = F.when(a == b, a - 0.5).otherwise(a)
    high = F.when(a == b, b + 0.5).otherwise(b)
    return F.struct(low.alias("low"), ((high - low) / F.lit(float(bins))).alias("width"),
                    a.alias("first"), b.alias("last"), limits.getField("n").alias("total"),
                    limits.getField("std").alias("std"))


def _bin_index(x: Column, frame: Column, bins: int) -> Column:
    """The bin by division, then moved by one where rounding put it beyond its own edge."""
    low, width = frame.getField("low"), frame.getField("width")
    guess = F.least(F.floor((x - low) / width), F.lit(bins - 1)).cast("int")
    # `least` passes over NULL, so a missing value is settled first.
    return (F.when(x.isNull(), F.lit(None)).when(x < low + guess * width, guess - 1)
            .when((guess < bins - 1) & (x >= low + (guess + 1) * width), guess + 1)
            .otherwise(guess))


def density(df: DataFrame, cols: Sequence[str], points: int = 200, fine: int = 1024) -> DataFrame:
    """HIS3: a Gaussian density curve over each column's range.

    The kernels sit on the centres of fine bins, whose number is fixed, so the sum does not grow
    with the table. Bandwidth: sample deviation times n^(-1/5).
    """
    f = F.col("f")
    width = f.getField("std") * F.pow(f.getField("total").cast("double"), F.lit(-0.2))
    grid = _bin_counts(df, cols, fine).select(
        "column", "n", (f.getField("low") + (F.col("bin") + 0.5) * f.getField("width")).alias("centre"),
        F.when(width > 0, width).alias("h"), f.getField("total").alias("total"),
        f.getField("first").alias("first"), f.getField("last").alias("last"),
        F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    x = F.col("first") + F.col("point") * (F.col("last") - F.col("first")) / (points - 1)
    z = (x - F.col("centre")) / F.col("h")
    kernel = F.col("n") * F.exp(-z * z / 2) / (F.col("total") * F.col("h") * F.sqrt(2 * F.pi()))
    return grid.groupBy("column", "point").agg(F.first(x).alias("x"), F.sum(kernel).alias("density"))
