"""From the cleaned catalogue table to the engineered and the final one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.cleaning import col_of, fill
from tablewright.functions.shaping import (
    age_days, bin_numeric, flag, list_length, paid_log, ratio_of, threshold_label,
)
from tablewright.operators.fitted import observed_labels, one_hot, scaling_row, standardise
from tablewright.operators.profile import is_missing
from tablewright.operators.projection import normalize_table, select_lenient
from tablewright.operators.quantiles import quantile_row, with_stats
from tablewright.plans import catalogue as cat


def row_features(df: DataFrame, as_of: str, missing_label: str = "Unknown") -> DataFrame:
    """The features that need only their own row (FE1-FE3, FE5-FE11, most of FE4).

    `missing_label` names the bin of a missing or out-of-range value; 'nan' gives the label the
    text form of such a value would have.
    """
    released = col_of("Release date")
    platforms = [col_of(c).cast("int") for c in cat.PLATFORMS]
    base = df.withColumns({
        "Release_year": F.year(released),
        "Release_month": F.month(released),
        "Release_quarter": F.quarter(released),
        "Days_since_release": age_days(released, as_of),
        "Platform_count": platforms[0] + platforms[1] + platforms[2],
        "Has_windows": platforms[0],
        "Has_mac": platforms[1],
        "Has_linux": platforms[2],
        "Total_reviews": F.col("Positive") + F.col("Negative"),
        "Review_ratio": fill("Review_ratio", 0.5),
        "Has_metacritic": flag(~is_missing(df, "Metacritic score")),
        "Metacritic_category": bin_numeric("Metacritic score", cat.SCORE_EDGES, cat.SCORE_LABELS,
                                           missing_label),
        "User_score_normalized": col_of("User score") / 10.0,
        "Log_achievements": F.log1p(F.col("Achievements").cast("double")),
        "Has_achievements": flag(F.col("Achievements") > 0),
        "Log_owners": F.log1p(col_of("Estimated owners").cast("double")),
        "Genre_count": list_length("Genres"),
        "Category_count": list_length("Categories"),
        "Is_free": flag(F.col("Price") == 0),
        "Price_category": bin_numeric("Price", cat.PRICE_EDGES, cat.PRICE_LABELS, missing_label),
        "Log_price": paid_log("Price"),
    })
    return base.withColumns({
        "Is_recent": flag(F.col("Days_since_release") < 365),
        "Is_multiplatform": flag(F.col("Platform_count") > 1),
        "Log_total_reviews": F.log1p(F.col("Total_reviews").cast("double")),
        "Is_highly_rated": threshold_label("Review_ratio", "Total_reviews"),
        "Price_Rating_ratio": ratio_of("Price", col_of("Metacritic score") + 1),
        "Rating_Review_score": col_of("Metacritic score") / 100 * F.col("Review_ratio"),
        "Owners_Review_ratio": F.col("Log_owners") * F.col("Review_ratio"),
    })


def fit_statistics(featured: DataFrame, mode: str = "exact") -> DataFrame:
    """One row with what the fitted features need: a quantile and the scales."""
    heavy = quantile_row(featured, ["Total_reviews"], [0.75], mode).scalar()
    scales = scaling_row(featured, list(cat.SCALED))
    return scales.withColumn("__heavy", heavy[0])


def fitted_features(featured: DataFrame, statistics: DataFrame,
                    labels: Mapping[str, Sequence[str]]) -> DataFrame:
    """The heavy-review flag, the one-hot columns and the z-scores from fitted statistics."""
    out = with_stats(featured, statistics.select("__heavy"), "__heavy_stat").withColumn(
        "Is_heavily_reviewed", flag(F.col("Total_reviews") > F.col("__heavy_stat.__heavy"))
    ).drop("__heavy_stat")
    for c in cat.CATEGORIES:
        out = one_hot(out, c, labels[c])
    return standardise(out, cat.SCALED, statistics.select(*[col_of(c) for c in cat.SCALED]))


def engineer_features(cleaned: DataFrame, as_of: str, fit_on: DataFrame | None = None,
                      missing_label: str = "Unknown", mode: str = "exact") -> DataFrame:
    """All features. Statistics and labels come from `fit_on`, by default from all rows."""
    featured = row_features(normalize_table(cleaned), as_of, missing_label)
    source = featured if fit_on is None else row_features(
        normalize_table(fit_on), as_of, missing_label)
    labels = observed_labels(source, cat.CATEGORIES)
    return fitted_features(featured, fit_statistics(source, mode), labels)


def final_table(engineered: DataFrame) -> DataFrame:
    """The columns kept for modelling."""
    return select_lenient(engineered, cat.FINAL_COLUMNS)
