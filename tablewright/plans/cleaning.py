"""From the raw catalogue table to the cleaned one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tablewright.functions.cleaning import (
    clean_count, clean_price, clean_score, col_of, parse_month_date, presence_flag, safe_ratio,
    trim_text,
)
from tablewright.operators.dedup import keep_first
from tablewright.operators.profile import missing_by_column
from tablewright.operators.projection import select_strict
from tablewright.plans import catalogue as cat
from tablewright.sources.readers import ROW_ORDER


def clean_rows(df: DataFrame, platform_mode: str = "presence") -> DataFrame:
    """The row-wise part: all casts and limits in one projection, rows without a date dropped."""
    cleaned = {
        "AppID": col_of("AppID").try_cast("bigint"),
        "Price": clean_price("Price"),
        "Release date": parse_month_date("Release date"),
        "Metacritic score": clean_score("Metacritic score", 100.0),
        "User score": clean_score("User score", 10.0),
        "Score rank": clean_score("Score rank"),
    }
    cleaned |= {c: presence_flag(c, platform_mode) for c in cat.PLATFORMS}
    cleaned |= {c: clean_count(c) for c in ("Positive", "Negative", "Achievements",
                                            "Estimated owners")}
    cleaned |= {c: trim_text(c) for c in cat.TEXTS}
    out = df.select(*[cleaned[c].alias(c) if c in cleaned else col_of(c) for c in df.columns])
    return out.filter(col_of("Release date").isNotNull()).withColumn(
        "Review_ratio", safe_ratio("Positive", "Negative"))


def clean_catalogue(raw: DataFrame, order_by: Sequence[str] = (ROW_ORDER,),
                    platform_mode: str = "presence") -> DataFrame:
    """Select, keep the first row of each key in the order of `order_by`, clean.

    Rows without a valid date go after the deduplication: a key whose first copy has a bad date
    disappears.
    """
    extra = [c for c in order_by if c not in cat.RAW_COLUMNS]
    selected = select_strict(raw, [*cat.RAW_COLUMNS, *extra])
    return clean_rows(keep_first(selected, list(cat.KEY), order_by).drop(*extra), platform_mode)


def post_clean_check(cleaned: DataFrame) -> DataFrame:
    """AGG12: the columns that still have missing values."""
    return missing_by_column(cleaned, only_affected=True)
