"""Row-wise features (FE1-FE11, FE14, FLT2, FLT3, FLT9). Column in, Column out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.functions.cleaning import col_of


def flag(predicate: Column) -> Column:
    """FLT3: a predicate as 0/1; a comparison with a missing value is 0."""
    return F.coalesce(predicate, F.lit(False)).cast("int")


def threshold_label(ratio: Column | str, total: Column | str,
                    min_ratio: float = 0.80, min_total: float = 30) -> Column:
    """FLT2: 1 when both the ratio and the total reach their thresholds."""
    return flag((col_of(ratio) >= F.lit(min_ratio)) & (col_of(total) >= F.lit(min_total)))


def age_days(c: Column | str, as_of: Column | str) -> Column:
    """FE2: whole days from the date to `as_of` (an ISO date or an expression)."""
    day = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return F.datediff(day, col_of(c)).cast("bigint")


def bin_numeric(c: Column | str, edges: Sequence[float], labels: Sequence[str],
                missing_label: str | None = "Unknown") -> Column:
    """FE6: right-closed bins; the lowest edge belongs to the first bin.

    Values outside the edges and missing values get `missing_label`.
    """
    if len(edges) != len(labels) + 1 or list(edges) != sorted(set(edges)):
        raise ValueError("edges must ascend and be one more than the labels")
    c = col_of(c)
    out = F.when(c.isNull() | (c < F.lit(float(edges[0]))), F.lit(missing_label))
    for edge, label in zip(edges[1:], labels):
        out = out.when(c <= F.lit(float(edge)), F.lit(label))
    return out.otherwise(F.lit(missing_label))


def list_length(c: Column | str, separator: str = ",") -> Column:
    """FE9: entries of a delimited text; a missing or empty text has none."""
    c = col_of(c)
    gaps = F.octet_length(c) - F.octet_length(F.replace(c, F.lit(separator), F.lit("")))
    count = (gaps / F.lit(len(separator.encode()))).cast("int") + 1
    return F.when(c.isNull() | (c == ""), F.lit(0)).otherwise(count)


def paid_log(price: Column | str) -> Column:
    """FLT9: log1p of positive prices, else 0."""
    price = col_of(price)
    return F.when(price > 0, F.log1p(price)).otherwise(F.lit(0.0))


def ratio_of(numerator: Column | str, denominator: Column | str) -> Column:
    """FE14: division that yields NULL for a zero divisor in either ANSI mode."""
    return F.try_divide(col_of(numerator), col_of(denominator))
