"""Cleaning of single values (SCL1-SCL19). Every function takes and returns a Column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts a CSV reader takes as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Month abbreviations of the raw date text.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

_DATE_TEXT = rf"(?i)^({'|'.join(MONTHS)})\s+([0-9]{{1,2}}),\s+([0-9]{{4}})$"

#: What is read as a double, in lower case: no hexadecimal text, no 'nan', and a type suffix only where a
#: control character follows.
NUMBER = (r"^[\x00-\x20]*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?([df](?=[\x00-\x20]))?|inf(inity)?)"
          r"[\x00-\x20]*$")


def col_of(c: Column | str) -> Column:
    """A column given by name (any characters allowed) or as an expression."""
    return F.col("`" + c.replace("`", "``") + "`") if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    """NaN means missing; Spark would treat it as the largest number."""
    c = col_of(c)
    return F.when(~F.isnan(c), c)


def normalize_missing(c: Column | str, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    """Texts that stand for a missing value become NULL, as after a CSV round trip."""
    c = col_of(c)
    return F.when(~c.isin(*tokens), c)


def to_number(c: Column | str) -> Column:
    """SCL1: text to double; what is not a plain number becomes NULL.

    Java also reads a type suffix ('1.0d') and hexadecimal floats, which are not numbers here. As in
    Java, control characters around a number do not count.
    """
    text = F.lower(F.trim(col_of(c).cast("string")))
    # Only texts that parse are parsed: a failed cast costs an exception, some 16 microseconds.
    return nan_to_null(F.when(text.rlike(NUMBER), text.try_cast("double")))


def fill(c: Column | str, value) -> Column:
    """SCL2: a constant for missing values."""
    return F.coalesce(col_of(c), F.lit(value))


def clip(c: Column | str, lower=None, upper=None) -> Column:
    """SCL3, SCL4: limit to [lower, upper]; missing stays missing."""
    c = col_of(c)
    out = c
    if upper is not None:
        out = F.when(c > F.lit(upper), F.lit(upper)).otherwise(out)
    if lower is not None:
        out = F.when(c < F.lit(lower), F.lit(lower)).otherwise(out)
    return out


def round_places(c: Column | str, places: int = 2) -> Column:
    """SCL5: scale, round half to even, scale back. `F.round` differs on ties (0.125, 1.005)."""
    scale = float(10**places)
    return F.rint(col_of(c) * scale) / scale


def truncate(c: Column | str) -> Column:
    """SCL6: to a long, toward zero; values outside the long range become NULL."""
    return col_of(c).try_cast("bigint")


def parse_month_date(c: Column | str) -> Column:
    """SCL7: 'Oct 21, 2008' to a date; any other text becomes NULL.

    A pattern and an ISO cast, so that no time parser policy of the session can make it raise.
    """
    text = col_of(c)
    month = F.array_position(
        F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.regexp_extract(text, _DATE_TEXT, 1))
    )
    iso = F.concat_ws(
        "-",
        F.regexp_extract(text, _DATE_TEXT, 3),
        F.lpad(month.cast("string"), 2, "0"),
        F.lpad(F.regexp_extract(text, _DATE_TEXT, 2), 2, "0"),
    )
    return F.when(text.rlike(_DATE_TEXT), iso.try_cast("date"))


def parse_iso_date(c: Column | str) -> Column:
    """SCL8: ISO text to a date; missing stays missing, anything else fails the query."""
    c = col_of(c)
    bad = F.raise_error(F.concat(F.lit("not an ISO date: "), c.cast("string"))).cast("date")
    return F.coalesce(c.try_cast("date"), F.when(c.isNotNull(), bad))


def presence_flag(c: Column | str, mode: str = "presence") -> Column:
    """SCL9: true where a value is given.

    Mode 'presence' looks only at whether the cell is filled, so the text 'False' counts as
    present. Mode 'value' reads the cell as a boolean instead.
    """
    c = col_of(c)
    if mode == "presence":
        return c.isNotNull()
    if mode == "value":
        return F.coalesce(c.cast("string").try_cast("boolean"), F.lit(False))
    raise ValueError(f"unknown mode {mode!r}")


def safe_ratio(part: Column | str, rest: Column | str) -> Column:
    """SCL10: part / (part + rest); missing when the total is not positive."""
    part, rest = col_of(part), col_of(rest)
    total = part + rest
    return F.when(total > 0, part.cast("double") / total)


def trim_text(c: Column | str) -> Column:
    """SCL11: missing text becomes '', then all Unicode blanks at both ends go."""
    return F.regexp_replace(fill(c, ""), r"(?U)^\s+|\s+$", "")


def clean_price(c: Column | str) -> Column:
    """SCL12: to number, missing or negative to 0, two places."""
    return round_places(clip(fill(to_number(c), 0.0), lower=0.0))


def clean_score(c: Column | str, upper: float | None = None) -> Column:
    """SCL13: to number, limited to 0..upper, missing kept."""
    return clip(to_number(c), lower=0.0, upper=upper)


def clean_count(c: Column | str) -> Column:
    """SCL14, SCL15: to number, missing to 0, truncated, not negative. '0 - 20000' becomes 0."""
    return clip(fill(truncate(to_number(c)), 0), lower=0).cast("bigint")


def safe_identifier(c: Column | str) -> Column:
    """SCL16: letters, digits and blanks only, no blank at the end, inner blanks to '_'."""
    kept = F.regexp_replace(col_of(c), r"[^\p{L}\p{N} ]", "")
    return F.replace(F.rtrim(kept), F.lit(" "), F.lit("_"))


def percent_text(c: Column | str, places: int = 2) -> Column:
    """SCL17: a number as 'x.xx%'."""
    return F.format_string(f"%.{places}f%%", col_of(c).cast("double"))


def money_text(c: Column | str) -> Column:
    """SCL17: a number as '$x.xx'."""
    return F.format_string("$%.2f", col_of(c).cast("double"))
