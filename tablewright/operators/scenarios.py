"""Hypothetical items to score: input rules, features and reports (FLT10, FE15, SNK10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.cleaning import col_of, money_text
from tablewright.functions.shaping import flag

# Defaults for blank input, bounds, and the words for yes and no.
DEFAULT_NAME = "Projekt_Nieznany"
FLOAT_RULES = {"price": (0.0, None, None), "ratio": (0.8, 0.0, 1.0)}
INT_RULES = {
    "platforms": (1, 1, 3), "genres": (1, 1, 10), "reviews": (100, 0, None),
    "owners": (10000, 0, None),
}
YES_WORDS = ("t", "tak", "y", "yes")
NO_WORDS = ("n", "nie", "no")


def _text(c: str) -> Column:
    """The text without white space of any kind at its ends."""
    return F.regexp_replace(col_of(c).cast("string"), r"(?U)^\s+|\s+$", "")


def _number(c: str, kind: str, rule) -> tuple[Column, Column]:
    """The parsed value and an error text, or NULL when the input is fine."""
    default, lower, upper = rule
    text = _text(c)
    blank = text.isNull() | (text == "")
    if kind == "int":
        digits = F.when(text.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), F.replace(text, F.lit("_"), F.lit("")))
        parsed = digits.try_cast("bigint")
    else:
        parsed = F.when(~text.rlike(r"(?i)[0-9.][df]$|x"), text.try_cast("double"))
        parsed = F.when(~F.isnan(parsed), parsed)
    value = F.when(blank, F.lit(default)).otherwise(parsed)
    error = F.when(value.isNull(), F.lit(f"{c}: not a number"))
    if lower is not None:
        error = error.when(value < F.lit(lower), F.lit(f"{c}: must be >= {lower}"))
    if upper is not None:
        error = error.when(value > F.lit(upper), F.lit(f"{c}: must be <= {upper}"))
    return value, error


def validate_scenarios(df: DataFrame) -> DataFrame:
    """FLT10: parse the text columns of scenarios, fill blanks, check bounds.

    Adds `errors`, empty for a valid scenario. Columns absent from the table count as blank. White
    space of any kind around an input is passed over, and an input of white space alone is blank;
    whole numbers may have single underscores between digits.
    """
    wanted = ["name", *FLOAT_RULES, *INT_RULES, "achievements"]
    df = df.withColumns({c: F.lit(None).cast("string") for c in wanted if c not in df.columns})
    values, errors = {}, []
    for c, rule in FLOAT_RULES.items():
        values[c], error = _number(c, "float", rule)
        errors.append(error)
    for c, rule in INT_RULES.items():
        values[c], error = _number(c, "int", rule)
        errors.append(error)
    word = F.lower(F.coalesce(_text("achievements"), F.lit("")))
    values["achievements"] = F.when(word.isin(*YES_WORDS), True).when(word.isin(*NO_WORDS), False)
    errors.append(F.when(~word.isin(*YES_WORDS, *NO_WORDS), F.lit("achievements: yes or no")))
    name = _text("name")
    values["name"] = F.when(name.isNull() | (name == ""), F.lit(DEFAULT_NAME)).otherwise(name)
    return df.withColumns({**values, "errors": F.array_compact(F.array(*errors))})


def scenario_features(df: DataFrame, as_of: str) -> DataFrame:
    """FE15: validated scenarios to the model's features, as if released on `as_of`."""
    return df.withColumns({
        "Release_year": F.year(F.lit(as_of).cast("date")),
        "Days_since_release": F.lit(0).cast("bigint"),
        "Platform_count": F.col("platforms").cast("int"),
        "Price": F.col("price"),
        "Is_free": flag(F.col("price") == 0),
        "Total_reviews": F.col("reviews"),
        "Review_ratio": F.col("ratio"),
        "Log_owners": F.log1p(F.col("owners").cast("double")),
        "Has_achievements": flag(F.col("achievements")),
        "Log_total_reviews": F.log1p(F.col("reviews").cast("double")),
        "Genre_count": F.col("genres").cast("int"),
    })


def verdict_text(prediction: Column | str) -> Column:
    """SUCCESS for class 1, RISK otherwise."""
    return F.when(col_of(prediction) == 1, "SUCCESS").otherwise("RISK")


def render_report(scored: DataFrame, model_name: str, advice: Sequence[str] = ()) -> DataFrame:
    """SNK10: one Markdown text per scored scenario, in column `report`; `advice` are closing lines."""
    def line(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"| {label} | "), value.cast("string"), F.lit(" |"))

    def yes_no(c: str) -> Column:
        return F.when(col_of(c) == 1, "yes").otherwise("no")

    owners = F.round(F.expm1("Log_owners"), 0).cast("bigint")
    lines = [
        F.concat(F.lit("# Prediction: "), F.col("name")),
        F.lit(""),
        F.lit(f"Model: {model_name}"),
        F.concat(F.lit("Outcome: "), verdict_text("prediction")),
        F.format_string("Chance of success: %.1f%%", "prob_success"),
        F.format_string("Chance of failure: %.1f%%", "prob_fail"),
        F.lit(""),
        F.lit("| Parameter | Value |"),
        F.lit("| --- | --- |"),
        line("Price", money_text("Price")),
        line("Free", yes_no("Is_free")),
        line("Platforms", F.col("Platform_count").cast("bigint")),
        line("Genres", F.col("Genre_count").cast("bigint")),
        line("Achievements", yes_no("Has_achievements")),
        line("Expected reviews", F.col("Total_reviews").cast("bigint")),
        line("Expected positive share", F.format_string("%.0f%%", F.col("Review_ratio") * 100)),
        line("Expected owners", owners),
        *([F.lit("")] if advice else []),
        *[F.lit(f"- {a}") for a in advice],
    ]
    return scored.withColumn("report", F.concat_ws("\n", *lines))
