"""Attribution of predictions to features on a sample of rows (XAI1, XAI2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.cleaning import col_of
from tablewright.operators.quantiles import with_stats
from tablewright.operators.split import fixed_sample, key_hash
from tablewright.session import staged


def linear_attribution(model: PipelineModel, df: DataFrame, features: Sequence[str],
                       keys: Sequence[str], sample: int = 1000) -> DataFrame:
    """XAI1: coefficient times distance from the sample mean, as (keys, feature, contribution)."""
    weights = model.stages[-1].coefficients.toArray()
    rows = fixed_sample(df, keys, sample)
    means = rows.agg(*[F.avg(col_of(f).cast("double")).alias(f) for f in features])
    cells = [
        F.struct(F.lit(f).alias("feature"),
                 (F.lit(float(w)) * (col_of(f).cast("double") - F.col("__stats").getField(f)))
                 .alias("contribution"))
        for f, w in zip(features, weights)
    ]
    return with_stats(rows, means).select(*[col_of(k) for k in keys], F.inline(F.array(*cells)))


def shapley_attribution(model: PipelineModel, df: DataFrame, features: Sequence[str],
                        keys: Sequence[str], sample: int = 1000, pairs: int = 4, tolerance: float = 0.05,
                        most_rounds: int = 8, seed: int = 42) -> DataFrame:
    """XAI2: Shapley values with their standard errors, by random feature orders in opposite pairs.

    Explained is the margin, the log-odds of class 1, of boosted trees, and the probability of class 1
    of other models. For every pair, a sampled row meets one other sampled row as background. Walking
    along an order, one feature after the other changes from the background's value to the row's;
    the change of the output is that feature's share. The second walk of a pair takes the order
    backwards, which cancels most of the error of the first. All steps are rows of one `transform`.

    A round makes `pairs` pairs for each row. Rounds end when, for every feature, the standard error
    of its mean contribution over the sample is at most `tolerance` times the largest mean absolute
    contribution, or after `most_rounds`. Result: (keys, feature, contribution, standard_error, pairs);
    the error is that of the row's contribution and NULL after a single pair. The shares of a row add
    up to its output less the mean output of its backgrounds.
    """
    names = [col_of(key) for key in keys]
    k = len(features)
    if not k:
        raise ValueError("no features to explain")
    values = F.array(*[F.coalesce(col_of(f).cast("double"), F.lit(0.0)) for f in features])
    picked = fixed_sample(df, keys, sample).select(*names, values.alias("x"), key_hash(keys, seed).alias("h"))
    # The sample is bounded by `sample`, so numbering it in one partition is fine.
    rows = staged(picked.withColumn("row", F.row_number().over(Window.orderBy("h", "x"))), "explained")
    sums = None
    for number in range(most_rounds):
        turns = F.sequence(F.lit(number * pairs + 1), F.lit((number + 1) * pairs))
        made = _pair_shares(model, rows, k, turns, seed).groupBy("row", "j").agg(
            F.sum("share").alias("s"), F.sum(F.col("share") * F.col("share")).alias("q"), F.count("share").alias("n"))
        if sums is not None:
            made = sums.unionByName(made).groupBy("row", "j").agg(
                F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum("n").alias("n"))
        sums = staged(made, "shares")
        if _settled(sums, tolerance):
            break
    label = F.get(F.array(*[F.lit(f) for f in features]), F.col("j")).alias("feature")
    return rows.select("row", *names).join(_estimates(sums), "row").select(
        *names, label, "contribution", "standard_error", F.col("n").alias("pairs"))


def _pair_shares(model: PipelineModel, rows: DataFrame, k: int, turns: Column, seed: int) -> DataFrame:
    """(row, turn, j, share): the mean share of feature j over both walks of a pair."""
    places = F.sequence(F.lit(0), F.lit(k - 1))
    size = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    # by number, not by key: repeated rows take orders and backgrounds of their own
    pick = F.pmod(F.xxhash64("h", "row", "turn", F.lit(seed)), size) + 1
    order = F.transform(F.array_sort(F.transform(places, lambda j: F.struct(
        F.xxhash64(F.col("h"), F.col("row"), F.col("turn"), j, F.lit(seed)).alias("r"), j.alias("j")))),
        lambda s: s.getField("j"))
    walks = rows.select("row", "h", "x", F.explode(turns).alias("turn")).select(
        "row", "turn", "x", pick.cast("int").alias("pick"), order.alias("order"))
    background = rows.select(F.col("row").alias("pick"), F.col("x").alias("z"))
    walks = walks.join(background, "pick").select(
        "row", "turn", "x", "z", F.posexplode(F.array("order", F.reverse("order"))).alias("back", "order"))
    steps = walks.select("*", F.explode(F.sequence(F.lit(0), F.lit(k))).alias("step"))
    changed = F.slice(F.col("order"), F.lit(1), F.col("step"))
    mixed = F.transform(places, lambda j: F.when(
        F.array_contains(changed, j), F.get(F.col("x"), j)).otherwise(F.get(F.col("z"), j)))
    scored = model.stages[-1].transform(steps.withColumn("features", array_to_vector(mixed)))
    # One group holds the k + 1 steps of one walk.
    walked = scored.select("row", "turn", "back", "order", "step", _output(model).alias("p")).groupBy(
        "row", "turn", "back", "order").agg(F.transform(
            F.array_sort(F.collect_list(F.struct("step", "p"))), lambda s: s.getField("p")).alias("p"))
    shares = walked.select("row", "turn", F.inline(F.transform(F.col("order"), lambda j, i: F.struct(
        j.alias("j"), (F.get(F.col("p"), i + 1) - F.get(F.col("p"), i)).alias("share")))))
    return shares.groupBy("row", "turn", "j").agg(F.avg("share").alias("share"))


def _output(model: PipelineModel) -> Column:
    """What is explained. Boosted trees give a margin of half the log-odds."""
    if isinstance(model.stages[-1], GBTClassificationModel):
        return vector_to_array("rawPrediction")[1] * 2
    return vector_to_array("probability")[1]


def _estimates(sums: DataFrame) -> DataFrame:
    mean, n = F.col("s") / F.col("n"), F.col("n")
    variance = F.greatest(F.lit(0.0), F.col("q") / n - mean * mean) / F.nullif(n - 1, F.lit(0))
    return sums.select("row", "j", "n", mean.alias("contribution"), F.sqrt(variance).alias("standard_error"))


def _settled(sums: DataFrame, tolerance: float) -> bool:
    """Whether the error of every feature's mean is small beside the largest mean contribution."""
    means = _estimates(sums).groupBy("j").agg(
        F.avg(F.abs("contribution")).alias("size"),
        (F.sqrt(F.sum(F.col("standard_error") * F.col("standard_error"))) / F.count(F.lit(1))).alias("error"),
        F.count_if(F.col("standard_error").isNull()).alias("single"))
    worst = means.agg(F.max("error").alias("error"), F.max("size").alias("size"), F.sum("single").alias("single")).first()
    return worst.size is None or (not worst.single and worst.error <= tolerance * worst.size)


def mean_attribution(contributions: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature, largest first; with the standard error of the mean
    contribution where the contributions are estimates."""
    errors = []
    if "standard_error" in contributions.columns:
        squares = F.sum(F.col("standard_error") * F.col("standard_error"))
        errors = [(F.sqrt(squares) / F.count(F.lit(1))).alias("standard_error")]
    return contributions.groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("mean_abs_contribution"),
        F.avg("contribution").alias("mean_contribution"), *errors,
    ).orderBy(F.desc("mean_abs_contribution"), "feature")
