"""Metrics of binary classifiers (MET1-MET7).

Curve metrics first collapse the rows to distinct scores, so a score shared by many rows is one
row after a partial aggregate, and then use running sums over ordered buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.cleaning import col_of
from tablewright.operators.ordered import BUCKET, order_buckets, running_sums


def _ratio(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """MET3: rows per (label, prediction), all four cells present."""
    y, p = col_of(label).cast("int"), col_of(prediction).cast("int")
    cells = [
        F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"),
                 F.count_if((y == a) & (p == b)).alias("n"))
        for a in (0, 1) for b in (0, 1)
    ]
    return df.agg(F.array(*cells).alias("r")).select(F.inline("r"))


def _cells(df, label, prediction):
    y, p = col_of(label).cast("int"), col_of(prediction).cast("int")
    return df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """MET1, MET2: accuracy, precision, recall and F1 of class 1; 0 where undefined."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return _cells(df, label, prediction).select(
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"))


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """MET4: precision, recall, F1 and support per class, and their averages, in long form.

    The row 'accuracy' carries the accuracy in all three measures.
    """
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def measures(hit, wrong, missed):
        return F.struct(_ratio(hit, hit + wrong).alias("precision"),
                        _ratio(hit, hit + missed).alias("recall"),
                        _ratio(2 * hit, 2 * hit + wrong + missed).alias("f1_score"),
                        (hit + missed).alias("support"))

    c = _cells(df, label, prediction).select(
        measures(tn, fn, fp).alias("zero"), measures(tp, fp, fn).alias("one"),
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        (tp + fp + fn + tn).alias("total"))
    names = ("precision", "recall", "f1_score")

    def row(name, value, support):
        return F.struct(F.lit(name).alias("class"), *[value(m).alias(m) for m in names],
                        support.alias("support"))

    zero, one = F.col("zero"), F.col("one")
    return c.select(F.inline(F.array(
        row("0", zero.getField, zero.getField("support")),
        row("1", one.getField, one.getField("support")),
        row("accuracy", lambda m: F.col("accuracy"), F.col("total")),
        row("macro avg", lambda m: (zero.getField(m) + one.getField(m)) / 2, F.col("total")),
        row("weighted avg", lambda m: _ratio(
            zero.getField(m) * zero.getField("support") + one.getField(m) * one.getField("support"),
            F.col("total")), F.col("total")),
    )))


def score_levels(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row per distinct score with its positives and negatives."""
    y = col_of(label).cast("int")
    return df.groupBy(col_of(score).cast("double").alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))


def curve_levels(df: DataFrame, label: str = "label", score: str = "score",
                 buckets: int | None = None) -> DataFrame:
    """Distinct scores with `tp` and `fp`: positives and negatives at this score or above."""
    levels = score_levels(df, label, score).withColumn("minus", -F.col("score"))
    return running_sums(order_buckets(levels, "minus", buckets), [F.col("minus")],
                        {"tp": F.col("pos"), "fp": F.col("neg")})


def _totals(df, label):
    y = col_of(label).cast("int")
    return df.agg(F.count_if(y == 1).cast("double").alias("p"),
                  F.count_if(y == 0).cast("double").alias("n")).select(F.struct("p", "n")).scalar()


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", **how) -> DataFrame:
    """MET5: area under the ROC curve, ties counted half; NULL when one class is absent."""
    levels = curve_levels(df, label, score, **how)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    return levels.agg(
        F.sum(pos).alias("p"), F.sum(neg).alias("n"),
        # A negative loses to every positive above it and half of those at its own score.
        F.sum(neg * (F.col("tp") - pos / 2)).alias("won"),
    ).select(F.try_divide(F.col("won"), F.col("p") * F.col("n")).alias("roc_auc"))


def pr_auc(df: DataFrame, label: str = "label", score: str = "score", **how) -> DataFrame:
    """MET7: area under precision over recall by trapezoids, starting at recall 0, precision 1."""
    points = pr_points(df, label, score, **how)
    return points.agg(F.sum((F.col("recall") - F.col("prev_recall"))
                            * (F.col("precision") + F.col("prev_precision")) / 2).alias("pr_auc"))


def pr_points(df: DataFrame, label: str = "label", score: str = "score", **how) -> DataFrame:
    """MET7: precision and recall per threshold, each with the point before it."""
    levels = curve_levels(df, label, score, **how)
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    p = _totals(df, label).getField("p")
    before = (tp - pos) + (fp - neg)
    return levels.select(
        F.col("score").alias("threshold"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, p).alias("recall"),
        F.when(before == 0, F.lit(1.0)).otherwise(F.try_divide(tp - pos, before)).alias("prev_precision"),
        F.try_divide(tp - pos, p).alias("prev_recall"))


def roc_points(df: DataFrame, label: str = "label", score: str = "score",
               drop_collinear: bool = True, **how) -> DataFrame:
    """MET6: false and true positive rate per threshold, from (0, 0) at an infinite threshold.

    Points whose step equals the next step lie on a straight line and are dropped by default.
    """
    levels = curve_levels(df, label, score, **how)
    totals = _totals(df, label)
    if drop_collinear:
        levels = _with_next_step(levels).filter(
            "next_pos is null or next_pos <> pos or next_neg <> neg")
    rows = levels.select("score", "tp", "fp")
    start = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("score"), F.lit(0).cast("bigint").alias("tp"),
        F.lit(0).cast("bigint").alias("fp"))
    return start.unionByName(rows).select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp").cast("double"), totals.getField("n")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), totals.getField("p")).alias("tpr"))


def _with_next_step(levels: DataFrame) -> DataFrame:
    """The counts of the next lower score, looked up across the bucket border where needed."""
    step = F.struct("pos", "neg")
    inside = Window.partitionBy(BUCKET).orderBy("minus")
    heads = levels.groupBy(BUCKET).agg(F.min_by(step, "minus").alias("head"))
    heads = heads.select(BUCKET, F.lead("head").over(Window.orderBy(BUCKET)).alias("beyond"))
    joined = levels.withColumn("near", F.lead(step).over(inside)).join(F.broadcast(heads), BUCKET)
    following = F.coalesce("near", "beyond")
    return joined.withColumns({"next_pos": following.getField("pos"),
                               "next_neg": following.getField("neg")})
