"""Queries for metrics, models, attribution and scenarios."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import explain, metrics, models, scenarios
from tablewright.operators.fitted import above_quantile
from tablewright.operators.split import hash_split
from tablewright.plans import catalogue as cat
from tablewright.plans import scoring
from tablewright.plans.engineering import engineer_features, final_table
from tablewright.queries.base import query, rounded, rounded_sql, table
from tablewright.queries.features import AS_OF, cleaned_catalogue
from tablewright.session import scratch_path, staged

LINES_SCORED = """(SELECT (l_returnflag = 'A')::INTEGER AS label, l_discount * 10 AS score,
    (l_quantity > 25)::INTEGER AS prediction FROM lineitem)"""


def scored_lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "A").cast("int").alias("label"),
        (F.col("l_discount") * 10).alias("score"),
        (F.col("l_quantity") > 25).cast("int").alias("prediction"))


@query("confusion", f"""
    SELECT a::INTEGER AS label, b::INTEGER AS prediction, count(s.label) AS n
    FROM range(2) x(a) CROSS JOIN range(2) y(b)
    LEFT JOIN {LINES_SCORED} s ON s.label = a AND s.prediction = b GROUP BY a, b""")
def confusion(spark, sf):
    return metrics.confusion_matrix(scored_lines(spark, sf))


CELLS = f"""SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1)::DOUBLE AS tp,
    count(*) FILTER (WHERE label = 0 AND prediction = 1)::DOUBLE AS fp,
    count(*) FILTER (WHERE label = 1 AND prediction = 0)::DOUBLE AS fn,
    count(*) FILTER (WHERE label = 0 AND prediction = 0)::DOUBLE AS tn FROM {LINES_SCORED}"""


@query("binary_metrics", rounded_sql(f"""
    SELECT (tp + tn) / (tp + fp + fn + tn) AS accuracy, tp / (tp + fp) AS precision,
        tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1_score FROM ({CELLS})""",
    ["accuracy", "precision", "recall", "f1_score"]))
def binary_metrics(spark, sf):
    return rounded(metrics.binary_metrics(scored_lines(spark, sf)))


@query("class_report", rounded_sql(f"""
    WITH c AS ({CELLS}),
    r AS (SELECT '0' AS "class", tn / (tn + fn) AS precision, tn / (tn + fp) AS recall,
            2 * tn / (2 * tn + fn + fp) AS f1_score, (tn + fp) AS support FROM c
        UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM c)
    SELECT "class", precision, recall, f1_score, support::BIGINT AS support FROM r
    UNION ALL SELECT 'accuracy', a, a, a, n::BIGINT FROM (
        SELECT (tp + tn) / (tp + fp + fn + tn) AS a, tp + fp + fn + tn AS n FROM c)
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support)::BIGINT FROM r
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
        sum(recall * support) / sum(support), sum(f1_score * support) / sum(support),
        sum(support)::BIGINT FROM r""", ["precision", "recall", "f1_score"]))
def class_report(spark, sf):
    return rounded(metrics.class_report(scored_lines(spark, sf)))


LEVELS = f"""SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
        sum(pos) OVER () AS p, sum(neg) OVER () AS n,
        lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg
    FROM (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM {{source}} GROUP BY score)
    WINDOW w AS (ORDER BY score DESC)"""
LINE_LEVELS = LEVELS.format(source=LINES_SCORED)
# Scores with as many levels as rows: the part keys hashed into [0, 1).
PART_SCORED = """(SELECT (p_size > 25)::INTEGER AS label, p_retailprice / 3 + p_size AS score FROM part)"""
PART_LEVELS = LEVELS.format(source=PART_SCORED)


def scored_parts(spark, sf):
    return table(spark, sf, "part").select(
        (F.col("p_size") > 25).cast("int").alias("label"),
        (F.col("p_retailprice") / 3 + F.col("p_size")).alias("score"))


def _auc_sql(levels: str) -> str:
    return f"SELECT sum(neg * (tp - pos / 2)) / (max(p)::DOUBLE * max(n)) AS roc_auc FROM ({levels})"


@query("roc_auc", rounded_sql(_auc_sql(LINE_LEVELS), ["roc_auc"]))
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(scored_lines(spark, sf)))


@query("roc_auc_bucketed", rounded_sql(_auc_sql(PART_LEVELS), ["roc_auc"]))
def roc_auc_bucketed(spark, sf):
    """Many distinct scores: running sums over several ordered buckets."""
    return rounded(metrics.roc_auc(scored_parts(spark, sf), buckets=16))


def _roc_sql(levels: str) -> str:
    return f"""SELECT 'Infinity'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
    UNION ALL SELECT score, fp::DOUBLE / n, tp::DOUBLE / p FROM ({levels})
    WHERE next_pos IS NULL OR next_pos <> pos OR next_neg <> neg"""


@query("roc_points", rounded_sql(_roc_sql(LINE_LEVELS), ["fpr", "tpr"]))
def roc_points(spark, sf):
    points = metrics.roc_points(scored_lines(spark, sf))
    return points.withColumns({c: F.round(c, 6) for c in ("fpr", "tpr")})


@query("roc_points_bucketed", rounded_sql(_roc_sql(PART_LEVELS), ["fpr", "tpr"]))
def roc_points_bucketed(spark, sf):
    points = metrics.roc_points(scored_parts(spark, sf), buckets=16)
    return points.withColumns({c: F.round(c, 6) for c in ("fpr", "tpr")})


_PR_POINTS = f"""SELECT score AS threshold, tp::DOUBLE / (tp + fp) AS precision, tp::DOUBLE / p AS recall,
    CASE WHEN tp - pos + fp - neg = 0 THEN 1.0 ELSE (tp - pos)::DOUBLE / (tp - pos + fp - neg) END
        AS prev_precision, (tp - pos)::DOUBLE / p AS prev_recall FROM ({{levels}})"""


@query("pr_points", rounded_sql(_PR_POINTS.format(levels=LINE_LEVELS),
                                ["precision", "recall", "prev_precision", "prev_recall"]))
def pr_points(spark, sf):
    points = metrics.pr_points(scored_lines(spark, sf))
    return points.withColumns({c: F.round(c, 6) for c in points.columns if c != "threshold"})


@query("pr_auc", rounded_sql(f"""
    SELECT sum((recall - prev_recall) * (precision + prev_precision) / 2) AS pr_auc
    FROM ({_PR_POINTS.format(levels=LINE_LEVELS)})""", ["pr_auc"]))
def pr_auc(spark, sf):
    return rounded(metrics.pr_auc(scored_lines(spark, sf)))


FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def labelled_lines(spark, sf):
    """Lines with label 1 where the discounted price is above its median, and their split."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", *FEATURES, net.alias("net"))
    marked = above_quantile(lines, "net", "label", 0.5).drop("net")
    return hash_split(marked, ["l_orderkey", "l_linenumber"])


def _parts(spark, sf):
    lines = labelled_lines(spark, sf)
    return {s: lines.filter(F.col("split") == s) for s in ("train", "val", "test")}


#: The queries train at the library's default effort.
QUERY_SIZES = models.ModelSizes()


def _train(spark, sf, name):
    parts = _parts(spark, sf)
    done = models.train_and_compare(parts["train"], parts["val"], FEATURES, "label", [name], QUERY_SIZES)
    return done, parts


@query("class_weights", rounded_sql("""
    SELECT label, count(*) AS n, any_value(w) AS weight FROM (
        SELECT label, CASE WHEN label = 1 THEN t / (2 * a) ELSE t / (2 * (t - a)) END AS w
        FROM (SELECT (l_returnflag = 'A')::INTEGER AS label FROM lineitem), (SELECT count(*)::DOUBLE AS t,
            count(*) FILTER (WHERE l_returnflag = 'A')::DOUBLE AS a FROM lineitem) s)
    GROUP BY label""", ["weight"]))
def class_weights(spark, sf):
    weighted = models.class_weights(scored_lines(spark, sf))
    return rounded(weighted.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.max(models.WEIGHT).alias("weight")))


@query("train_lr")
def train_lr(spark, sf):
    return _train(spark, sf, "logistic_regression")[0].results


@query("train_rf")
def train_rf(spark, sf):
    return _train(spark, sf, "random_forest")[0].results


@query("train_gbt")
def train_gbt(spark, sf):
    return _train(spark, sf, "gradient_boosting")[0].results


@query("train_gbt_unweighted")
def train_gbt_unweighted(spark, sf):
    return _train(spark, sf, "gradient_boosting_unweighted")[0].results


@query("predictions")
def predictions(spark, sf):
    done, parts = _train(spark, sf, "logistic_regression")
    return models.predict(done.best_model, models.model_input(parts["test"], FEATURES, "label")).select(
        "l_orderkey", "l_linenumber", "label", "prediction", "score")


@query("importances")
def importances(spark, sf):
    done, _ = _train(spark, sf, "random_forest")
    return models.importances(done.best_model, FEATURES, spark, top=15)


@query("coefficients")
def coefficients(spark, sf):
    done, _ = _train(spark, sf, "logistic_regression")
    return models.importances(done.best_model, FEATURES, spark)


@query("attribution_linear")
def attribution_linear(spark, sf):
    done, parts = _train(spark, sf, "logistic_regression")
    ready = models.model_input(parts["test"], FEATURES, "label")
    return explain.mean_attribution(explain.linear_attribution(
        done.best_model, ready, FEATURES, ["l_orderkey", "l_linenumber"]))


@query("attribution_trees")
def attribution_trees(spark, sf):
    done, parts = _train(spark, sf, "random_forest")
    ready = models.model_input(parts["test"], FEATURES, "label")
    return explain.mean_attribution(explain.shapley_attribution(
        done.best_model, ready, FEATURES, ["l_orderkey", "l_linenumber"]))


def event_scenarios(spark, sf):
    """Scenario texts out of the events: some blank, some not numbers, some out of bounds."""
    k = F.get_json_object("props", "$.k")
    return table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 4 > 0, F.concat(F.lit(" "), F.col("event_type"))).alias("name"),
        F.when(F.col("event_id") % 9 == 0, "cheap").otherwise(F.col("value").cast("string")).alias("price"),
        (F.col("user_id") % 5).cast("string").alias("platforms"),
        F.when(F.col("event_id") % 6 > 0, k).alias("genres"),
        k.alias("reviews"),
        (k.cast("double") / 80).cast("string").alias("ratio"),
        F.concat(k, F.lit("00")).alias("owners"),
        F.when(F.col("event_id") % 3 == 0, "TAK").when(F.col("event_id") % 3 == 1, "no")
        .otherwise("maybe").alias("achievements"))


SCENARIO_SQL = """
    SELECT event_id, CASE WHEN event_id % 4 > 0 THEN event_type ELSE 'Projekt_Nieznany' END AS name,
        CASE WHEN event_id % 9 > 0 THEN value END AS price, user_id % 5 AS platforms,
        CASE WHEN event_id % 6 > 0 THEN k ELSE 1 END AS genres, k AS reviews, k / 80.0::DOUBLE AS ratio,
        k * 100 AS owners,
        CASE WHEN event_id % 3 = 0 THEN true WHEN event_id % 3 = 1 THEN false END AS achievements
    FROM (SELECT *, json_extract_string(props, '$.k')::BIGINT AS k FROM events)"""
_VALID = """price IS NOT NULL AND platforms BETWEEN 1 AND 3 AND genres BETWEEN 1 AND 10
    AND ratio <= 1 AND achievements IS NOT NULL"""


@query("scenario_validation", f"""
    SELECT *, (price IS NULL)::INTEGER + (ratio > 1)::INTEGER
        + (platforms NOT BETWEEN 1 AND 3)::INTEGER + (genres NOT BETWEEN 1 AND 10)::INTEGER
        + (achievements IS NULL)::INTEGER AS n_errors,
        concat_ws('; ', CASE WHEN price IS NULL THEN 'price: not a number' END,
            CASE WHEN ratio > 1 THEN 'ratio: must be <= 1.0' END,
            CASE WHEN platforms < 1 THEN 'platforms: must be >= 1' WHEN platforms > 3 THEN 'platforms: must be <= 3' END,
            CASE WHEN genres < 1 THEN 'genres: must be >= 1' WHEN genres > 10 THEN 'genres: must be <= 10' END,
            CASE WHEN achievements IS NULL THEN 'achievements: yes or no' END) AS errors FROM ({SCENARIO_SQL})""")
def scenario_validation(spark, sf):
    checked = scenarios.validate_scenarios(event_scenarios(spark, sf))
    return checked.withColumn("n_errors", F.size("errors")).withColumn("errors", F.concat_ws("; ", "errors"))


@query("scenario_features", rounded_sql(f"""
    SELECT event_id, 2001 AS "Release_year", 0::BIGINT AS "Days_since_release",
        platforms::INTEGER AS "Platform_count", price AS "Price", (price = 0)::INTEGER AS "Is_free",
        reviews AS "Total_reviews", ratio AS "Review_ratio", ln(1 + owners) AS "Log_owners",
        achievements::INTEGER AS "Has_achievements", ln(1 + reviews) AS "Log_total_reviews",
        genres::INTEGER AS "Genre_count" FROM ({SCENARIO_SQL}) WHERE {_VALID}""",
    ["Price", "Review_ratio", "Log_owners", "Log_total_reviews"]))
def scenario_features(spark, sf):
    valid = scenarios.validate_scenarios(event_scenarios(spark, sf)).filter(F.size("errors") == 0)
    made = scenarios.scenario_features(valid, AS_OF)
    return rounded(made.select("event_id", *SCENARIO_FEATURES))


SCENARIO_FEATURES = ["Release_year", "Days_since_release", "Platform_count", "Price", "Is_free",
                     "Total_reviews", "Review_ratio", "Log_owners", "Has_achievements",
                     "Log_total_reviews", "Genre_count"]


def _scenario_model(spark, sf):
    # Training reads its rows many times: from a written table, not through the whole plan.
    cleaned = staged(cleaned_catalogue(spark, sf), "cleaned")
    final = staged(final_table(engineer_features(cleaned, AS_OF)), "final")
    split = hash_split(final, list(cat.KEY))
    done = models.train_and_compare(
        split.filter("split = 'train'"), split.filter("split = 'val'"), SCENARIO_FEATURES, cat.LABEL,
        ["logistic_regression"], QUERY_SIZES)
    return done.best_model


def _scored_scenarios(spark, sf):
    valid = scenarios.validate_scenarios(event_scenarios(spark, sf)).filter(F.size("errors") == 0)
    made = scenarios.scenario_features(valid, AS_OF)
    return models.score_scenarios(_scenario_model(spark, sf), made, SCENARIO_FEATURES, ["event_id", "name"])


@query("score_plan", f"""
    SELECT event_id, name, valid, CASE WHEN valid THEN 100.0::DOUBLE END AS total,
        CASE WHEN valid THEN true END AS verdict_fits, CASE WHEN valid THEN true END AS report_fits
    FROM (SELECT *, {_VALID} AS valid FROM ({SCENARIO_SQL}))""")
def score_plan(spark, sf):
    """Every scenario through the stored model: which are scored, and whether verdict and report agree
    with the probabilities."""
    path = scratch_path(spark, "scoring")
    models.save_model(_scenario_model(spark, sf), f"{path}/model")
    made = scoring.run_scoring(spark, f"{path}/model", event_scenarios(spark, sf), AS_OF, path, ["event_id"],
                               ["Compare with items of the same tier."])
    wins = F.col("prob_success") > F.col("prob_fail")
    return made.select(
        "event_id", "name", (F.size("errors") == 0).alias("valid"),
        F.round(F.col("prob_success") + F.col("prob_fail"), 6).alias("total"),
        (F.col("verdict") == F.when(wins, "SUCCESS").otherwise("RISK")).alias("verdict_fits"),
        (F.contains("report", F.format_string("Chance of success: %.1f%%", "prob_success"))
         & F.startswith("report", F.concat(F.lit("# Prediction: "), "name"))).alias("report_fits"))


@query("score_scenarios")
def score_scenarios(spark, sf):
    return _scored_scenarios(spark, sf).select(
        "event_id", "name", "prediction", "prob_success", "prob_fail", "verdict")


@query("scenario_report")
def scenario_report(spark, sf):
    return scenarios.render_report(_scored_scenarios(spark, sf), "logistic_regression").select(
        "event_id", "report")
