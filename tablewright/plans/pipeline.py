"""The composed pipeline (LIF1-LIF3): raw folder in, tables, reports and a model out."""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.cleaning import to_number
from tablewright.operators.correlation import correlation_pairs, strong_pairs
from tablewright.operators.explain import linear_attribution, mean_attribution, shapley_attribution
from tablewright.operators.metrics import (
    class_report, confusion_matrix, pr_auc, pr_points, roc_auc, roc_points,
)
from tablewright.operators.models import (
    ModelSizes, feature_columns, importances, load_model, model_input, predict, save_model, train_and_compare,
)
from tablewright.operators.outliers import boxplot_stats, fences, iqr_outliers_text
from tablewright.operators.profile import (
    MEDIAN, QUARTILES, describe_columns, describe_rows, histogram, key_counts, missing_rows, observe_flags, one_pass,
    profile_rows, report_of, summary_rows, value_range,
)
from tablewright.operators.projection import numeric_columns
from tablewright.operators.quantiles import all_wishes, search_quantiles
from tablewright.operators.quality import ValidationConfig, report_documents, validation_report
from tablewright.operators.split import exact_split, hash_split
from tablewright.plans import catalogue as cat
from tablewright.plans.cleaning import clean_catalogue, post_clean_check
from tablewright.plans.engineering import engineer_features, final_table
from tablewright.session import staged
from tablewright.sources import readers, writers
from tablewright.sources.facts import observed_write


@dataclass(frozen=True)
class PipelineConfig:
    """Where to read and write, and the choices of each step."""

    raw_dir: str
    out_dir: str
    as_of: str
    seed: int = 42
    exact_sizes: bool = True
    platform_mode: str = "presence"
    select_on: str = "val"
    multi_line: bool = True
    attribution_rows: int = 1000
    sizes: ModelSizes = field(default_factory=ModelSizes)

    def path(self, name: str) -> str:
        return f"{self.out_dir.rstrip('/')}/{name}"


#: Outputs a finished run has left, relative to its folder.
EXPECTED = (
    "cleaned", "engineered", "final", "final_csv", "splits", "groups", "manifest", "summary",
    "reports/exploration", "reports/profile", "reports/numbers", "reports/summary",
    "reports/keys", "reports/post_clean", "reports/dates", "reports/validation",
    "reports/columns", "reports/outliers", "reports/boxplots", "reports/correlations",
    "reports/correlation_histogram", "reports/histograms", "reports/models",
    "reports/importances", "reports/classes", "reports/confusion", "reports/curves",
    "reports/attribution", "model",
)


def explore(spark: SparkSession, cfg: PipelineConfig) -> None:
    raw = _raw(spark, cfg, row_order=True)
    typed = raw.withColumns({c: to_number(c) for c in cat.RAW_NUMBERS if c in raw.columns})
    columns = [c for c in typed.columns if c != readers.ROW_ORDER]
    numbers = numeric_columns(typed)
    found = search_quantiles(typed, all_wishes(dict.fromkeys(numbers, QUARTILES), {"Price": MEDIAN}))
    reports = {
        "exploration": missing_rows(typed, columns),
        "profile": profile_rows(typed, cat.RAW_COLUMNS, [readers.ROW_ORDER]),
        "numbers": describe_rows(typed, numbers, found=found),
        "summary": summary_rows(
            typed, "Price", cat.PLATFORMS,
            ("Metacritic score", "User score", "Positive", "Negative"),
            ("Developers", "Publishers", "Categories", "Genres", "Achievements"), found=found),
    }
    # After one search for all quantiles, the raw text is read once for all four reports.
    facts = staged(one_pass(typed, reports), "exploration")
    for name in reports:
        writers.write_csv(report_of(facts, name), cfg.path(f"reports/{name}"))
    writers.write_csv(key_counts(raw, cat.KEY[0]), cfg.path("reports/keys"))


def clean(spark: SparkSession, cfg: PipelineConfig) -> dict:
    cleaned, seen = observe_flags(
        clean_catalogue(_raw(spark, cfg, row_order=True), platform_mode=cfg.platform_mode),
        "cleaned", sums=cat.PLATFORMS, means=["Positive", "Negative", "Achievements",
                                              "Estimated owners"])
    writers.write_parquet(cleaned, cfg.path("cleaned"))
    stage = readers.read_stage(spark, cfg.path("cleaned"))
    writers.write_csv(post_clean_check(stage), cfg.path("reports/post_clean"))
    writers.write_csv(value_range(stage, "Release date"), cfg.path("reports/dates"))
    return seen.get


def engineer(spark: SparkSession, cfg: PipelineConfig) -> dict:
    cleaned = readers.read_stage(spark, cfg.path("cleaned"))
    table, seen = observe_flags(
        engineer_features(cleaned, cfg.as_of), "engineered",
        sums=["Is_highly_rated", "Is_free"], means=["Platform_count", "Total_reviews", "Price"])
    writers.write_parquet(table, cfg.path("engineered"))
    return seen.get


def validate(spark: SparkSession, cfg: PipelineConfig) -> None:
    table = readers.read_stage(spark, cfg.path("engineered"))
    report = validation_report(table, ValidationConfig(
        key=cat.KEY, rules=cat.RANGE_RULES, moments=cat.MOMENT_COLUMNS,
        categories=cat.CATEGORIES))
    writers.write_json(report_documents(report), cfg.path("reports/validation"))


def export(spark: SparkSession, cfg: PipelineConfig) -> dict:
    made = final_table(readers.read_stage(spark, cfg.path("engineered")))
    table = observed_write(made, cfg.path("final"), lambda d: writers.write_parquet(d, cfg.path("final")))
    final = readers.read_stage(spark, cfg.path("final"))
    writers.write_csv(final, cfg.path("final_csv"))
    split = exact_split if cfg.exact_sizes else hash_split
    splits = writers.write_splits(split(final, list(cat.KEY), seed=cfg.seed), cfg.path("splits"))
    groups = writers.write_feature_groups(final, cat.FEATURE_GROUPS, cfg.path("groups"))
    writers.write_csv(describe_columns(final, cat.DESCRIPTIONS), cfg.path("reports/columns"))
    # Sizes, gaps and splits are known from the writes; only repeated rows are counted by a scan.
    files = {"table": "final", "table_csv": "final_csv", "splits": "splits"}
    manifest = staged(writers.written_manifest(
        final, "catalogue", table, groups, splits, {k: cfg.path(v) for k, v in files.items()}), "manifest")
    stored = F.lit(writers.stored_megabytes(final, cfg.path("final")))
    writers.write_json(manifest.withColumn("stored_mb", stored), cfg.path("manifest"))
    writers.write_text(writers.dataset_summary(manifest), cfg.path("summary"), "text")
    return {"n_rows": table.rows}


def profile(spark: SparkSession, cfg: PipelineConfig) -> None:
    final = readers.read_stage(spark, cfg.path("final"))
    cols = numeric_columns(final, cat.NOT_PROFILED)
    fitted = fences(final, cols)
    writers.write_csv(iqr_outliers_text(final, cols, fitted=fitted), cfg.path("reports/outliers"))
    writers.write_csv(boxplot_stats(final, cols, fitted=fitted), cfg.path("reports/boxplots"))
    writers.write_parquet(correlation_pairs(final), cfg.path("reports/correlation_pairs"))
    pairs = readers.read_stage(spark, cfg.path("reports/correlation_pairs"))
    writers.write_csv(strong_pairs(pairs), cfg.path("reports/correlations"))
    writers.write_csv(histogram(pairs, ["corr"]), cfg.path("reports/correlation_histogram"))
    writers.write_csv(histogram(final, cols), cfg.path("reports/histograms"))


def train(spark: SparkSession, cfg: PipelineConfig) -> None:
    parts = readers.read_splits(spark, cfg.path("splits"))
    features = feature_columns(parts["train"], cat.LABEL, cat.NOT_FEATURES)
    done = train_and_compare(parts["train"], parts[cfg.select_on], features, cat.LABEL,
                             sizes=cfg.sizes)
    save_model(done.best_model, cfg.path("model"))
    writers.write_csv(done.results, cfg.path("reports/models"))
    writers.write_csv(importances(done.best_model, features, spark),
                      cfg.path("reports/importances"))


def evaluate(spark: SparkSession, cfg: PipelineConfig) -> None:
    test = readers.read_splits(spark, cfg.path("splits"))["test"]
    features = feature_columns(test, cat.LABEL, cat.NOT_FEATURES)
    model = load_model(cfg.path("model"))
    ready = model_input(test, features, cat.LABEL)
    writers.write_parquet(predict(model, ready).select(*cat.KEY, "label", "prediction", "score"),
                          cfg.path("scored"))
    scored = readers.read_stage(spark, cfg.path("scored"))
    writers.write_csv(class_report(scored), cfg.path("reports/classes"))
    writers.write_csv(confusion_matrix(scored), cfg.path("reports/confusion"))
    areas = roc_auc(scored).select(F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value"))
    areas = areas.unionByName(
        pr_auc(scored).select(F.lit("pr_auc").alias("metric"), F.col("pr_auc").alias("value")))
    writers.write_csv(areas, cfg.path("reports/curves/areas"))
    writers.write_csv(roc_points(scored), cfg.path("reports/curves/roc"))
    writers.write_csv(pr_points(scored), cfg.path("reports/curves/pr"))
    explain = linear_attribution if hasattr(model.stages[-1], "coefficients") else shapley_attribution
    shares = explain(model, ready, features, list(cat.KEY), cfg.attribution_rows)
    writers.write_csv(mean_attribution(shares), cfg.path("reports/attribution"))


STEPS: Mapping[str, Callable[[SparkSession, PipelineConfig], object]] = {
    "explore": explore, "clean": clean, "engineer": engineer, "validate": validate,
    "export": export, "profile": profile, "train": train, "evaluate": evaluate,
}

#: What each step reads and writes, relative to the output folder; `raw` is the folder of drops.
FLOW: Mapping[str, tuple[Sequence[str], Sequence[str]]] = {
    "explore": (["raw"], ["reports/exploration", "reports/profile", "reports/numbers", "reports/summary", "reports/keys"]),
    "clean": (["raw"], ["cleaned", "reports/post_clean", "reports/dates"]),
    "engineer": (["cleaned"], ["engineered"]),
    "validate": (["engineered"], ["reports/validation"]),
    "export": (["engineered"], ["final", "final_csv", "splits", "groups", "manifest", "summary", "reports/columns"]),
    "profile": (["final"], ["reports/outliers", "reports/boxplots", "reports/correlations",
                            "reports/correlation_histogram", "reports/histograms"]),
    "train": (["splits"], ["model", "reports/models", "reports/importances"]),
    "evaluate": (["splits", "model"], ["scored", "reports/classes", "reports/confusion", "reports/curves", "reports/attribution"]),
}

STATUS_SCHEMA = "step string, status string, seconds double, rows bigint, message string"
LEDGER_SCHEMA = "step string, asked string, made string, rows bigint"


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> str | None:
    """A digest of the names, sizes and times of all files under the paths; None where one is absent."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
        found = files.select(F.xxhash64("path", "length", "modificationTime").alias("h")).agg(
            F.count("h").alias("n"), F.bit_xor("h").alias("h")).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return f"{found.n}:{found.h}"


class Ledger:
    """What finished steps read and made, kept as one small file per step in the output folder."""

    def __init__(self, spark: SparkSession, cfg: PipelineConfig) -> None:
        self.spark, self.cfg = spark, cfg

    def _paths(self, names: Sequence[str]) -> list[str]:
        return [self.cfg.raw_dir if n == "raw" else self.cfg.path(n) for n in names]

    def asked(self, step: str) -> str:
        """Parameters and inputs of a step as they are now."""
        inputs = fingerprint(self.spark, self._paths(FLOW[step][0])) if step in FLOW else None
        return hashlib.sha256(f"{self.cfg!r} {inputs}".encode()).hexdigest()

    def made(self, step: str) -> str | None:
        """The outputs of a step as they are now."""
        return fingerprint(self.spark, self._paths(FLOW[step][1])) if step in FLOW else None

    def unchanged(self, step: str) -> int | None:
        """The rows a finished step wrote, -1 if it counts none; None if it has to run."""
        try:
            held = self.spark.read.schema(LEDGER_SCHEMA).json(self.cfg.path(f"_ledger/{step}")).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        if held is None or held.made is None or (held.asked, held.made) != (self.asked(step), self.made(step)):
            return None
        return -1 if held.rows is None else held.rows

    def note(self, step: str, asked: str, rows: int | None) -> None:
        line = self.spark.createDataFrame([(step, asked, self.made(step), rows)], LEDGER_SCHEMA)
        writers.write_json(line.coalesce(1), self.cfg.path(f"_ledger/{step}"))


def run_pipeline(spark: SparkSession, cfg: PipelineConfig, steps: Mapping[str, Callable] = STEPS,
                 resume: bool = False) -> DataFrame:
    """LIF1, LIF3: run the steps in order, stop at the first failure, return the status table.

    A step that was not reached is listed as 'skipped'. Steps that return the figures observed
    while they wrote their table show its number of rows. Every finished step leaves a line in a
    ledger; with `resume`, a step whose parameters, inputs and outputs are as it left them is not run
    again and listed as 'unchanged', so a run goes on after the step that failed.
    """
    rows, failed, ledger = [], False, Ledger(spark, cfg)
    for name, step in steps.items():
        if failed:
            rows.append((name, "skipped", 0.0, None, None))
            continue
        started = time.monotonic()
        try:
            held = ledger.unchanged(name) if resume else None
            if held is not None:
                rows.append((name, "unchanged", time.monotonic() - started, None if held < 0 else held, None))
                continue
            asked = ledger.asked(name)
            figures = step(spark, cfg) or {}
            ledger.note(name, asked, figures.get("n_rows"))
            rows.append((name, "ok", time.monotonic() - started, figures.get("n_rows"), None))
        except Exception as error:  # the status table reports it
            failed = True
            rows.append((name, "failed", time.monotonic() - started, None, str(error)))
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def check_artifacts(spark: SparkSession, out_dir: str, expected=EXPECTED) -> DataFrame:
    """LIF2: (path, exists) for every expected output."""
    root = out_dir.rstrip("/")
    # listed paths may spell scheme and host in another way, so only what follows them counts
    place = F.regexp_replace("path", "^[a-z0-9]+:(//[^/]*)?/*(?=/)", "")
    bare = re.sub("^[a-z0-9]+:(//[^/]*)?/*(?=/)", "", root)
    inside = place if bare.startswith("/") else F.regexp_extract(place, rf"/\Q{bare}\E/.*", 0).substr(2, 1 << 30)
    hits = readers.list_files(spark, root).select(F.explode(F.array(*[
        F.when(F.startswith(inside, F.lit(f"{bare}/{e}/")), F.lit(e)) for e in expected
    ])).alias("artifact")).filter("artifact is not null").distinct()
    names = spark.createDataFrame([(e,) for e in expected], "artifact string")
    return names.join(hits.withColumn("hit", F.lit(True)), "artifact", "left").select(
        "artifact", F.coalesce("hit", F.lit(False)).alias("exists"))


def _raw(spark: SparkSession, cfg: PipelineConfig, row_order: bool = False) -> DataFrame:
    return readers.read_latest_csv(spark, cfg.raw_dir, cat.RAW_PATTERN, cat.DERIVED_FILES,
                                   multi_line=cfg.multi_line, row_order=row_order)
