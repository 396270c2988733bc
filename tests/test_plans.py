"""Physical plans, the composed run, sources and streams."""

import csv
import dataclasses
import datetime as dt

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tablewright.operators import dedup, metrics, outliers, profile, split
from tablewright.operators.fitted import observed_labels
from tablewright.operators.models import ModelSizes, load_model, save_model
from tablewright.operators.projection import align_columns, normalize_table, select_strict
from tablewright.plans import catalogue as cat
from tablewright.plans.cleaning import clean_catalogue, clean_rows
from tablewright.plans.engineering import engineer_features, fit_statistics, fitted_features, row_features
from tablewright.plans.pipeline import STEPS, PipelineConfig, check_artifacts, run_pipeline
from tablewright.plans.scoring import run_scoring, score_plan, statistics_stage
from tablewright.sources import readers, writers
from tablewright.streaming.snapshots import feature_stream, snapshot_stream


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lines(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def test_row_sized_plans_have_no_single_partition_or_python(spark, sf_dir):
    df = lines(spark, sf_dir)
    keys = ["l_orderkey", "l_linenumber"]
    for made in (dedup.keep_first(df, keys, ["l_shipdate"]), split.hash_split(df, keys),
                 dedup.duplicate_groups(df)):
        text = plan(made)
        assert "SinglePartition" not in text and "Python" not in text and "Window" not in text


def test_hash_split_shuffles_nothing(spark, sf_dir):
    assert "Exchange" not in plan(split.hash_split(lines(spark, sf_dir), ["l_orderkey"]))


def test_only_wanted_columns_are_read(spark, sf_dir):
    text = plan(profile.value_counts(lines(spark, sf_dir), ["l_returnflag"]))
    assert "ReadSchema: struct<l_returnflag:string>" in text
    text = plan(dedup.duplicate_counts(lines(spark, sf_dir), ["l_orderkey"]))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text


def test_filters_reach_the_scan(spark, sf_dir):
    text = plan(profile.numeric_describe(lines(spark, sf_dir).filter("l_quantity > 40"), ["l_tax"]))
    assert "GreaterThan(l_quantity,40.0)" in text


def test_statistics_plan_no_join(spark, sf_dir):
    text = plan(outliers.outlier_rows(lines(spark, sf_dir), "l_tax"))
    assert "Join" not in text and "CartesianProduct" not in text


def test_a_shared_score_is_reduced_before_the_shuffle(spark, sf_dir):
    scored = lines(spark, sf_dir).selectExpr("l_discount AS score", "int(l_tax > 0.04) AS label")
    assert "partial_count" in plan(metrics.score_levels(scored))


HEADER = [*cat.RAW_COLUMNS, "Extra"]


def raw_row(key, date="Oct 21, 2008", **cells):
    row = dict.fromkeys(HEADER, "")
    row |= {"AppID": key, "Name": f"item {key}", "Release date": date, "Price": "9.99",
            "Windows": "True", "Mac": "False", "Positive": "40", "Negative": "2",
            "Metacritic score": "77", "Genres": "Action,RPG", "Estimated owners": "100"}
    return row | cells


ROWS = [
    raw_row(1, date="Aug 2012"), raw_row(1, date="Aug 5, 2012"),
    raw_row(2, Name=' two, "quoted"\nname ', Price="-1"), raw_row(2, Name="second copy"),
    raw_row(3, Windows="", Mac="", Positive="", Negative="", Genres="", Price="free"),
    raw_row(4, Price="59.994", Genres="NA", **{"Metacritic score": "130"}),
    *[raw_row(i, Positive=str(i % 60), Negative=str(i % 7), Price=f"{i % 80}.5",
              **{"Metacritic score": str(i % 100)}) for i in range(10, 300)],
]


def write_raw(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.DictWriter(f, HEADER)
        out.writeheader()
        out.writerows(rows)


@pytest.fixture(scope="module")
def raw_dir(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    write_raw(root / "games_20230101_000000.csv", [raw_row(9999)])
    write_raw(root / "games_20240101_000000.csv", ROWS)
    write_raw(root / "games_cleaned.csv", [raw_row(9998)])
    write_raw(root / "other_20250101_000000.csv", [raw_row(9997)])
    return str(root)


def read_raw(spark, raw_dir):
    return readers.read_latest_csv(spark, raw_dir, cat.RAW_PATTERN, cat.DERIVED_FILES, row_order=True)


def test_cleaning_rules(spark, raw_dir):
    rows = {r.AppID: r for r in clean_catalogue(read_raw(spark, raw_dir)).collect()}
    assert not {1, 9997, 9998, 9999} & set(rows)
    assert rows[2].Name == 'two, "quoted"\nname' and rows[2].Price == 0
    assert rows[2]["Release date"] == dt.date(2008, 10, 21)
    assert (rows[3].Windows, rows[3].Mac, rows[2].Mac) == (False, False, True)
    assert rows[3].Review_ratio is None and rows[3].Price == 0 and rows[3].Genres == ""
    assert rows[4]["Metacritic score"] == 100 and rows[4].Price == 59.99 and rows[4].Genres == ""


def test_engineered_columns(spark, raw_dir):
    made = engineer_features(clean_catalogue(read_raw(spark, raw_dir)), "2024-01-10")
    rows = {r.AppID: r for r in made.collect()}
    assert rows[3].Genre_count == 0 and rows[2].Genre_count == 2
    assert rows[3].Review_ratio == 0.5 and rows[3].Total_reviews == 0
    assert rows[4].Price_category == "AAA" and rows[4].Price_category_AAA == 1
    assert rows[2].Is_highly_rated == 1 and rows[3].Is_highly_rated == 0
    assert "User_score_normalized" in made.columns and "user_score_z" in made.columns
    assert set(cat.FINAL_COLUMNS) <= set(made.columns)


def test_statistics_can_come_from_other_rows(spark, raw_dir):
    cleaned = clean_catalogue(read_raw(spark, raw_dir))
    some = cleaned.filter("AppID < 150")
    made = engineer_features(cleaned, "2024-01-10", fit_on=some).filter("AppID = 2").first()
    price = some.agg(F.avg("Price"), F.stddev_pop("Price")).first()
    assert made.Price_normalized == pytest.approx((0 - price[0]) / price[1])


def test_run_and_artifacts(spark, raw_dir, tmp_path):
    cfg = PipelineConfig(raw_dir, str(tmp_path / "out"), "2024-01-10", attribution_rows=50,
                         sizes=ModelSizes(lr_iterations=20, trees=3, depth=3, rounds=2))
    status = run_pipeline(spark, cfg).collect()
    assert [(r.step, r.message) for r in status if r.status != "ok"] == []
    assert {r.step: r.rows for r in status}["clean"] == 293
    assert check_artifacts(spark, cfg.out_dir).filter("not exists").count() == 0
    parts = readers.read_splits(spark, cfg.path("splits"))
    n = spark.read.parquet(cfg.path("final")).count()
    assert [parts[s].count() for s in ("train", "val")] == [int(n * 0.7), int(n * 0.15)]
    sizes = spark.read.json(cfg.path("manifest")).first()
    assert sizes.total_records == n and sizes.split_sizes.train == int(n * 0.7) and sizes.stored_mb > 0
    assert "Records" in "\n".join(r.value for r in spark.read.text(cfg.path("summary")).collect())


def test_a_run_goes_on_after_the_step_that_failed(spark, raw_dir, tmp_path):
    cfg = PipelineConfig(raw_dir, str(tmp_path / "out"), "2024-01-10", attribution_rows=20,
                         sizes=ModelSizes(lr_iterations=5, trees=2, depth=2, rounds=2))

    def broken(spark, cfg):
        raise ValueError("no room")

    def status(steps, resume=True):
        return [r.status for r in run_pipeline(spark, cfg, steps, resume).collect()]

    assert status({**STEPS, "export": broken}) == ["ok"] * 4 + ["failed"] + ["skipped"] * 3
    again = run_pipeline(spark, cfg, STEPS, resume=True).collect()
    assert [r.status for r in again] == ["unchanged"] * 4 + ["ok"] * 4
    assert {r.step: r.rows for r in again}["clean"] == 293
    assert status(STEPS) == ["unchanged"] * 8
    # an output that was touched is made anew, and what reads it runs again
    spark.read.parquet(cfg.path("cleaned")).limit(1).write.mode("append").parquet(cfg.path("engineered"))
    assert status({s: STEPS[s] for s in ("clean", "engineer", "validate")}) == ["unchanged", "ok", "ok"]
    assert status({"clean": STEPS["clean"]}, resume=False) == ["ok"]
    other = dataclasses.replace(cfg, as_of="2024-02-10")
    assert run_pipeline(spark, other, {"engineer": STEPS["engineer"]}, resume=True).first().status == "ok"

    # the model it left is all that scoring needs, in a batch and in a stream
    asked = spark.createDataFrame([("One", "9.99", "3", "yes"), ("Two", "x", "1", "no"), (None, None, None, "y")],
                                  "name string, price string, platforms string, achievements string")
    batch = run_scoring(spark, cfg.path("model"), asked, "2024-01-10", str(tmp_path / "scoring"))
    assert {r.name: len(r.errors) for r in batch.collect()} == {"One": 0, "Two": 1, "Projekt_Nieznany": 0}
    assert batch.filter("size(errors) = 0 AND report LIKE '# Prediction%'").count() == 2
    asked.write.parquet(str(tmp_path / "asked"))
    stream = score_plan(spark.readStream.schema(asked.schema).parquet(str(tmp_path / "asked")),
                        load_model(cfg.path("model")), "2024-01-10")
    query = (stream.writeStream.format("memory").queryName("asked")
             .option("checkpointLocation", str(tmp_path / "cp")).start())
    query.processAllAvailable()
    query.stop()
    assert sorted(map(repr, spark.table("asked").collect())) == sorted(map(repr, batch.collect()))
    with pytest.raises(Exception, match="(?i)path"):
        run_scoring(spark, cfg.path("absent"), asked, "2024-01-10", str(tmp_path / "scoring"))


def test_fitted_statistics_as_a_stage(spark, raw_dir, tmp_path):
    featured = row_features(normalize_table(clean_catalogue(read_raw(spark, raw_dir))), "2024-01-10")
    statistics, labels = fit_statistics(featured), observed_labels(featured, cat.CATEGORIES)
    save_model(PipelineModel([statistics_stage(statistics, labels)]), str(tmp_path / "stage"))
    made = load_model(str(tmp_path / "stage")).transform(featured)
    want = fitted_features(featured, statistics, labels)
    assert made.columns == want.columns
    for a, b in zip(made.orderBy("AppID").collect(), want.orderBy("AppID").collect()):
        assert all(x == y or x == pytest.approx(y) for x, y in zip(a, b))


def test_a_failed_step_stops_the_run(spark, tmp_path):
    def bad(spark, cfg):
        raise ValueError("no")

    cfg = PipelineConfig("none", str(tmp_path), "2024-01-10")
    steps = {"a": lambda s, c: None, "b": bad, "c": lambda s, c: None}
    got = [(r.step, r.status) for r in run_pipeline(spark, cfg, steps).collect()]
    assert got == [("a", "ok"), ("b", "failed"), ("c", "skipped")]


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "snaps")
    writers.land_snapshot(spark.range(3), path, "20240101_000000")
    writers.land_snapshot(spark.range(5), path, "20240201_000000")
    assert readers.read_snapshot(spark, path).count() == 5
    assert readers.read_snapshot(spark, path, "20240101_000000").count() == 3
    with pytest.raises(Exception):
        writers.land_snapshot(spark.range(1), path, "20240201_000000")


def test_missing_inputs_fail_early(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_latest_csv(spark, str(tmp_path), "games_*.csv")
    with pytest.raises(ValueError, match="missing columns: b"):
        select_strict(spark.range(1), ["id", "b"])
    spark.range(4).selectExpr("id", "'val' AS split").write.partitionBy("split").parquet(
        str(tmp_path / "s"))
    with pytest.raises(FileNotFoundError, match="test, train"):
        readers.read_splits(spark, str(tmp_path / "s"))


def test_empty_tables_are_written(spark, tmp_path):
    writers.write_csv(spark.range(3).filter("id > 9"), str(tmp_path / "e"))
    assert readers.read_csv(spark, str(tmp_path / "e")).count() == 0
    assert check_artifacts(spark, str(tmp_path), ["e"]).first().exists


def test_align(spark):
    row = align_columns(spark.range(1).selectExpr("id", "7 AS x", "8 AS extra"), ["x", "new", "id"]).first()
    assert row.asDict() == {"x": 7, "new": 0, "id": 0}


def test_stream_equals_batch(spark, raw_dir, tmp_path):
    raw = read_raw(spark, raw_dir).drop(readers.ROW_ORDER).select(*[F.col(f"`{c}`") for c in cat.RAW_COLUMNS])
    landed = str(tmp_path / "land")
    writers.land_snapshot(raw, landed, "20240101_000000")
    cleaned = normalize_table(clean_rows(raw))
    featured = row_features(cleaned, "2024-01-10")
    statistics = writers_table(spark, fit_statistics(featured), tmp_path)
    labels = observed_labels(featured, cat.CATEGORIES)
    stream = feature_stream(snapshot_stream(spark, landed, raw.schema), "2024-01-10", statistics, labels)
    query = (stream.writeStream.format("memory").queryName("features")
             .option("checkpointLocation", str(tmp_path / "cp")).start())
    query.processAllAvailable()
    query.stop()
    got = spark.table("features").select("AppID", "Is_heavily_reviewed", "Price_normalized", "Genre_count")
    want = feature_stream(raw, "2024-01-10", statistics, labels).select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == cleaned.count()


def writers_table(spark, df, tmp_path):
    writers.write_parquet(df, str(tmp_path / "stats"))
    return spark.read.parquet(str(tmp_path / "stats"))
