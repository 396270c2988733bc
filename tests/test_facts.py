"""Figures taken while a table is written."""

import pytest
from pyspark.sql import functions as F
from scans import scans_of

from tablewright.sources import writers
from tablewright.sources.facts import observed_write

ROWS = [(i, None if i % 4 == 0 else float("nan") if i % 5 == 0 else i / 2, "x" if i % 3 else None,
         "train" if i % 10 < 7 else "val" if i % 10 < 8 else "test") for i in range(200)]


def rows(spark, part=ROWS):
    return spark.createDataFrame(part, "id bigint, v double, t string, split string").repartition(5)


def gaps(part):
    return sum((r[1] is None or r[1] != r[1]) + (r[2] is None) for r in part)


def test_splits_are_counted_while_written(spark, tmp_path):
    facts = writers.write_splits(rows(spark), str(tmp_path / "s"))
    parts = {s: [r for r in ROWS if r[3] == s] for s in ("train", "val", "test")}
    assert facts.rows == 200 and facts.columns == ["id", "v", "t"] and facts.missing_cells == gaps(ROWS)
    assert facts.splits == {s: len(p) for s, p in parts.items()}
    assert facts.split_missing == {s: gaps(p) for s, p in parts.items()}


@pytest.mark.parametrize("odd", ["other", None])
def test_rows_of_no_split_raise(spark, tmp_path, odd):
    with pytest.raises(ValueError, match="1 rows belong to none"):
        writers.write_splits(rows(spark, [*ROWS, (999, 1.0, "x", odd)]), str(tmp_path / "s"))


def test_empty_table(spark, tmp_path):
    facts = writers.write_splits(rows(spark, []), str(tmp_path / "s"))
    assert (facts.rows, facts.missing_cells) == (0, 0)
    assert facts.splits == facts.split_missing == {"train": 0, "val": 0, "test": 0}


def test_names_with_dots_and_clashes(spark, tmp_path):
    odd = spark.createDataFrame([(1, None), (2, "b")], "`a.b` int, rows string")
    facts = observed_write(odd, str(tmp_path / "o"), lambda d: writers.write_parquet(d, str(tmp_path / "o")))
    assert facts.rows == 2 and facts.missing == {"a.b": 0, "rows": 1}


def test_manifest_scans_the_table_once_for_repeated_rows(spark, tmp_path):
    path = str(tmp_path / "stored_table")
    source = rows(spark, ROWS + ROWS[:9])
    facts = observed_write(source.drop("split"), path, lambda d: writers.write_parquet(d, path))
    stored = spark.read.parquet(path)
    again = source.filter("id < 0").drop("split")
    groups, seen = scans_of(spark, path, lambda: writers.write_feature_groups(
        stored, {"a": ["id", "v"], "b": ["t"], "c": ["none"]}, str(tmp_path / "g")))
    assert seen == 2 and list(groups) == ["a", "b"]
    splits = writers.write_splits(source, str(tmp_path / "s"))
    files = {"table": path, "splits": str(tmp_path / "s")}
    made, seen = scans_of(spark, path, lambda: writers.written_manifest(stored, "t", facts, groups, splits, files).first())
    # one listing for the sizes and one scan for the digests
    assert seen == 2
    assert (made.total_records, made.duplicate_rows, made.null_values) == (209, 9, gaps(ROWS + ROWS[:9]))
    assert made.group_facts.b.missing_cells == sum(r[2] is None for r in ROWS + ROWS[:9])
    assert made.split_sizes == splits.splits and made.split_facts.val.rows == splits.splits["val"]
    assert made.file_facts.table.files > 0 and made.file_facts.table.bytes > 0
    short = observed_write(again, str(tmp_path / "e"), lambda d: writers.write_parquet(d, str(tmp_path / "e")))
    with pytest.raises(ValueError, match="rows written"):
        writers.written_manifest(stored, "t", short, groups, splits, files)


def test_manifest_without_groups(spark, tmp_path):
    path = str(tmp_path / "t")
    facts = writers.write_splits(rows(spark), path)
    stored = spark.read.parquet(path).withColumn("one", F.lit(1)).drop("one")
    made = writers.written_manifest(stored, "t", facts, {}, facts, {"splits": path}).first()
    assert made.total_records == 200 and "group_facts" not in made.asDict()
