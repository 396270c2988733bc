"""Drops are read by their commit marks."""

import pytest
from pyspark.sql import functions as F
from scans import scans_of

from tablewright.sources import drops, readers, writers


def orders(spark, n, start=0):
    return spark.range(start, start + n).select(
        F.col("id").alias("key"), F.when(F.col("id") % 3 > 0, F.concat(F.lit('a, "'), "id")).alias("note"))


def test_only_committed_drops_are_seen(spark, tmp_path):
    root = str(tmp_path / "land")
    with pytest.raises(FileNotFoundError):
        drops.latest_drop(spark, root)
    facts = drops.land_drop(orders(spark, 20), root, "day_1")
    assert facts.rows == 20 and facts.missing == {"key": 0, "note": 7}
    writers.write_csv(orders(spark, 5), f"{root}/day_2")  # no mark: still being written
    assert drops.latest_drop(spark, root) == "day_1"
    with pytest.raises(FileNotFoundError):
        drops.read_drop(spark, root, "day_2")
    # a writer that comes again replaces what the failed one left, but nothing committed
    drops.land_drop(orders(spark, 6), root, "day_2")
    got = drops.read_drop(spark, root)
    want = readers.read_csv(spark, f"{root}/day_2")
    assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=repr) == sorted(
        map(tuple, want.collect()), key=repr) and got.count() == 6
    with pytest.raises(FileExistsError):
        drops.land_drop(orders(spark, 1), root, "day_2")
    for name in ("", "_x", ".x", "a/b"):
        with pytest.raises(ValueError):
            drops.land_drop(orders(spark, 1), root, name)
    assert drops.latest_drop(spark, root, "day_*", skip=["day_2"]) == "day_1"
    mark = drops.committed_drops(spark, root).filter("drop = 'day_1'").first()
    assert mark.columns == ["key", "note"] and mark.n_rows == 20 and mark.n_bytes > 0


def test_planning_reads_no_text(spark, tmp_path):
    root = str(tmp_path / "land")
    drops.land_drop(orders(spark, 50).repartition(4), root, "wide_drop")
    table, seen = scans_of(spark, f"{root}/wide_drop", lambda: drops.read_drop(spark, root, check=False))
    assert seen == 0 and table.count() == 50
    _, seen = scans_of(spark, f"{root}/wide_drop", table.collect)
    assert seen == 1


def test_mixed_headers_of_others(spark, tmp_path):
    root = tmp_path / "land"
    (root / "mixed").mkdir(parents=True)
    for name, text in (("p1", "a,b\nx,1\n"), ("p2", "b,a\n3,z\n"), ("p3", "a,b,c d\nw,4,k\n"), ("p4", "a,b\ny,n/a\n")):
        (root / "mixed" / f"{name}.csv").write_text(text)
    (root / "single.csv").write_text("a,b\nx,1\n")
    assert drops.commit_drop(spark, str(root), "mixed") == ["a", "b", "c d"]
    drops.commit_drop(spark, str(root), "single.csv")
    for row_order in (False, True):
        got = drops.read_drop(spark, str(root), "mixed", row_order=row_order)
        assert sorted((r.a, r.b, r["c d"]) for r in got.collect()) == [
            ("w", "4", "k"), ("x", "1", None), ("y", None, None), ("z", "3", None)]
    assert [tuple(r) for r in drops.read_drop(spark, str(root)).collect()] == [("x", "1")]
    assert [r.b for r in drops.read_drop(spark, str(root), cols=["b"]).collect()] == ["1"]
    (root / "mixed" / "p5.csv").write_text("a,b\nlate,1\n")
    with pytest.raises(ValueError, match="5 files"):
        drops.read_drop(spark, str(root), "mixed")
    (root / "none").mkdir()
    (root / "none" / "_SUCCESS").write_text("")
    with pytest.raises(FileNotFoundError):
        drops.commit_drop(spark, str(root), "none")


def test_every_drop_is_taken(spark, tmp_path):
    root, state = str(tmp_path / "land"), str(tmp_path / "reader")
    assert drops.pending_drops(spark, root, state) == []
    for i in (1, 2):
        drops.land_drop(orders(spark, 2, 10 * i), root, f"d{i}")
    assert drops.pending_drops(spark, root, state) == ["d1", "d2"]
    drops.take_drop(spark, state, "d1")
    drops.land_drop(orders(spark, 0), root, "d3")
    assert drops.pending_drops(spark, root, state) == ["d2", "d3"]
    assert drops.pending_drops(spark, root, str(tmp_path / "other")) == ["d1", "d2", "d3"]
    assert drops.read_drop(spark, root, "d3").columns == ["key", "note"]
    assert drops.read_drop(spark, root, "d3").count() == 0
