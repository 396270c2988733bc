"""CSV folders with mixed headers, artifact roots with a scheme, labels that differ in case."""

from tablewright.operators.fitted import one_hot
from tablewright.plans.pipeline import check_artifacts
from tablewright.sources.readers import read_csv


def test_columns_go_by_name_across_files(spark, tmp_path):
    for name, text in (("p1", "a,b\nx,1\n"), ("p2", "b,a\n3,z\n"), ("p3", "a,b,c\nw,4,k\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    for row_order in (False, True):
        rows = read_csv(spark, str(tmp_path), row_order=row_order).collect()
        assert sorted((r.a, r.b, r.c) for r in rows) == [("w", "4", "k"), ("x", "1", None), ("z", "3", None)]


def test_artifacts_under_any_spelling_of_the_root(spark, tmp_path):
    (tmp_path / "cleaned").mkdir()
    (tmp_path / "cleaned" / "part").write_text("1")
    for root in (str(tmp_path), f"file://{tmp_path}", f"file:{tmp_path}"):
        got = {r.artifact: r.exists for r in check_artifacts(spark, root, ["cleaned", "absent"]).collect()}
        assert got == {"cleaned": True, "absent": False}


def test_labels_that_differ_in_case(spark):
    made = one_hot(spark.createDataFrame([("a",), ("A",)], "t string"), "t")
    assert made.columns == ["t", "t_A", "t_a_2"]
    assert sorted((r.t, r.t_A, r.t_a_2) for r in made.collect()) == [("A", 1, 0), ("a", 0, 1)]
