"""The registered queries against their SQL, and the pipeline stage by stage."""

import pytest
from compare import connect, differences

import __spark_entry__ as contract
import corpus_pipeline
from tablewright.llm.registry import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, name):
    assert differences(spark, connect(sf_dir), QUERIES[name], SQL[name], sf_dir) == ""


def test_all_are_registered():
    assert set(QUERIES) <= set(contract.queries()) and "pipeline" in QUERIES
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline"} == set(range(1, 14))


def test_pipeline(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        made = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "packing":
            assert made.agg({"length": "sum"}).first()[0] >= docs.count()
            assert made.select("doc_id").distinct().count() == docs.count()
        else:
            assert made.columns == columns
            assert made.join(docs, columns, "left_anti").isEmpty()  # rows come unchanged
            sizes.append(made.count())
        docs = made
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == sizes[-2] and sizes[2] < sizes[1]


SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, _score double, _text string, "
          "row string, slot long, rank long, digest string, kept boolean")


def test_pipeline_on_awkward_rows(spark, sf_dir, tmp_path):
    text = "a long text of many words that stands here for all the others and is told again and again " * 4
    texts = [None, "", "", text, text.upper(), text + " with a tail", "x" * 5000, " \n", "\u65e5\u672c \u8a9e", "one"]
    extra = (0.5, 0.1, "u", "r", 1, 2, "d", False)
    rows = [(i, t, [None, "en"][i % 2], [None, "s", "t"][i % 3], None if i % 4 else i, *extra) for i, t in enumerate(texts)]
    rows += [(3, text, "en", "s", 1, *extra)] * 2 + [(None, "no key", "en", "s", 1, *extra), (None, None, None, None, None, *([None] * 8))]
    for name, table in (("rows", rows), ("empty", [])):
        docs = spark.createDataFrame(table, SCHEMA)
        for stage, function in corpus_pipeline.STAGES:
            function(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}/{stage}")
            made = spark.read.parquet(f"{tmp_path}/{name}/{stage}")
            if stage != "packing":
                assert made.columns == docs.columns
            docs = made
        assert (docs.count() > 0) == bool(table)
    exact = spark.read.parquet(f"{tmp_path}/rows/exact_dedup")
    assert exact.count() == len({(t or "").lower() for t in [*texts, "no key"]})
    near = spark.read.parquet(f"{tmp_path}/rows/near_dedup")
    assert near.count() == exact.count() - 1  # the text and its tail
