"""Every registered query against its SQL, on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as contract

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, name):
    assert differences(spark, connect(sf_dir), QUERIES[name], SQL[name], sf_dir) == ""


@pytest.mark.parametrize("name", ["density", "report_documents", "train_lr", "attribution_trees",
                                  "scenario_report"])
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).take(1)


def test_entry_runs(spark, sf_dir):
    assert {r.category for r in contract.entry(spark).collect()} <= {"low", "middle", "high", "top"}


def test_sql_only_for_known_queries():
    assert set(SQL) <= set(QUERIES)
