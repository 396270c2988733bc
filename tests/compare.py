"""Run registered queries beside their SQL: python tests/compare.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import pathlib
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "asDict"):
        return str(sorted((k, _cell(x)) for k, x in v.asDict().items()))
    if isinstance(v, dict):
        return str(sorted((k, _cell(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return str([_cell(x) for x in v])
    return v


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(cells, key=lambda r: tuple((x is None, str(x)) for x in r))


FAMILY = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
          "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def differences(spark, con, fn, sql, sf_dir):
    """An empty text when both sides agree, else the first difference."""
    df = fn(spark, sf_dir)
    got_names, got = table_of(df.columns, df.collect())
    res = con.execute(sql)
    sql_types = {d[0]: str(d[1]) for d in res.description}
    want_names, want = table_of([d[0] for d in res.description], res.fetchall())
    if got_names != want_names:
        return f"columns {got_names} / {want_names}"
    for name, kind in df.dtypes:
        if FAMILY.get(kind, sql_types[name]) != sql_types[name]:
            return f"type of {name}: {kind} / {sql_types[name]}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            same = x == y or (isinstance(x, float) and isinstance(y, float)
                              and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9))
            if not same:
                return f"{got_names}: {a} / {b}"
    return ""


def main():
    root = pathlib.Path(__file__).resolve().parents[1]
    sys.path.insert(0, str(root))
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sqls = connect(sf_dir), contract.queries(), contract.oracle_sql()
    names = args or list(queries)
    bad = 0
    for name in names:
        started = time.time()
        try:
            if name in sqls:
                diff = differences(spark, con, queries[name], sqls[name], sf_dir)
            else:
                df = queries[name](spark, sf_dir)
                rows = df.collect()
                diff = "" if rows else "no rows"
                print("   rows only:", len(rows), rows[:2])
        except Exception as e:
            diff = f"{type(e).__name__}: {str(e)[:3000]}"
        bad += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name} {time.time() - started:.2f}s {diff[:3000]}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
