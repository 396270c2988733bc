"""Exact top-k search by inner product over a pivot-distance index.

Inner products become distances: with M the largest norm, a vector gets one more component that
brings its norm to M, a query gets 0 there, and the largest inner product is the smallest distance.
Every vector is keyed by its nearest pivot and its distance to it; vectors sorted by that key are
packed into blocks, each an annulus (pivot, least distance, largest distance). A query first visits
the annuli of its own pivot, which gives it a k-th best score, then annuli of all pivots outwards
from its own distance; by the triangle inequality no annulus farther away than the distance of the
k-th best can hold a better vector, and the search stops there. Scores are exact integers, so
bounds only decide what is visited; they carry a margin for rounding.

Pivots are fitted on a bounded sample (`SAMPLE` vectors, the smallest by a hash of their key);
every vector is indexed. A pivot that holds a third of all vectors only has more blocks. Queries
meet a block in chunks of bounded size.

Defined cases: vectors that are null or hold null or non-finite components take no part; shorter
vectors count as padded with zeros; an empty vector scores 0. Rows are told apart by a number of their
own: a query that is a row of the table has all other rows as candidates, those with its key too, and
repeated query rows get an answer each. For queries from elsewhere the rows with the query's key are no
candidates. Repeated rows are all ranked. With fewer than k candidates all are returned. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.llm.common import staged

PIVOTS, SAMPLE = 32, 4096
BLOCK, CHUNK = 1024, 2048
#: Shares of the stopping distance out to which the rounds after the first go.
RINGS = (0.6, 1.0)


def integer_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """vec_id, v: floor(scale * x) of every component, for the vectors that take part."""
    x = F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (table.where(F.col(f"`{vector}`").isNotNull() & F.coalesce(fine, F.lit(False)))
            .select(F.col(f"`{key}`").cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(c * scale)).alias("v")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as rows of `dim` components."""
    lengths, flat = np.asarray(column.value_lengths()), np.asarray(column.flatten())
    out = np.zeros((len(column), dim), np.int64)
    out[np.repeat(np.arange(len(column)), lengths), np.concatenate([np.arange(n) for n in lengths] or [[]]).astype(int)] = flat
    return out


def fit_pivots(vectors: DataFrame, dim: int, count: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Pivots among a bounded sample, each the farthest from those before."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    points = np.zeros((max(len(rows), 1), dim))
    for i, r in enumerate(rows):
        points[i, :len(r.v)] = r.v
    chosen, gap = [0], np.full(len(points), np.inf)
    for _ in range(count - 1):
        gap = np.minimum(gap, np.linalg.norm(points - points[chosen[-1]], axis=1))
        if gap.max() <= 0:
            break
        chosen.append(int(gap.argmax()))
    return points[chosen]


def _to_pivots(v: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows (v, extra) to the pivots, which lie at 0 in the added component."""
    square = (v * v).sum(1)[:, None] + (extra * extra)[:, None] - 2 * v @ pivots.T + (pivots * pivots).sum(1)
    return np.sqrt(np.maximum(square, 0))


def build_index(vectors: DataFrame, pivots: np.ndarray, norm2: float, dim: int, block: int = BLOCK) -> DataFrame:
    """block_id, pivot, low, high, size, ids, numbers (of the rows), rows (integers, row by row): all
    vectors (vec_id, v, number), packed in the order of (pivot, distance)."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = _matrix(batch.column(1), dim)
            v = whole.astype(float)
            gap = _to_pivots(v, np.sqrt(np.maximum(norm2 - (v * v).sum(1), 0)), pivots)
            at = gap.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(at, pa.int32()), pa.array(gap[np.arange(len(at)), at]),
                 pa.array([r.tobytes() for r in whole], pa.binary()), batch.column(2)],
                names=["vec_id", "pivot", "gap", "row", "number"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, []

        def flush(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([rows[0][1]], pa.int32()), pa.array([rows[0][2]]),
                 pa.array([rows[-1][2]]), pa.array([len(rows)], pa.int32()),
                 *(pa.array([np.asarray([r[i] for r in rows], np.int64).tobytes()], pa.binary()) for i in (0, 4)),
                 pa.array([b"".join(r[3] for r in rows)], pa.binary())],
                names=["block_id", "pivot", "low", "high", "size", "ids", "numbers", "rows"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (len(held) == block or held[0][1] != row[1]):
                    yield flush(held)
                    number, held = number + 1, []
                held.append(row)
        if held:
            yield flush(held)

    keys = vectors.select("vec_id", "v", "number").mapInArrow(
        keyed, "vec_id long, pivot int, gap double, row binary, number long")
    order = ["pivot", "gap", "vec_id", "number"]  # equal rows are spread, too
    return keys.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        packed, "block_id long, pivot int, low double, high double, size int, ids binary, numbers binary, rows binary")


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(ids) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)
    else:
        near = np.arange(len(ids))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


def visit(blocks: DataFrame, visits: DataFrame, asked: DataFrame, k: int, dim: int, chunks: int,
          among_rows: bool) -> DataFrame:
    """Each query's best k in each block it visits. `visits` (staged): block_id, query. A block is sent
    to the chunks of queries that visit it, and to no other."""
    dealt = visits.withColumn("chunk", F.pmod(F.xxhash64("query"), F.lit(chunks)).cast("int"))
    wanted = dealt.groupBy("block_id", "chunk").agg(F.count("*").alias("visitors"))
    spread = blocks.join(wanted, "block_id").select("block_id", "chunk", "ids", "numbers", "rows")
    sent = dealt.join(asked.select("query", "query_id", "q"), "query").select(
        F.col("block_id").alias("to_block"), F.col("chunk").alias("to_chunk"), "query", "query_id", "q")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            ids, numbers = np.frombuffer(left.ids[0], np.int64), np.frombuffer(left.numbers[0], np.int64)
            rows = np.frombuffer(left.rows[0], np.int64).reshape(len(ids), dim)
            queries = np.frombuffer(b"".join(right.q), np.int64).reshape(len(right), dim)
            small = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(dim, 1) < 2 ** 53
            made = queries.astype(float) @ rows.T.astype(float) if small else queries @ rows.T
            for i, (query, key) in enumerate(zip(right["query"], right.query_id)):
                other = np.flatnonzero(numbers != query if among_rows else ids != key)
                at = other[_best(ids[other], made[i, other], k)]
                found.append(pd.DataFrame({"query": query, "query_id": key, "vec_id": ids[at],
                                           "score": made[i, at].astype(np.int64)}))
        columns = ("query", "query_id", "vec_id", "score")
        return pd.concat(found) if found else pd.DataFrame({c: np.zeros(0, np.int64) for c in columns})

    return (spread.groupBy("block_id", "chunk").cogroup(sent.groupBy("to_block", "to_chunk"))
            .applyInPandas(run, "query long, query_id long, vec_id long, score long"))


def top_k(vectors: DataFrame, queries: DataFrame | Column, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest inner products of each query among `vectors`
    (vec_id, v as made by `integer_vectors`).

    `queries` is a condition on the rows of `vectors`, whose candidates are all other rows, or a table of
    vec_id, v, whose candidates are the rows of other keys."""
    among_rows = isinstance(queries, Column)
    number = F.monotonically_increasing_id()
    vectors = staged(vectors.select("vec_id", "v").withColumn("number", number), "vectors")
    queries = staged(vectors.where(queries) if among_rows else
                     queries.select("vec_id", "v").withColumn("number", number), "queries")
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    facts = (vectors.select(F.size("v").alias("n"), norm.alias("norm"))
             .union(queries.select(F.size("v"), F.lit(0.0))).agg(F.max("n").alias("n"), F.max("norm").alias("m")).first())
    dim, norm2 = int(facts.n or 0), float(facts.m or 0.0)
    pivots = fit_pivots(vectors, dim)
    blocks = staged(build_index(vectors, pivots, norm2, dim), "blocks")
    chunks = -(-queries.count() // CHUNK) or 1

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = _matrix(batch.column(1), dim)
            v = whole.astype(float)
            gap = _to_pivots(v, np.zeros(len(v)), pivots)
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(0), pa.array([r.tobytes() for r in whole], pa.binary()),
                 pa.array((v * v).sum(1)), pa.array(gap.argmin(1), pa.int32()), pa.array(list(gap), pa.list_(pa.float64()))],
                names=["query", "query_id", "q", "q2", "own", "gaps"])

    asked = staged(queries.select("vec_id", "v", "number").mapInArrow(
        placed, "query long, query_id long, q binary, q2 double, own int, gaps array<double>"), "asked")
    annuli = blocks.select("block_id", "pivot", "low", "high")
    best_first = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)

    def visited(visits: DataFrame) -> DataFrame:
        return visit(blocks, staged(visits, "visits"), asked, k, dim, chunks, among_rows)

    best = staged(ranked(visited(asked.join(annuli, asked.own == annuli.pivot).select("block_id", "query"))), "best")
    reached = asked.select("query", F.lit(-1.0).alias("reached"))
    for ring in RINGS:
        kth = best.where(F.col("rank") == k).select("query", F.col("score").alias("kth"))
        # without k candidates yet, every annulus can matter
        away = F.sqrt(F.greatest(F.col("q2") + norm2 - 2 * F.col("kth"), F.lit(0.0))) * (1 + 1e-9) + 1e-6
        stop = F.when(F.col("kth").isNull(), F.lit(float("inf"))).otherwise(away)
        bounded = asked.drop("q").join(reached, "query").join(kth, "query", "left").withColumn("stop", stop * ring)
        lines = bounded.select("query", "own", "reached", "stop", F.posexplode("gaps").alias("pivot", "gap"))
        away = F.greatest(F.col("low") - F.col("gap"), F.col("gap") - F.col("high"), F.lit(0.0))
        near = (lines.where(F.col("pivot") != F.col("own")).join(annuli, "pivot")
                .where((away <= F.col("stop")) & (away > F.col("reached"))).select("block_id", "query"))
        reached = staged(bounded.select("query", F.greatest("reached", "stop").alias("reached")), "reached")
        best = staged(ranked(best.drop("rank").union(visited(near))), "best")
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector among all others."""
    vectors = integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, F.col("vec_id") % 20 == 0)


OP4_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(
               list_transform(q.e, lambda x: CAST(x AS DOUBLE)), list_transform(c.e, lambda x: CAST(x AS DOUBLE))) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
     r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
