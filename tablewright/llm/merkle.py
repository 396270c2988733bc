"""Merkle manifest of a dataset, with a witness for every row.

A row's leaf is the digest of its fields, each behind its length. Per source the leaves, by key, are
joined in runs of `FAN` until one node, the subroot, is left; the subroots, by source, likewise give
the root. A row's witness is what its leaf needs to reach the root: per level the digests left and
right of its own node.

Trees grow by appends. An appended node lies in an open run, whose list of digests is shared by the
witnesses of all nodes in it: what stands before the node is its partial witness at once, and each
later sibling that completes extends it. A full run becomes an append of the next level.

Appends are aligned: the leaves of a source, ranked by a range sort, are dealt into blocks of `FAN` to
the power `HEIGHT`, so blocks are subtrees and any task can append those of its blocks. The roots of
all blocks of a source are appends of the next round, in blocks again, so no task ever holds more than
one block, however large a source is. The subroots are ranked and joined in the same way, as there may
be many. Then rounds are gone through backwards: a block gets the witness of its root, the same for
all its nodes, and extends those of its nodes by it. Texts are read once and never shuffled: a row is
its key, source and digests from the first step on.

Defined cases: a null field is `-`; a null source is a source of its own and comes first; rows with
equal keys are leaves of their own in the order of their digests, null keys first. A table of one row
has its leaf as root and an empty witness. A null key is never tampered with. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import ascii_lower, documents, ranked, staged

FAN = 16
HEIGHT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Of so many rows one is tampered with in the registered query.
TAMPERED = 5

PATH = "array<struct<left:string,right:string>>"
PATH_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def digest_of(parts: Iterable[str]) -> str:
    """H over digests as hexadecimal text."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Run:
    """Neighbouring nodes with one parent. `up` is the parent's place, (run, position), once there is one."""

    __slots__ = ("digests", "up", "above")

    def __init__(self) -> None:
        self.digests: list[str] = []
        self.up: tuple[Run, int] | None = None
        self.above: list[tuple[str, str]] | None = None


class OpenTree:
    """A tree that grows by appends and knows the witness of every node."""

    def __init__(self, fan: int = FAN) -> None:
        self.fan, self.levels = fan, [Run()]

    def append(self, digest: str, level: int = 0) -> tuple[Run, int]:
        """The node's place; its run is shared, so later siblings extend its witness."""
        if level == len(self.levels):
            self.levels.append(Run())
        run = self.levels[level]
        run.digests.append(digest)
        place = run, len(run.digests) - 1
        if len(run.digests) == self.fan:
            self.close(level)
        return place

    def close(self, level: int) -> None:
        run, self.levels[level] = self.levels[level], Run()
        run.up = self.append(digest_of(run.digests), level + 1)

    def root(self, height: int | None = None) -> str:
        """Close what is open, up to one node, or to that of the given height, and return it."""
        level = 0
        while level != height and (height or len(self.levels) > level + 1 or len(self.levels[level].digests) > 1):
            if self.levels[level].digests:
                self.close(level)
            level += 1
        return self.levels[level].digests[0]


def witness(place: tuple[Run, int]) -> list[tuple[str, str]]:
    """The digests left and right of the node at each level of a closed tree, from its own level up."""
    run, at = place
    if run.up is None:
        return []
    if run.above is None:
        run.above = witness(run.up)  # the same for all nodes of the run
    return [("".join(run.digests[:at]), "".join(run.digests[at + 1:])), *run.above]


def fold(digest: str, path: Iterable[tuple[str, str]]) -> str:
    """The root that a leaf and its witness lead to."""
    for left, right in path:
        digest = digest_of((left, digest, right))
    return digest


def leaf_digest(fields: Sequence[Column]) -> Column:
    """H over fields, each `-` if null, else its length in bytes, a colon and its text; as 32 bytes."""
    texts = [c.cast("string") for c in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def _blocks(nodes: DataFrame, span: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("rank") / span).cast("long"))


def _appended(table: pa.Table, fan: int, height: int) -> tuple[pa.Table, list, str]:
    """A block's rows in order, the places of its nodes, and its root. A block of many stops at its height;
    the only one of its tree goes on to one node."""
    table = table.sort_by("rank")
    tree = OpenTree(fan)
    places = [tree.append(d.hex()) for d in table.column("digest").to_pylist()]
    return table, places, tree.root(height if table.column("total")[0].as_py() > fan ** height else None)


def grow(nodes: DataFrame, fan: int, height: int) -> list[tuple[DataFrame, DataFrame]]:
    """The rounds of all trees of `nodes` (tree, rank, total, digest, ...): per round its nodes, with
    their block, and its roots (tree, block, total, digest). A tree ends where its nodes are one block."""
    span, rounds = fan ** height, []

    def climb(table: pa.Table) -> pa.Table:
        rows, _, root = _appended(table, fan, height)
        first = rows.select(["tree", "block", "total"]).slice(0, 1)
        return first.append_column("digest", pa.array([bytes.fromhex(root)], pa.binary()))

    most = nodes.agg(F.max("total")).first()[0]
    while most:
        rows = _blocks(nodes, span)
        roots = staged(rows.select("tree", "block", "rank", "total", "digest").groupBy("tree", "block").applyInArrow(
            climb, "tree string, block long, total long, digest binary"), "roots")
        rounds.append((rows, roots))
        nodes = roots.where(F.col("total") > span).select(
            "tree", F.col("block").alias("rank"), F.ceil(F.col("total") / span).alias("total"), "digest")
        most = -(-most // span) if most > span else 0
    return rounds


def _finished(roots: DataFrame, span: int) -> DataFrame:
    return roots.where(F.col("total") <= span)


def _witnessed(upper: pa.Table) -> tuple[list[tuple[str, str]], str, str]:
    row = upper.to_pylist()[0]
    return [(p["left"], p["right"]) for p in row["path"]], row["subroot"], row["root"]


def descend(rows: DataFrame, upper: DataFrame, keep: Sequence[str], fan: int, height: int) -> DataFrame:
    """The columns `keep` of a round's nodes with their own digest (hex), path, subroot and root. `upper`
    has the path, subroot and root of every block's root."""
    def extend(table: pa.Table, above: pa.Table) -> pa.Table:
        rows, places, _ = _appended(table, fan, height)
        path, subroot, root = _witnessed(above)
        paths = [[{"left": a, "right": b} for a, b in chain(witness(p), path)] for p in places]
        return pa.table({**{c: rows.column(c) for c in keep},
                         "node": pa.array([d.hex() for d in rows.column("digest").to_pylist()]),
                         "path": pa.array(paths, PATH_TYPE), "subroot": pa.array([subroot] * len(paths)),
                         "root": pa.array([root] * len(paths))})

    kept = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in keep)
    return (rows.groupBy("tree", "block").cogroup(upper.groupBy("tree", "block"))
            .applyInArrow(extend, f"{kept}, node string, path {PATH}, subroot string, root string"))


def _crowned(rounds: list[tuple[DataFrame, DataFrame]], crowns: DataFrame, fan: int, height: int) -> DataFrame:
    """tree, block, path, subroot, root of the blocks of the first round. `crowns` has a row per tree."""
    upper = None
    for nth in reversed(range(len(rounds))):
        ends = _finished(rounds[nth][1], fan ** height).select("tree", "block")
        here = crowns.join(ends, "tree").select("tree", "block", "path", "subroot", "root")
        upper = here if upper is None else here.unionByName(upper)
        if nth:
            upper = staged(upper, "upper")
            upper = descend(rounds[nth][0], upper, ["tree", "rank"], fan, height).select(
                "tree", F.col("rank").alias("block"), "path", "subroot", "root")
    return staged(upper, "upper")


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", source: str = "source",
             text: str = "text", tampered: Column | None = None, with_path: bool = False, fan: int = FAN,
             height: int = HEIGHT) -> DataFrame:
    """One row per row of `docs`: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified; and
    path, the witness, if asked for.

    Where `tampered` holds, the leaf that is folded is that of the row with A-Z lowered in its text."""
    cols = {c: F.col(f"`{c}`") for c in dict.fromkeys([*fields, key, source, text])}
    altered = leaf_digest([ascii_lower(cols[c]) if c == text else cols[c] for c in fields])
    changed = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    leaves = staged(docs.select(
        cols[key].cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), cols[source].cast("string")), F.lit("")).alias("tree"),
        leaf_digest([cols[c] for c in fields]).alias("digest"), F.when(changed, altered).alias("altered"),
        F.monotonically_increasing_id().alias("row")), "leaves")
    rounds = grow(ranked(leaves, "tree", ["doc_id", "digest", "row"]), fan, height)
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    schema += f", path {PATH}" if with_path else ""
    if not rounds:
        return docs.sparkSession.createDataFrame([], schema)

    span = fan ** height
    ends = [_finished(roots, span).select(F.col("tree").alias("name"), "digest") for _, roots in rounds]
    subroots = ends[0]
    for more in ends[1:]:
        subroots = subroots.unionByName(more)
    crown = grow(ranked(subroots.withColumn("tree", F.lit("")), "tree", ["name"]), fan, height)
    top = crown[-1][1].select("tree", F.expr(f"cast(array() as {PATH})").alias("path"),
                              F.lower(F.hex("digest")).alias("subroot"), F.lower(F.hex("digest")).alias("root"))
    crowns = staged(descend(crown[0][0], _crowned(crown, top, fan, height), ["name"], fan, height).select(
        F.col("name").alias("tree"), "path", F.col("node").alias("subroot"), "root"), "crowns")
    upper = _crowned(rounds, crowns, fan, height)

    def proofs(table: pa.Table, above: pa.Table) -> pa.Table:
        rows, places, _ = _appended(table, fan, height)
        path, subroot, root = _witnessed(above)
        leaf = [d.hex() for d in rows.column("digest").to_pylist()]
        paths = [[*witness(p), *path] for p in places]
        folded = [fold(d.hex() if d else own, p)
                  for own, d, p in zip(leaf, rows.column("altered").to_pylist(), paths, strict=True)]
        out = {"doc_id": rows.column("doc_id"), "leaf": pa.array(leaf), "subroot": pa.array([subroot] * len(leaf)),
               "root": pa.array([root] * len(leaf)),
               "proof_sha256": pa.array([digest_of(chain.from_iterable(p)) for p in paths]),
               "folded_root": pa.array(folded), "verified": pa.array([f == root for f in folded])}
        if with_path:
            out["path"] = pa.array([[{"left": a, "right": b} for a, b in p] for p in paths], PATH_TYPE)
        return pa.table(out)

    return (rounds[0][0].groupBy("tree", "block").cogroup(upper.groupBy("tree", "block"))
            .applyInArrow(proofs, schema))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its leaf, roots, proof, and what a partly tampered copy folds to."""
    key = F.col("doc_id").cast("string").cast("binary")
    return manifest(documents(spark, sf_dir), tampered=F.crc32(key) % TAMPERED == 0)


_FIELD = "coalesce(octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = " || ".join(_FIELD.format(c) for c in FIELDS)
_LOWERED = _LEAF.replace("text::", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')::")
#: The public CRC-32 (polynomial EDB88320 reflected), a bit at a time.
_CRC = """xor(4294967295, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
  lambda crc, byte: list_reduce(range(1, 9), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END),
                                xor(crc, byte)), 4294967295::BIGINT))"""


def _grown(name: str, leaves: str) -> str:
    """A recursive table of all nodes of the trees over (tree, idx, digest)."""
    return f"""{name} AS (
  SELECT tree, 0::BIGINT AS lvl, idx, digest, count(*) OVER (PARTITION BY tree) AS n FROM {leaves}
  UNION ALL
  SELECT tree, lvl + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (n + 15) // 16
  FROM {name} WHERE n > 1 GROUP BY tree, lvl, idx // 16, n),
{name}_sides AS (
  SELECT tree, lvl, idx, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name} WHERE n > 1 WINDOW w AS (PARTITION BY tree, lvl, idx // 16 ORDER BY idx)),
{name}_root AS (SELECT tree, digest FROM {name} WHERE n = 1)"""


OP13_SQL = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, coalesce('s' || source, '') AS tree, sha256({_LEAF}) AS leaf, sha256({_LOWERED}) AS lowered,
         coalesce({_CRC} % {TAMPERED} = 0, false) AS changed FROM documents),
leaves AS (SELECT *, leaf AS digest, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM rows),
{_grown("low", "leaves")},
tops AS (SELECT '' AS tree, tree AS name, digest, row_number() OVER (ORDER BY tree) - 1 AS idx FROM low_root),
{_grown("high", "tops")},
folds AS (
  SELECT doc_id, idx AS nth, tree AS name, 0::BIGINT AS part, tree, 0::BIGINT AS lvl, idx,
         CASE WHEN changed THEN lowered ELSE leaf END AS digest, '' AS proof FROM leaves
  UNION ALL
  SELECT f.doc_id, f.nth, f.name, CASE WHEN s.tree IS NULL THEN f.part + 1 ELSE f.part END,
         CASE WHEN s.tree IS NULL THEN '' ELSE f.tree END, CASE WHEN s.tree IS NULL THEN 0 ELSE f.lvl + 1 END,
         CASE WHEN s.tree IS NULL THEN t.idx ELSE f.idx // 16 END,
         CASE WHEN s.tree IS NULL THEN f.digest ELSE sha256(s.l || f.digest || s.r) END,
         CASE WHEN s.tree IS NULL THEN f.proof ELSE f.proof || s.l || s.r END
  FROM folds f
  LEFT JOIN (SELECT 0 AS part, * FROM low_sides UNION ALL SELECT 1, * FROM high_sides) s
    ON s.part = f.part AND s.tree = f.tree AND s.lvl = f.lvl AND s.idx = f.idx
  LEFT JOIN tops t ON t.name = f.name
  WHERE f.part < 2)
SELECT l.doc_id, l.leaf, u.digest AS subroot, h.digest AS root, sha256(f.proof) AS proof_sha256,
       f.digest AS folded_root, f.digest = h.digest AS verified
FROM leaves l JOIN low_root u ON u.tree = l.tree CROSS JOIN high_root h
JOIN folds f ON f.part = 2 AND f.name = l.tree AND f.nth = l.idx
"""
