"""Near duplicates by DartMinHash signatures of word shingles.

Every shingle of a document owns a region of unit width per unit of weight. Darts fall on a region
as a Poisson process whose times and coordinates are hashes of the shingle, so all documents that
hold the shingle see the same darts. A signature keeps the earliest dart of each coordinate; two
signatures agree in a coordinate with probability equal to the weighted Jaccard similarity. Darts
are only thrown until about k ln k + 2k have landed (later while a coordinate is empty), so a
signature costs its shingles plus a number of darts that does not depend on the document.

Bands of coordinates give buckets; documents that share a bucket are compared exactly, by their shingle
sets, and linked at `SIMILARITY` or more. Classes are the connected components of the links. Documents
with equal shingle sets are one node from the start, so copies cost nothing further, and of buckets
with the same members one is kept.

Shingle sets are made once and brought together by bucket; no pair of documents is ever a row. A bucket
of up to `BLOCK_NODES` nodes and `BLOCK_SHINGLES` shingles is one block, and all its pairs are compared
by a product of matrices over the shingles that at least two of them hold. A larger bucket is dealt
into blocks by hash. First its two heads, the ends of an order of its own, go to all its blocks and are
compared with every member: members x 2. Classes found so are contracted. What is left are the members
outside the bucket's largest class: they are compared with all members, block by block, so no link of a
bucket is lost, and near copies, whatever their number, cost two comparisons each. A block hands on as
many links as join its classes, never more than it has members.

A pair at the similarity asked for shares no bucket, and is missed, with a chance of `MISSED` at most;
`plan_bands` derives the bands from the similarity.

With `weighted`, a shingle counts as often as it occurs, in signatures and in the similarity.

Defined cases: a null text counts as empty; a text without words is a class of its own; a text of
fewer than five words is one shingle. Equal rows are members of one class. Of a class the row with
the smallest (doc_id, row) stays; a null doc_id counts as smallest. Extra columns are passed on by
`drop_near_copies`. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import documents, keep_rows, staged, text_of

WORDS, SIMILARITY = 5, 0.8
#: Chance that a pair at the similarity asked for is missed, and the most bands.
MISSED, MOST_BANDS = 4e-5, 26
WORD = re.compile(r"\w+")
ROWS_AT_ONCE = 512
HELD_WORDS = 1 << 18
#: Bounds of what one comparison holds; a single document may exceed the second.
BLOCK_NODES, BLOCK_SHINGLES = 1024, 1 << 18
COLUMNS_AT_ONCE = 4096
EMPTY = np.zeros(0, np.uint64)


def plan_bands(similarity: float, missed: float = MISSED, most: int = MOST_BANDS) -> tuple[int, int]:
    """Bands, and coordinates a band: the longest bands of which `most` at most miss a pair at that
    similarity with a chance of `missed`."""
    def needed(rows: int) -> int:
        return max(math.ceil(math.log(missed) / math.log1p(-min(similarity ** rows, 1 - 1e-12))), 1)

    rows = 1
    while rows < 16 and needed(rows + 1) <= most:
        rows += 1
    return needed(rows), rows


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (wraps around)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Shingles of texts as 64-bit hashes, through a bounded table of word hashes."""

    def __init__(self, words: int = WORDS) -> None:
        self.width, self.words = words, {}
        self.turn = mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)

    def all_of(self, text: str) -> np.ndarray:
        """One hash per place in the text, repeats included."""
        found = WORD.findall(text.lower())
        if not found:
            return EMPTY
        held = self.words
        if len(held) > HELD_WORDS:
            held.clear()
        for w in set(found):
            if w not in held:
                held[w] = xxhash.xxh64_intdigest(w)
        hashes = np.fromiter(map(held.__getitem__, found), np.uint64, len(found))
        n = max(len(hashes) - self.width + 1, 1)
        total = np.zeros(n, np.uint64)
        for j in range(min(self.width, len(hashes))):
            total += mix(hashes[j:j + n] * self.turn[j])
        return mix(total)

    def set_of(self, text: str, weighted: bool = False) -> np.ndarray:
        """The distinct shingles; with weights, the c-th unit of a shingle is an element of its own, so
        the Jaccard similarity of the sets is the weighted one of the texts."""
        own, counts = np.unique(self.all_of(text), return_counts=True)
        if not weighted:
            return own
        unit = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.sort(mix(np.repeat(own, counts) + unit.astype(np.uint64)))


def _gap(element: np.ndarray, dart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Time from the dart before to this one, and a hash for its coordinate."""
    h = mix(element + dart.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return -np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53), mix(h)


def signatures(elements: np.ndarray, doc: np.ndarray, docs: int, k: int) -> np.ndarray:
    """Earliest dart of each coordinate, by its time, for `docs` documents whose unit regions are
    `elements` (hash) and `doc` (number). Times tell darts apart. Documents without elements
    keep infinity."""
    best = np.full(docs * k, np.inf)
    weight = np.bincount(doc, minlength=docs)
    limit = (k * math.log(k) + 2 * k) / np.maximum(weight, 1)
    dart = np.zeros(len(elements), np.int64)
    time, coord = _gap(elements, dart)
    pending = np.arange(len(elements))
    while len(pending):
        live = pending[time[pending] <= limit[doc[pending]]]
        while len(live):
            np.minimum.at(best, doc[live] * k + (coord[live] % np.uint64(k)).astype(np.int64), time[live])
            dart[live] += 1
            gap, coord[live] = _gap(elements[live], dart[live])
            time[live] += gap
            live = live[time[live] <= limit[doc[live]]]
        short = np.isinf(best).reshape(docs, k).any(1) & (weight > 0)
        limit[short] *= 2
        pending = pending[short[doc[pending]]]
    return best.reshape(docs, k)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band."""
    bits = signature.view(np.uint64).reshape(len(signature), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), bits.shape[:2]).copy()
    for j in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, j])
    return keys.view(np.int64)


def signed(docs: DataFrame, text: str = "text", key: str = "doc_id", weighted: bool = False,
           similarity: float = SIMILARITY) -> DataFrame:
    """row_id, doc_id, text_digest, n (elements of the set), set_digest, bands (keys; none without words)."""
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(f"`{key}`").alias("doc_id"),
                       F.unhex(F.sha2(text_of(text).cast("binary"), 256)).alias("text_digest"),
                       text_of(text).alias("text"))
    count, width = plan_bands(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                regions = [shingles.set_of(body, weighted) for body in part.column(3).to_pylist()]
                digests = [xxhash.xxh3_128_digest(own.tobytes()) if len(own) else b"%d" % row
                           for row, own in zip(part.column(0).to_pylist(), regions, strict=True)]
                sizes = [len(r) for r in regions]
                doc = np.repeat(np.arange(len(regions)), sizes)
                keys = band_keys(signatures(np.concatenate(regions), doc, len(regions), count * width), count, width)
                bands = [k if n else [] for k, n in zip(keys, sizes, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(sizes, pa.int32()),
                     pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["row_id", "doc_id", "text_digest", "n", "set_digest", "bands"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row_id long, doc_id {kind}, text_digest binary, n int, "
                                "set_digest binary, bands array<long>")


def shingle_sets(texts: DataFrame, weighted: bool) -> DataFrame:
    """node, elements (the set as bytes) from node, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                sets = [shingles.set_of(t, weighted).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["node", "elements"])

    return texts.select("node", "text").mapInArrow(run, "node long, elements binary")


def shared_counts(sets: list[np.ndarray], probes: int) -> np.ndarray:
    """Elements that each of the first `probes` sets shares with each set."""
    if len(sets) <= 3:
        return np.asarray([[len(np.intersect1d(a, b, assume_unique=True)) for b in sets] for a in sets[:probes]])
    sizes = np.asarray([len(x) for x in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    asked = np.bincount(column[row < probes], minlength=len(held)) > 0
    live = asked & (held > 1)  # of an element that one set alone holds nothing is shared
    number = np.cumsum(live) - 1
    at = live[column]
    row, column = row[at], number[column[at]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((probes, len(sets)))
    width = int(live.sum())
    for first in range(0, width, COLUMNS_AT_ONCE):
        low, high = np.searchsorted(column, [first, first + COLUMNS_AT_ONCE])
        block = np.zeros((len(sets), min(COLUMNS_AT_ONCE, width - first)), np.float32)
        block[row[low:high], column[low:high] - first] = 1
        out += block[:probes] @ block.T
    return out


def block_links(labels: np.ndarray, sets: list[np.ndarray], probes: int, similarity: float) -> list[tuple[int, int]]:
    """Links between the labels of a block that join its classes as all links between its first `probes`
    rows and all its rows do."""
    sizes = np.asarray([len(x) for x in sets], float)
    both = shared_counts(sets, probes)
    near = (both > 0) & (both >= similarity * (sizes[:probes, None] + sizes[None, :] - both))
    names, own = np.unique(labels, return_inverse=True)
    links = []
    for p in range(probes):
        others = np.unique(own[near[p]])
        others = others[others != own[p]]
        if len(others):
            links += [(int(names[own[p]]), int(names[o])) for o in others]
            own[np.isin(own, others)] = own[p]
    return links


def compared(rows: DataFrame, similarity: float) -> DataFrame:
    """a, b: links between labels, from (bucket, part, probe, node, label, elements). Of each (bucket,
    part) the probes are compared with all rows; where there are none, all are."""
    dealt = rows.repartition("bucket", "part").sortWithinPartitions("bucket", "part", F.desc("probe"), "node").select(
        "bucket", "part", "probe", "label", "elements")

    def links(labels: list, probes: list, sets: list) -> list[tuple[int, int]]:
        return block_links(np.asarray(labels), sets, sum(probes) or len(sets), similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, labels, probes, sets, out = None, [], [], [], []
        for batch in batches:
            for bucket, part, probe, label, elements in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (bucket, part) != last:
                    if last is not None:
                        out += links(labels, probes, sets)
                    last, labels, probes, sets = (bucket, part), [], [], []
                labels.append(label)
                probes.append(probe)
                sets.append(np.frombuffer(elements, np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
            out = []
        if last is not None:
            out = links(labels, probes, sets)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node, label (smallest node of its component) for the nodes of the links. Labels spread to
    neighbours and jump to the label's own label until nothing changes."""
    ways = staged(links.select("a", "b").union(links.select("b", "a")).distinct(), "ways")
    labels = staged(ways.groupBy("a").agg(F.min("b").alias("m"))
                    .select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = (ways.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("m")))
        spread = (labels.join(near.withColumnRenamed("a", "node"), "node")
                  .select("node", "label", F.least("label", "m").alias("next")))
        of = labels.select(F.col("node").alias("next"), F.col("label").alias("jump"))
        new = staged(spread.join(of, "next").select("node", F.least("next", "jump").alias("label"),
                                                    (F.least("next", "jump") < F.col("label")).alias("moved")), "labels")
        labels = new.select("node", "label")
        if new.where("moved").isEmpty():
            return labels


def _blocks(nodes: Column, shingles: Column) -> Column:
    return F.greatest(F.ceil(nodes / BLOCK_NODES), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def _block_of(node: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.col(node), F.lit("block")), blocks).cast("int")


def linked(nodes: DataFrame, texts_of, similarity: float = SIMILARITY, weighted: bool = False) -> DataFrame:
    """node, label of the linked nodes among (node, n, text_digest, bands). `texts_of` gives the texts of
    a table of nodes."""
    spread = nodes.select("node", "n", "text_digest", F.explode("bands").alias("bucket"))
    alike = ["members", "weight", *(f"mark{i}" for i in range(2))]
    buckets = (spread.groupBy("bucket").agg(
        F.count("*").alias("members"), F.sum("n").alias("weight"),
        *[F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"mark{i}") for i in range(2)],
        *[e(F.struct(F.xxhash64("node", "bucket"), F.col("node"))).getField("node").alias(f"head{i}")
          for i, e in enumerate((F.min, F.max))])
        .where("members > 1").groupBy(*alike)
        .agg(F.min(F.struct("bucket", "head0", "head1")).alias("b"))  # of equal buckets one
        .select("b.*", _blocks(F.col("members"), F.col("weight")).alias("blocks")))
    members = staged(spread.join(buckets, "bucket").select(
        "bucket", "node", "n", "text_digest", "blocks", "head0", "head1"), "members")
    sets = staged(shingle_sets(texts_of(members.select("node", "text_digest").distinct()), weighted), "sets")
    rows = members.drop("text_digest").join(sets, "node")

    whole = rows.where("blocks = 1").select("bucket", F.lit(0).alias("part"), F.lit(False).alias("probe"), "node",
                                            F.col("node").alias("label"), "elements")
    large = rows.where("blocks > 1")
    is_head = F.col("node").isin(F.col("head0"), F.col("head1"))
    dealt = large.select("bucket", _block_of("node", F.col("blocks")).alias("part"), F.lit(False).alias("probe"), "node",
                         F.col("node").alias("label"), "elements")
    heads = large.where(is_head).select("bucket", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"),
                                        F.lit(True).alias("probe"), "node", F.col("node").alias("label"), "elements")
    links = staged(compared(whole.unionByName(dealt).unionByName(heads), similarity), "links")
    labels = components(links)

    rest = members.where("blocks > 1")
    if rest.isEmpty():
        return labels
    classed = staged(rest.join(labels, "node", "left").select(
        "bucket", "node", "n", F.coalesce("label", "node").alias("label")), "classed")
    per_class = classed.groupBy("bucket", "label").agg(F.count("*").alias("members"), F.sum("n").alias("weight"))
    split = (per_class.groupBy("bucket").agg(
        F.max_by("label", F.struct("members", "label")).alias("most"), F.sum("members").alias("members"),
        F.sum("weight").alias("weight"), F.max("members").alias("inside"), F.count("*").alias("classes"),
        F.max_by("weight", F.struct("members", "label")).alias("inside_weight"))
        .where("classes > 1").select(
            "bucket", "most", _blocks(F.col("members"), F.col("weight")).alias("blocks"),
            _blocks(F.col("members") - F.col("inside"), F.col("weight") - F.col("inside_weight")).alias("outside")))
    left = staged(classed.join(split, "bucket"), "left")
    if left.isEmpty():
        return labels
    # a part is a block of outsiders with a block of all
    first, second = (F.sequence(F.lit(0), F.col(c) - 1) for c in ("outside", "blocks"))
    probes = left.where("label <> most").select(
        "bucket", F.explode(F.transform(second, lambda j: j * F.col("outside") + _block_of("node", F.col("outside"))))
        .alias("part"), F.lit(True).alias("probe"), "node", "label")
    others = left.select(
        "bucket", F.explode(F.transform(first, lambda i: _block_of("node", F.col("blocks")) * F.col("outside") + i))
        .alias("part"), F.lit(False).alias("probe"), "node", "label")
    more = staged(compared(probes.unionByName(others).join(sets, "node"), similarity), "links")
    if more.isEmpty():
        return labels
    merged = components(more).select(F.col("node").alias("label"), F.col("label").alias("merged"))
    # a class of one node has no label yet
    known = labels.unionByName(merged.join(labels, "label", "left_anti").select(F.col("label").alias("node"), "label"))
    return staged(known.join(merged, "label", "left").select("node", F.coalesce("merged", "label").alias("label")), "labels")


def near_classes(docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = SIMILARITY,
                 weighted: bool = False) -> DataFrame:
    """One row per document: row_id, doc_id, text_digest, class_row, class_id (doc_id of the class's
    smallest row), class_size, kept, shingles."""
    rows = staged(signed(docs, text, key, weighted, similarity), "signed")
    nodes = staged(rows.groupBy("set_digest").agg(
        F.min("row_id").alias("node"), F.min_by("text_digest", "row_id").alias("text_digest"),
        F.min_by("bands", "row_id").alias("bands"), F.first("n").alias("n")), "nodes")

    def texts_of(wanted: DataFrame) -> DataFrame:
        # node and digest go together, so one text per digest serves every node of that digest
        bodies = docs.select(F.unhex(F.sha2(text_of(text).cast("binary"), 256)).alias("text_digest"),
                             text_of(text).alias("text"))
        found = bodies.join(wanted.select("text_digest").distinct(), "text_digest", "left_semi")
        return wanted.join(found.dropDuplicates(["text_digest"]), "text_digest").select("node", "text")

    labels = linked(nodes, texts_of, similarity, weighted)
    classed = staged(
        rows.join(nodes.select("set_digest", "node"), "set_digest").join(labels, "node", "left")
        .select("row_id", "doc_id", "text_digest", "n", F.coalesce("label", "node").alias("class_row")), "classed")
    heads = staged(classed.groupBy("class_row").agg(
        F.min(F.struct("doc_id", "row_id")).alias("head"), F.count("*").alias("class_size")), "classes")
    return classed.join(heads, "class_row").select(
        "row_id", "doc_id", "text_digest", "class_row", F.col("head.doc_id").alias("class_id"), "class_size",
        (F.col("row_id") == F.col("head.row_id")).alias("kept"), F.col("n").alias("shingles"))


def drop_near_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of `docs` that stay, one of each class, in their columns."""
    decided = staged(near_classes(docs, text, key).withColumnRenamed("text_digest", "digest"), "decided")
    return keep_rows(docs, decided, key, F.unhex(F.sha2(text_of(text).cast("binary"), 256)))


def op3_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its near-duplicate class, and whether it is the one that stays."""
    return near_classes(documents(spark, sf_dir)).select(
        "doc_id", "class_id", "class_size", "kept", "shingles")
