"""Bulk-synchronous best-fit packing.

Documents become pieces: a document of at most `length` tokens is one piece, a longer one is cut into
pieces of `length`, the first of which may be shorter. Pieces are range-sorted by size, which gives
each its rank among those of its size. Gaps, the space left in open sequences, are kept sorted by
size as well, as runs of neighbouring sequences with equal gaps.

A superstep takes all pieces of one size, the largest first, and sweeps over the gaps from the
smallest that holds one, its successor in the order, upward. Where pieces compete for a gap, the lower
rank gets it and the others go on to the next run; each sequence of a run takes as many pieces as fit,
as they are still its best fit. What finds no gap opens new sequences. Then the gaps shrink and the
next superstep begins, so the result is that of best-fit decreasing over all pieces one by one.

Sizes are whole numbers of at most `length`, so pieces of one size can stand for each other: a
superstep needs their number alone, and settles runs, not pieces. The driver holds one count per size
and some thousand runs, whatever the size of the table. The pieces themselves are placed where they
lie: each task sweeps over its own by (size, rank). Ids are made once, beside the check sums of the
pieces; only these narrow rows are sorted.

Defined cases: a null or empty text has the end id alone. Equal keys and repeated rows are packed as
the separate documents they are. Extra columns are ignored. An empty table gives no pieces. Order
among pieces of one size is by key, piece and check sum.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import documents, ranked, staged, text_of

LENGTH = 2048
END_ID = 0
ROWS_AT_ONCE = 256
#: The fast splitter recurses over blanks, so texts with a longer run of them take the other way.
BLANKS = re.compile(r"\s{4096}")


class ByteIds:
    """Ids of texts by the tokenizer's file; by the same vocabulary as ranks where that is given, which
    takes a fifth of the time. Texts with a special token's string, or with blanks without end, go to
    the tokenizer itself."""

    def __init__(self, path: str, ranks: str | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                          special_tokens={})

    def of(self, text: str) -> np.ndarray:
        if self.fast and not any(s in text for s in self.special) and not BLANKS.search(text):
            return np.asarray(self.fast.encode_ordinary(text), "<u4")
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")


def pieces_of(docs: DataFrame, path: str, ranks: str | None = None, length: int = LENGTH, text: str = "text",
              key: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), text_of(text).alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ByteIds(path, ranks)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part, made = batch.slice(at, ROWS_AT_ONCE), []
                for doc, value in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    own = np.append(ids.of(value), np.asarray([END_ID], "<u4"))
                    view = memoryview(own).cast("B")
                    cuts = [0, *range(len(own) % length or length, len(own) + 1, length)]
                    made += [(doc, i, a, b - a, zlib.crc32(view[4 * a:4 * b]))
                             for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if n == "piece" else pa.int64())
                     for n, c in zip(names, zip(*made, strict=True), strict=True)], names=names)

    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


@dataclass(frozen=True)
class Match:
    """Pieces of `size` from rank `first` on go to the sequences from `sequence` on, `each` to one,
    behind `fill` tokens."""

    size: int
    first: int
    each: int
    sequence: int
    fill: int


def supersteps(counts: Mapping[int, int], length: int = LENGTH) -> tuple[list[Match], int]:
    """The matches of all supersteps, by size (largest first) and rank, and the number of sequences."""
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by gap: (first sequence, sequences)
    gaps: list[int] = []  # those that have runs, ascending
    matches, opened = [], 0
    for size in sorted(counts, reverse=True):
        first, left = 0, counts[size]
        while left:
            at = bisect_left(gaps, size)
            if at < len(gaps):
                gap = gaps[at]
                sequence, held = runs[gap].pop()
                if not runs[gap]:
                    gaps.pop(at)
            else:
                gap, each = length, length // size
                sequence, held = opened, -(-left // each)
                opened += held
            each = min(gap // size, left)
            used = min(held, left // each)
            matches.append(Match(size, first, each, sequence, length - gap))
            for rest, start, n in ((gap - each * size, sequence, used), (gap, sequence + used, held - used)):
                if n and rest:
                    if not runs[rest]:
                        insort(gaps, rest)
                    runs[rest].append((start, n))
            first += used * each
            left -= used * each
    return matches, opened


def pack(docs: DataFrame, path: str | None = None, ranks: str | None = None, length: int = LENGTH,
         text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Without a path, ids are those of the public byte-level vocabulary; `ranks` names the same vocabulary
    as ranks."""
    if path is None:
        path = public_tokenizers.path("byte_bpe_50k.json")
        ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pieces = staged(pieces_of(docs, path, ranks, length, text, key)
                    .withColumn("row", F.monotonically_increasing_id()), "pieces")
    sorted_ = ranked(pieces, "length", ["doc_id", "piece", "ids_crc32", "row"])
    counts = {r[0]: r[1] for r in sorted_.groupBy("length").agg(F.count("*")).collect()}  # `length` rows at most
    matches, _ = supersteps(counts, length)
    # the matches in the order of the sorted pieces
    table = np.asarray([(m.size, m.first, m.each, m.sequence, m.fill)
                        for m in sorted(matches, key=lambda m: (m.size, m.first))], np.int64).reshape(-1, 5).T.copy()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, firsts, each, sequence, fill = table
        edges = np.searchsorted(sizes, np.arange(length + 2))  # matches of one size
        for batch in batches:
            size, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.empty(len(size), np.int64)
            for s in np.unique(size):
                mine = size == s
                own = firsts[edges[s]:edges[s + 1]]
                at[mine] = edges[s] + np.searchsorted(own, rank[mine], "right") - 1
            nth = rank - firsts[at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence[at] + nth // each[at]),
                 pa.array(fill[at] + nth % each[at] * size)], names=names)

    return sorted_.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return pack(documents(spark, sf_dir))
