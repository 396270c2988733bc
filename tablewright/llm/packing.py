"""Mixture-controlled packing of documents into sequences of a fixed length.

Each source has a queue of tokens. In every round each queue earns credit: its target share of a
window of tokens. It spends whole tokens, and what is left of its credit, its deficit, is carried
to the next round; a queue that has run dry drops out, and the others go on at their own rates.
Rounds follow each other without gaps, and the stream is cut into sequences of `length` tokens, so
every window holds the target proportions to within a token per source, wherever a partition or
sequence ends. As credit after n rounds is a formula, so is the place of any token: each task
computes the places of its own documents, and no queue is walked from its start.

Every sequence is full. What is left at the end makes sequences whose lengths are falling powers of
two, so there is no padding at all.

The ids are those of the given tokenizer's file, then the end id. No word reaches over a blank, so
texts are split at blanks, each different stretch of some megabytes of text is looked up once in a table
of words filled by the tokenizer itself, and the ids are put in a row by Arrow. The table is bounded and
goes on from task to task in a worker. A text with any character whose treatment could depend on its
surroundings goes to the tokenizer whole.

Defined cases: a null or empty text has the end id alone. A null source is a source of its own.
Rows with equal keys are packed as the separate rows they are; extra columns are ignored. An empty
table gives no pieces. Weights default to the share of tokens to the power `TEMPER`.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import documents, queue_offsets, staged, text_of

LENGTH = 2048
WINDOW_SEQUENCES = 16
TEMPER = 0.7
END_ID = 1
#: Credit is counted in parts of a token.
PARTS = 4096
ROWS_AT_ONCE = 256
#: Texts are looked up together by so many bytes, or one longer text.
TEXT_BYTES = 1 << 23
HELD_WORDS = 1 << 19
#: A word longer than this is not held for later texts.
HELD_CHARS = 64

#: Letters of the two Latin blocks, without those whose lower case is not one letter.
LETTERS = "a-zªµºß-öø-ÿĀ-įı-ſ"
#: Texts of these characters alone are split into words here.
PLAIN = re.compile("[\\t-\\r -~¡-±´-¸º»¿-įı-ſ‐-‧‰-⁞€]*")
PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\\s0-9{LETTERS}]+")


class HeldWords(dict):
    """Ids by word, asked for once and kept; emptied when full."""

    def __init__(self, ask: Callable[[str], bytes]) -> None:
        super().__init__()
        self.ask = ask

    def __missing__(self, word: str) -> bytes:
        ids = self.ask(word)
        if len(self) >= HELD_WORDS:
            self.clear()
        if len(word) <= HELD_CHARS:
            self[word] = ids
        return ids


class WordIds:
    """Ids of texts as little-endian bytes, through a bounded table of words."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.packed = [i.to_bytes(self.dtype.itemsize, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.words = HeldWords(lambda word: (self.by_model if self.direct else self.encoded)([word])[0])

        # Words that are split already need no normaliser: a byte-level model takes each word's bytes as
        # printable characters. The short way is taken where it gives the tokenizer's own ids.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        self.shown = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(sorted({*range(256)} - {*shown}))}
        probe = ["the", "'s", "7", "über", "!!¿", "éèêzxqj", "€", "unseenword"]
        self.direct = self.by_model(probe) == self.encoded(probe)

    def by_model(self, words: list[str]) -> list[bytes]:
        tokenize, shown, packed = self.tokenizer.model.tokenize, self.shown, self.packed
        return [b"".join([packed[t.id] for t in tokenize(w if w.isascii() else w.encode().decode("latin-1").translate(shown))])
                for w in words]

    def encoded(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, self.dtype).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def stretches(self, found: list[str]) -> list[bytes]:
        """Ids of different stretches without blanks, each one word or several."""
        made, split, get = list(map(self.words.get, found)), PIECE.findall, self.words.__getitem__
        for at, ids in enumerate(made):
            if ids is None:
                made[at] = b"".join(map(get, split(found[at])))
        return made

    def column(self, texts: list[str]) -> pa.Array:
        """The ids of each text, a binary column."""
        plain = [PLAIN.fullmatch(t) is not None and "<|" not in t for t in texts]
        low = pa.array([t.lower() if p else "" for t, p in zip(texts, plain, strict=True)], pa.string())
        split = pc.ascii_split_whitespace(low)
        coded = split.values.dictionary_encode()
        ids = pa.array(self.stretches(coded.dictionary.to_pylist()), pa.binary()).take(coded.indices)
        # the ids of a text's stretches lie side by side, so only the bounds between texts are new
        _, bounds, data = ids.buffers()
        bounds = np.frombuffer(bounds, np.int32, len(ids) + 1, 4 * ids.offset)[split.offsets.to_numpy()]
        made = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(bounds), data])
        if all(plain):
            return made
        whole = pa.array(self.encoded([t for t, p in zip(texts, plain, strict=True) if not p]), pa.binary())
        return pc.replace_with_mask(made, pa.array([not p for p in plain]), whole)

    def of(self, texts: list[str]) -> list[bytes]:
        return self.column(texts).to_pylist()


@lru_cache(1)
def held_ids(path: str, changed: float) -> WordIds:
    return WordIds(path)


def word_ids(path: str) -> WordIds:
    """The table of a file, one for all tasks of a worker while the file stays as it is."""
    return held_ids(path, os.path.getmtime(path))


def by_bytes(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """First row and number of rows of runs of up to `most` bytes, or of one row."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield at, stop - at
        at = stop


def tokenized(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", source: str = "source",
              slice_by: Column | None = None, order_by: Column | None = None) -> DataFrame:
    """row_id, doc_id, source, slice, place, n (tokens with the end id), ids (bytes), width (of an
    id). `slice_by` and `order_by` give the queue's order; by default a hash of the row."""
    row_id = F.monotonically_increasing_id()
    rows = docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
        (slice_by if slice_by is not None else F.lit("")).cast("string").alias("slice"),
        (order_by if order_by is not None else F.lit(0)).cast("long").alias("place"),
        text_of(text).alias("text"), row_id.alias("row_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(path)
        end = pa.scalar(np.asarray([END_ID], ids.dtype).tobytes(), pa.binary())
        width = ids.dtype.itemsize
        for batch in batches:
            for at, rows_at_once in by_bytes(batch.column(4), TEXT_BYTES):
                part = batch.slice(at, rows_at_once)
                made = pc.binary_join_element_wise(ids.column(part.column(4).to_pylist()), end, pa.scalar(b"", pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(5), *(part.column(i) for i in range(4)),
                     pc.divide(pc.binary_length(made), width).cast(pa.int64()), made,
                     pa.array(np.full(len(made), width, np.int32))],
                    names=["row_id", "doc_id", "source", "slice", "place", "n", "ids", "width"])

    return rows.mapInArrow(run, "row_id long, doc_id long, source string, slice string, place long, "
                                "n long, ids binary, width int")


def credits(totals: Mapping[str | None, int], weights: Mapping[str | None, float] | None,
            window: int, temper: float = TEMPER) -> tuple[list, np.ndarray, np.ndarray]:
    """Sources in order, their totals, and what each earns per round in parts of a token."""
    names = sorted(totals, key=lambda s: (s is not None, s or ""))
    sizes = np.asarray([totals[s] for s in names], np.int64)
    share = np.asarray([float((weights or {}).get(s, 0)) for s in names]) if weights else sizes.astype(float) ** temper
    if not (share > 0).any():
        share = np.ones(len(names))
    share = np.maximum(share / share.sum(), 1e-6)
    return names, sizes, np.maximum(1, np.rint(share / share.sum() * window * PARTS)).astype(np.int64)


def places(first: np.ndarray, size: np.ndarray, queue: np.ndarray, totals: np.ndarray,
           earned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cut token runs [first, first + size) of queues where a round ends: (run, start within it,
    length, place in the stream)."""
    rate = earned[queue]
    low = -(-(first + 1) * PARTS // rate)
    high = -(-(first + size) * PARTS // rate)
    count = high - low + 1
    run = np.repeat(np.arange(len(first)), count)
    round_ = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[run]
    spent, place = (round_ - 1) * rate[run] // PARTS, np.empty(len(run), np.int64)
    start = np.maximum(spent, first[run])
    stop = np.minimum(round_ * rate[run] // PARTS, first[run] + size[run])
    rounds, which = np.unique(round_, return_inverse=True)
    for at in range(0, len(rounds), 1024):
        some = rounds[at:at + 1024, None]
        before = np.minimum(totals, (some - 1) * earned // PARTS)
        now = np.minimum(totals, some * earned // PARTS) - before
        base = before.sum(1, keepdims=True) + np.cumsum(now, 1) - now
        mine = (which >= at) & (which < at + 1024)
        place[mine] = base[which[mine] - at, queue[run[mine]]]
    live = stop > start
    return run[live], (start - first[run])[live], (stop - start)[live], (place + start - spent)[live]


def sequences(place: np.ndarray, size: np.ndarray, total: int, length: int
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cut runs of the stream where a sequence ends: (run, start within it, length, sequence,
    offset). After the last full sequence come the powers of two of what is left."""
    full, rest = divmod(total, length)
    tail = [1 << b for b in range(length.bit_length(), -1, -1) if rest >> b & 1]
    edges = full * length + np.cumsum([0, *tail])

    def number(at: np.ndarray) -> np.ndarray:
        return np.where(at < full * length, at // length, full + np.searchsorted(edges, at, "right") - 1)

    low, high = number(place), number(place + size - 1)
    count = high - low + 1
    run = np.repeat(np.arange(len(place)), count)
    seq = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[run]
    begin = np.where(seq < full, seq * length, edges[np.clip(seq - full, 0, len(edges) - 1)])
    after = np.where(seq < full, (seq + 1) * length, edges[np.clip(seq - full + 1, 0, len(edges) - 1)])
    start = np.maximum(begin, place[run])
    stop = np.minimum(after, place[run] + size[run])
    return run, start - place[run], stop - start, seq, start - begin


def pack(docs: DataFrame, path: str | None = None, weights: Mapping[str | None, float] | None = None,
         length: int = LENGTH, window_sequences: int = WINDOW_SEQUENCES, text: str = "text",
         key: str = "doc_id", source: str = "source", slice_by: Column | None = None,
         order_by: Column | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source.

    `length` is a power of two. The driver holds one total per source."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    tokens = staged(tokenized(docs, path, text, key, source, slice_by, order_by), "tokens")
    sums = {r[0]: r[1] for r in tokens.groupBy("source").agg(F.sum("n")).collect()}  # one row per source
    names, totals, earned = credits(sums, weights, length * window_sequences)
    number, total = {s: i for i, s in enumerate(names)}, int(totals.sum())
    narrow = tokens.select("row_id", "source", "slice", "place", "n")
    by = F.col("slice") if slice_by is not None else F.pmod(F.xxhash64("row_id"), F.lit(4096))
    starts = queue_offsets(narrow, "source", "n", ["place", "row_id"], by).select("row_id", "queue_start")
    rows = tokens.select("row_id", "doc_id", "source", "n", "ids", "width").join(starts, "row_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                n = part.column(3).to_numpy()
                queue = np.asarray([number[s] for s in part.column(2).to_pylist()], np.int64)
                doc, start, size, place = places(part.column(6).to_numpy(), n, queue, totals, earned)
                cut, more, size, seq, offset = sequences(place, size, total, length)
                doc, start = doc[cut], start[cut] + more
                width = part.column(5)[0].as_py()
                ids = np.frombuffer(b"".join(part.column(4).to_pylist()), f"<u{width}").astype("<u4")
                view, base = memoryview(ids).cast("B"), (np.cumsum(n) - n)[doc] + start
                crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(base.tolist(), (base + size).tolist(), strict=True)]
                pick = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1).take(pick), pa.array(start), pa.array(size), pa.array(crc, pa.int64()),
                     pa.array(n[doc]), pa.array(seq), pa.array(offset), part.column(2).take(pick)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"])

    columns = ["row_id", "doc_id", "source", "n", "ids", "width", "queue_start"]
    return rows.select(*columns).mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
             "offset long, source string")


def op7_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return pack(documents(spark, sf_dir))
