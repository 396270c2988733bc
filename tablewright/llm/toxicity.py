"""Toxicity scores of whole texts by a convolutional network over hashed word embeddings.

A word's vector is the sum of two rows of one embedding table, picked by hashing the lower-cased
word and its first characters. Filters of widths 1, 2 and 3 run over all words, each filter's
largest value over the whole text is kept, and a logistic output reads them. Training is plain
numpy: only the positions that won a maximum carry a gradient, so a step touches few rows.

The labelled rows that train are a bounded sample (`TRAIN_ROWS`, the smallest by a hash of their
key); scoring covers every row and the whole of every text. A filter of width w is a sum of w table
look-ups per position, since embedding times filter is computed once per table row; a text is
scored in slices of `SLICE` words that overlap by the filter width, so memory does not grow with
its length.

Labels, language, source and key are never inputs of a score. Thresholds per language are fitted on
all labelled rows that did not train (a fifth at least) and only steer `flagged`: the best F1 among
the cuts whose expected share of flagged clean rows stays within `FALSE_ALARMS`. A language without
enough labelled rows for that takes the threshold of all rows.

Defined cases: a null text counts as empty; an empty text has no words, so no filter answers
and it gets the score of the output's bias. Repeated rows get equal scores. Without usable labels
(none, or one class) every score is the share of toxic labels, 0 where there are none. A null key is
never held out. Extra columns are passed on; a column with the scores' name gives way to them. Texts
above `TRAIN_CHARS` characters do not train. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import documents, free_name, staged, text_of

WORD = re.compile(r"\w+")
BUCKETS = 1 << 15
PREFIX = 4
WIDTHS = (1, 2, 3)
FILTERS = 8
DIM = 12
#: Bounds of the training sample in texts and in characters; a text always counts whole.
TRAIN_ROWS, TRAIN_CHARS = 4_000, 24_000_000
EPOCHS, BATCH = 6, 32
SLICE = 1 << 16
HELD_WORDS = 1 << 18
THRESHOLD = 0.3
#: Largest expected share of clean rows that a fitted cut may flag; steps of log odds in which scores are counted.
FALSE_ALARMS, STEPS = 0.02, 64


def bucket(word: str, salt: str, buckets: int = BUCKETS) -> int:
    return zlib.crc32(f"{salt}{word}".encode()) % buckets


class WordRows(dict):
    """Word -> row number of a growing table of (whole-word bucket, prefix bucket) pairs."""

    def __init__(self) -> None:
        super().__init__()
        self.pairs: list[tuple[int, int]] = []

    def __missing__(self, word: str) -> int:
        self.pairs.append((bucket(word, "w"), bucket(word[:PREFIX], "p")))
        self[word] = row = len(self.pairs) - 1
        return row


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


@dataclass
class Network:
    embedding: np.ndarray
    filters: list[np.ndarray] = field(default_factory=list)
    bias: np.ndarray | None = None
    out: np.ndarray | None = None
    out_bias: float = 0.0

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        count = FILTERS * len(WIDTHS)
        return cls(
            rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32),
            [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
            np.zeros(count, np.float32), rng.normal(0, 0.3, count).astype(np.float32), -2.0)

    def word_tables(self, pairs: np.ndarray) -> list[list[np.ndarray]]:
        """For each width and place in the filter: the word's share of the filter's value."""
        vectors = self.embedding[pairs[:, 0]] + self.embedding[pairs[:, 1]]
        return [[vectors @ f[j] for j in range(len(f))] for f in self.filters]

    def maxima(self, tables: list[list[np.ndarray]], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest value of each filter over the words (without bias), and where it is."""
        values, places = [], []
        for per_place in tables:
            width = len(per_place)
            if len(rows) < width:
                values.append(np.full(FILTERS, -np.inf, np.float32))
                places.append(np.zeros(FILTERS, np.int64))
                continue
            n = len(rows) - width + 1
            acts = per_place[0][rows[:n]]
            for j in range(1, width):
                acts += per_place[j][rows[j:j + n]]
            at = acts.argmax(0)
            values.append(acts[at, np.arange(FILTERS)])
            places.append(at)
        return np.concatenate(values), np.concatenate(places)

    def score(self, top: np.ndarray) -> np.ndarray:
        """From rows of maxima to probabilities."""
        hidden = np.maximum(top + self.bias, 0)
        return 1 / (1 + np.exp(-np.clip(hidden @ self.out + self.out_bias, -30, 30)))


def train(texts: list[np.ndarray], pairs: np.ndarray, labels: np.ndarray, seed: int = 7) -> Network:
    """Fit the network with Adam (sparse rows of the embedding by plain Adagrad)."""
    net, rng = Network.fresh(seed), np.random.default_rng(seed)
    dense = [*net.filters, net.bias, net.out]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in dense]
    seen = np.full((BUCKETS, 1), 1e-6, np.float32)
    step = 0
    net.out_bias = float(np.log((labels.mean() + 1e-3) / (1 - labels.mean() + 1e-3)))
    for epoch in range(EPOCHS):
        rate = 0.01 * (1 - epoch / EPOCHS) + 0.001
        order = rng.permutation(len(texts))
        for first in range(0, len(order), BATCH):
            batch = order[first:first + BATCH]
            used, local = np.unique(np.concatenate([texts[i] for i in batch] or [np.zeros(0, int)]),
                                    return_inverse=True)
            tables = net.word_tables(pairs[used])
            cuts = np.cumsum([len(texts[i]) for i in batch])[:-1]
            split = np.split(local, cuts)
            found = [net.maxima(tables, rows) for rows in split]
            top = np.stack([v for v, _ in found])
            hidden = np.maximum(top + net.bias, 0)
            p = net.score(top)
            slope = ((p - labels[batch]) / len(batch)).astype(np.float32)
            grads = [np.zeros_like(x) for x in dense]
            grads[-1] = hidden.T @ slope
            back = slope[:, None] * net.out * (hidden > 0)
            grads[-2] = back.sum(0)
            d_words = np.zeros((len(used), DIM), np.float32)
            vectors = net.embedding[pairs[used, 0]] + net.embedding[pairs[used, 1]]
            for k, (rows, (_, places)) in enumerate(zip(split, found, strict=True)):
                for w, kernel in enumerate(net.filters):
                    if len(rows) < len(kernel):
                        continue
                    cols = slice(w * FILTERS, (w + 1) * FILTERS)
                    g, at = back[k, cols], places[cols]
                    live = np.flatnonzero(g)
                    for j in range(len(kernel)):
                        hit = rows[at[live] + j]
                        grads[w][j][:, live] += (vectors[hit] * g[live, None]).T
                        np.add.at(d_words, hit, (kernel[j][:, live] * g[live]).T)
            step += 1
            for param, grad, (m, v) in zip(dense, grads, moments, strict=True):
                m *= 0.9
                m += 0.1 * grad
                v *= 0.999
                v += 0.001 * grad * grad
                param -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-7)
            net.out_bias -= 0.05 * float(slope.sum())
            touched = np.flatnonzero(np.abs(d_words).sum(1))
            for side in (0, 1):
                at = pairs[used[touched], side]
                unique, place = np.unique(at, return_inverse=True)
                total = np.zeros((len(unique), DIM), np.float32)
                np.add.at(total, place, d_words[touched])
                seen[unique] += (total * total).mean(1, keepdims=True)
                net.embedding[unique] -= 0.05 * total / np.sqrt(seen[unique])
    return net


@dataclass
class Toxicity:
    """A fitted model: the network (None without usable labels), the constant score for that
    case, the general threshold and one per language."""

    network: Network | None
    constant: float
    threshold: float
    by_lang: dict[str, float]

    def score_texts(self, texts: list[str], held: WordRows) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.constant)
        net, found = self.network, [words_of(t) for t in texts]
        if len(held) > HELD_WORDS:
            held.clear()
            held.pairs.clear()
        rows = np.fromiter(map(held.__getitem__, chain.from_iterable(found)), np.int64,
                           sum(map(len, found)))
        used, local = np.unique(rows, return_inverse=True)
        tables = net.word_tables(np.asarray([held.pairs[i] for i in used], np.int64).reshape(-1, 2))
        top = np.full((len(texts), FILTERS * len(WIDTHS)), -np.inf, np.float32)
        lap, start = max(WIDTHS) - 1, 0
        for k, words in enumerate(found):
            for at in range(0, max(len(words) - lap, 1), SLICE):
                piece = local[start + at:start + min(len(words), at + SLICE + lap)]
                top[k] = np.maximum(top[k], net.maxima(tables, piece)[0])
            start += len(words)
        return net.score(top)


def _usable(labels: DataFrame) -> DataFrame:
    """doc_id, _toxic of the labels that may steer the model, and whether they are kept for the cuts."""
    return (labels.where(F.col("toxic").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
            .groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
            .withColumn("_back", F.pmod(F.xxhash64("doc_id", F.lit("cuts")), F.lit(5)) == 4))


def fitting(sized: Iterable[tuple], most: int) -> list:
    """Those of (key, size) that fit into `most` one after the other; one that does not is left out
    and takes no room from the next."""
    out, used = [], 0
    for name, size in sized:
        if used + size <= most:
            out.append(name)
            used += size
    return out


def _sample(docs: DataFrame, usable: DataFrame, text: str, key: str) -> tuple[list[tuple], DataFrame]:
    """Rows (key, text, label) that train, bounded in rows and characters and spread by hash, and
    their keys as a table. The keys are chosen by the lengths of their texts before any text is moved."""
    sizes = (docs.groupBy(F.col(f"`{key}`").alias("doc_id"))
             .agg(F.max(F.char_length(text_of(text))).alias("_size")).where(F.col("_size") <= TRAIN_CHARS))
    drawn = (usable.where(~F.col("_back")).join(sizes, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id")
             .limit(TRAIN_ROWS).select("doc_id", "_toxic", "_size").collect())
    chosen = fitting(((tuple(r[:2]), r[2]) for r in drawn), TRAIN_CHARS)
    keys = docs.sparkSession.createDataFrame(chosen, usable.select("doc_id", "_toxic").schema)
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), text_of(text).alias("_text"))
    found = rows.join(F.broadcast(keys), "doc_id").select("doc_id", "_text", "_toxic").dropDuplicates(["doc_id"])
    return [tuple(r) for r in found.collect()], keys.select("doc_id")


def _level() -> Column:
    """The score's log odds from those of `THRESHOLD`, in whole steps."""
    p = F.least(F.greatest(F.col("score"), F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.floor((F.log(p / (1 - p)) - F.lit(math.log(THRESHOLD / (1 - THRESHOLD)))) * STEPS).cast("long")


def cut_of(levels: list[tuple[int, int, int]]) -> float:
    """From (level, clean rows, toxic rows) the cut of the best F1 among those that keep the bound on
    false alarms: with n clean rows seen and f of them at or above the cut, the next one is expected
    there with a chance of (f + 1) / (n + 1) at most. Too few rows for the bound allow no f at all."""
    levels = sorted(levels)
    at = np.asarray([x[0] for x in levels], np.int64)
    clean, toxic = (np.asarray([x[i] for x in levels], np.int64) for i in (1, 2))
    if not clean.sum():
        return THRESHOLD
    allowed = max(int(FALSE_ALARMS * (clean.sum() + 1) + 1e-9) - 1, 0)
    best, cut = -1.0, math.inf
    edges = [0.0, *((at[1:] + at[:-1] + 1) / 2), at[-1] + 1.0]  # in the middle of the empty levels between
    for edge in edges:
        above = at >= edge
        both, false = int(toxic[above].sum()), int(clean[above].sum())
        f1 = 2 * both / max(both + false + int(toxic.sum()), 1)
        if false <= allowed and f1 > best + 1e-9:
            best, odds = f1, edge / STEPS + math.log(THRESHOLD / (1 - THRESHOLD))
            cut = math.inf if odds > 20.7 else 1 / (1 + math.exp(-odds)) if edge else THRESHOLD
    return cut


def _with_cuts(model: Toxicity, scored: DataFrame, usable: DataFrame, trained: DataFrame, key: str, out: str,
               least_rows: int) -> Toxicity:
    """`model` with cuts from the scores of every usable labelled row that did not train. Only keys,
    languages and scores meet the labels; the driver gets counts by level of score and language."""
    lang = F.col("lang").cast("string") if "lang" in scored.columns else F.lit(None).cast("string")
    rows = scored.select(F.col(f"`{key}`").alias("doc_id"), lang.alias("lang"), F.col(f"`{out}`").alias("score"))
    rest = usable.join(F.broadcast(trained), "doc_id", "left_anti").select("doc_id", "_toxic")
    counts = (rows.join(rest, "doc_id").groupBy("lang", _level().alias("level"))
              .agg(F.sum((F.col("_toxic") == 0).cast("long")), F.sum((F.col("_toxic") == 1).cast("long"))).collect())
    own, every = defaultdict(list), defaultdict(lambda: [0, 0])
    for name, level, clean, toxic in counts:
        own[name].append((level, clean, toxic))
        every[level][0] += clean
        every[level][1] += toxic
    if not every:
        return model
    by_lang = {}
    for name, levels in own.items():
        clean, toxic = (sum(x[i] for x in levels) for i in (1, 2))
        if name and clean and toxic and clean + toxic >= least_rows and FALSE_ALARMS * (clean + 1) >= 1:
            by_lang[name] = cut_of(levels)
    return replace(model, threshold=cut_of([(k, *v) for k, v in every.items()]), by_lang=by_lang)


def fit_and_score(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", out: str = "score",
                  keep: Iterable[str] | None = None, least_rows: int = 40) -> tuple[Toxicity, DataFrame]:
    """The model, and `docs` (the columns `keep`, all by default) with their scores as a staged table.

    Trains on a bounded sample of the labelled rows whose crc32(key) mod 4 is not 2. Then every text
    is scored once, where it lies; a fifth of the labelled rows by hash, and all that the sample leaves
    out, give the thresholds by their scores. The sample and counts by level of score are the only
    things the driver holds."""
    held, texts, marks = WordRows(), [], []
    usable = _usable(labels)
    rows, trained = _sample(docs, usable, text, key)
    for _, body, label in sorted(rows, key=lambda r: zlib.crc32(str(r[0]).encode())):
        texts.append(np.fromiter(map(held.__getitem__, words_of(body)), np.int64))
        marks.append(label)
    y = np.asarray(marks, np.float32)
    if len(set(marks)) < 2:
        model = Toxicity(None, float(y.mean()) if len(y) else 0.0, THRESHOLD, {})
        return model, score(docs, model, text, out, keep)
    pairs = np.asarray(held.pairs, np.int64).reshape(-1, 2)
    model = Toxicity(train(texts, pairs, y), float(y.mean()), THRESHOLD, {})
    scored = staged(score(docs, model, text, out, keep), "scored")
    return _with_cuts(model, scored, usable, trained, key, out, least_rows), scored


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", least_rows: int = 40) -> Toxicity:
    """The model of `fit_and_score` alone; it scores every text once for the thresholds."""
    rows = docs.select(*{key, text, "lang"} & set(docs.columns))
    keep = [c for c in rows.columns if c != text or c == key]
    return fit_and_score(rows, labels, text, key, free_name(rows, "_score"), keep, least_rows)[0]


def score(docs: DataFrame, model: Toxicity, text: str = "text", out: str = "score",
          keep: Iterable[str] | None = None, rows_at_once: int = 256) -> DataFrame:
    """The columns `keep` of `docs` (all by default) with a column of scores, which takes the place of one
    of that name."""
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() != out.lower()]
    rows = docs.select(*[F.col(f"`{c}`") for c in names], text_of(text).alias(free_name(docs, "_text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = WordRows()
        for batch in batches:
            for at in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(at, rows_at_once)
                made = model.score_texts(part.column(len(names)).to_pylist(), held)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(names))), pa.array(made, pa.float64())],
                    names=[*names, out])

    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField(out, T.DoubleType())])
    return rows.mapInArrow(run, schema)


def threshold_of(model: Toxicity, lang: str = "lang", known: bool = True):
    """The threshold of a row's language as a column."""
    cut = F.lit(model.threshold)
    if known and model.by_lang:
        pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in sorted(model.by_lang.items()))
        cut = F.coalesce(F.element_at(F.create_map(*pairs), F.col(f"`{lang}`")), cut)
    return cut


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` whose score stays below the threshold of their language. Rows pass or fail
    where they lie: their texts are scored a second time rather than stored or shuffled with the first
    scores."""
    model, out = fit(docs, labels), free_name(docs, "_score")
    cut = threshold_of(model, known="lang" in docs.columns)
    return score(docs, model, out=out).where(F.col(out) < cut).select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its score, the fixed decision at 0.3, and the language's own decision."""
    docs = documents(spark, sf_dir).select("doc_id", "lang", "text")
    model, scored = fit_and_score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), keep=["doc_id", "lang"])
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        threshold_of(model).alias("lang_threshold"), (F.col("score") >= threshold_of(model)).alias("flagged"))
