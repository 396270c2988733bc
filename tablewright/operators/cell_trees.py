"""Forests and boosted trees fitted on cells instead of rows (MDL4-MDL6 for large tables).

Trees of `pyspark.ml` compare a feature only with at most `maxBins` - 1 candidate cuts, so rows that lie
between the same cuts in every feature and have the same label and weight are one row to them: a cell,
with the number of its rows. The trees grown here follow the same rules over cells: candidate cuts,
impurity, gain, least rows of a node, pruning, rounds of boosting. A forest draws the copies of a cell
as a Poisson number with the cell's rows as mean, which is what a draw for each of its rows adds up to.

Few features give few cells at any number of rows. Where cells are as many as rows, blocks of them stay
distributed, and no step holds more than one block, a node of at most `LOCAL_CELLS` cells or the sums of
a level.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.cleaning import col_of
from tablewright.session import scratch_path, staged

# As in `llm`, the functions travel to the Python workers by value: executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Cells of a block, up to 64 blocks; beyond that a million.
BLOCK_CELLS = 100_000
#: Cells of a node up to which one task grows the rest of its tree.
LOCAL_CELLS = 2_000_000
#: Trees whose upper levels are searched in one pass over the blocks.
TREES_AT_ONCE = 20
#: Rounds of boosting after which the margins are computed from all trees anew, which ends their lineage.
ROUNDS_CHAINED = 20
#: Impurity below which a node is pure.
PURE = 2.0 ** -52
#: The rows sampled for candidate cuts are this many, or the square of `maxBins` if that is more.
SAMPLE_ROWS = 10_000


# ------------------------------------------------------------------ cells

@dataclass
class Cells:
    """The cells as an RDD of blocks (bins by feature, kind, rows); `kinds` are the (label, weight) pairs."""

    blocks: RDD
    cuts: list[np.ndarray]
    kinds: list[tuple[float, float]]
    count: int

    @property
    def bins(self) -> int:
        return max(len(c) for c in self.cuts) + 1

    @property
    def cut_counts(self) -> np.ndarray:
        return np.array([len(c) for c in self.cuts])


def candidate_cuts(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """At most `most` cuts between the values: all midpoints if they are few, else midpoints at equal
    steps of the weight, by the rule of `pyspark.ml`."""
    distinct, place = np.unique(values, return_inverse=True)
    with np.errstate(invalid="ignore", over="ignore"):
        middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) <= most:
        return middles[~np.isnan(middles)]  # between both infinities there is no cut
    upto = np.cumsum(np.bincount(place, weights))
    stride = upto[-1] / (most + 1)
    cuts, target = [], stride
    for i in range(1, len(distinct)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            cuts.append(middles[i - 1])
            target += stride
    return np.array([c for c in cuts if not np.isnan(c)])


def bin_of(feature: str, cuts: np.ndarray) -> Column:
    """The number of cuts below the value, by bisection."""
    value = col_of(feature)

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(value <= F.lit(float(cuts[mid])), between(low, mid)).otherwise(between(mid + 1, high))

    return between(0, len(cuts)).cast("smallint")


def make_cells(rows: DataFrame, features: Sequence[str], weight: str | None, bins: int, seed: int) -> Cells | None:
    """The cells of the rows; None if the labels are not the classes 0 and 1, or the weights are many.

    Candidate cuts come from a sample of the different rows: of n copies of a row, n times the share are
    taken, rounded up or down by the row's hash. So the sample, like the order of the cells, depends on
    the rows alone and not on how they are stored.
    """
    w = F.lit(1.0) if weight is None else col_of(weight).cast("double")
    names = [f"f{j}" for j in range(len(features))]
    values = [(col_of(f) + F.lit(0.0)).alias(n) for f, n in zip(features, names)]
    table = staged(rows.select(*values, F.col("label"), w.alias("w")).groupBy(*names, "label", "w").agg(
        F.count(F.lit(1)).alias("n")), "kinds")
    found = table.groupBy("label", "w").agg(F.sum("n").alias("n")).orderBy("label", "w").limit(256).collect()
    if len(found) > 255 or any(r.label not in (0.0, 1.0) or r.w is None or not r.w >= 0 for r in found):
        return None
    kinds, whole = [(r.label, r.w) for r in found], sum(r.w * r.n for r in found)
    if not 0 < whole < float("inf"):
        return None
    cuts = _sampled_cuts(table, names, whole, bins, seed)
    if not any(len(c) for c in cuts):
        return None

    kind = F.lit(0)
    for i, (label, own) in enumerate(kinds):
        kind = F.when((F.col("label") == F.lit(label)) & (F.col("w") == F.lit(own)), i).otherwise(kind)
    binned = table.select(*[bin_of(n, c).alias(n) for n, c in zip(names, cuts)], kind.cast("smallint").alias("kind"), "n")
    cells = staged(binned.groupBy(*names, "kind").agg(F.sum("n").alias("n")), "cells")
    count = cells.count()
    tasks = max(1, min(64, count // BLOCK_CELLS), -(-count // 1_000_000))
    ordered = cells.repartition(tasks, *names, "kind").sortWithinPartitions(*names, "kind")
    packed = ordered.mapInArrow(_pack, "bins binary, kind binary, n binary")
    width = len(names)
    blocks = packed.rdd.map(lambda r: _unpack(r, width)).persist(StorageLevel.MEMORY_AND_DISK)
    return Cells(blocks, cuts, kinds, count)


def _sampled_cuts(table: DataFrame, names: Sequence[str], weight: float, bins: int, seed: int) -> list[np.ndarray]:
    share = min(1.0, max(bins * bins, SAMPLE_ROWS) / weight)
    wanted = F.col("n") * F.lit(share)
    lot = F.pmod(F.xxhash64(*names, "label", "w", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    copies = F.floor(wanted) + F.when(lot < wanted - F.floor(wanted), 1).otherwise(0)
    sample = table.withColumn("copies", copies).filter("copies > 0").select(
        *names, (F.col("copies") * F.col("w")).alias("w")).collect()
    if not sample:
        return [np.empty(0) for _ in names]
    values = np.array([tuple(r) for r in sample], dtype=float).T
    return [candidate_cuts(v, values[-1], bins - 1) for v in values[:-1]]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
    if not parts:
        return
    columns = [np.concatenate(c) for c in zip(*parts)]
    bins = np.stack(columns[:-2]).astype(np.uint8)
    cells = [bins.tobytes(), columns[-2].astype(np.uint8).tobytes(), columns[-1].astype(np.int64).tobytes()]
    yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], names=["bins", "kind", "n"])


def _unpack(row, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = np.frombuffer(row.kind, np.uint8)
    return np.frombuffer(row.bins, np.uint8).reshape(width, len(kind)), kind, np.frombuffer(row.n, np.int64)


# ------------------------------------------------------------------ trees over bins

@dataclass
class Tree:
    """Nodes as growing lists. The right child follows the left one; a leaf is its own left child, with
    a cut that no bin lies beyond, so walking on from a leaf stays there."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    child: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    stats: list[np.ndarray] = field(default_factory=list)
    raw: list[int] = field(default_factory=list)

    def add(self, stats: np.ndarray, raw: int) -> int:
        node = len(self.feature)
        self.feature.append(0)
        self.cut.append(255)
        self.child.append(node)
        self.gain.append(-1.0)
        self.stats.append(stats)
        self.raw.append(raw)
        return node

    def split(self, node: int, feature: int, cut: int, gain: float, left, right) -> tuple[int, int]:
        made = self.add(*left), self.add(*right)
        self.feature[node], self.cut[node], self.child[node], self.gain[node] = feature, cut, made[0], gain
        return made

    def is_leaf(self, node: int) -> bool:
        return self.child[node] == node

    def walker(self) -> Walker:
        return Walker(np.array(self.feature, np.int64), np.array(self.cut, np.uint8), np.array(self.child, np.int64))

    def graft(self, node: int, other: Tree) -> None:
        """Put another tree in the place of a leaf."""
        offset = len(self.feature) - 1
        place = lambda i: node if i == 0 else offset + i
        for i in range(1, len(other.feature)):
            self.add(other.stats[i], other.raw[i])
        for i in range(len(other.feature)):
            at = place(i)
            self.feature[at], self.cut[at], self.gain[at] = other.feature[i], other.cut[i], other.gain[i]
            self.child[at] = place(other.child[i])


@dataclass
class Walker:
    """The part of a tree that places cells."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray

    def leaves(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node that every cell reaches."""
        m = bins.shape[1]
        flat, rows, at = bins.reshape(-1), np.arange(m), np.zeros(m, np.int64)
        for _ in range(depth if len(self.feature) > 1 else 0):
            at = self.child[at] + (flat[self.feature[at] * m + rows] > self.cut[at])
        return at


def level_sums(bins: np.ndarray, slot: np.ndarray, chosen: np.ndarray, columns: Sequence[np.ndarray],
               n_bins: int, group: np.ndarray | None = None, groups: int = 1) -> np.ndarray:
    """Sums of the columns by (slot, chosen feature, bin, group), as (slot, feature, bin, group, column)."""
    slots, width = chosen.shape
    m = bins.shape[1]
    flat, rows = bins.reshape(-1), np.arange(m)
    out = np.empty((slots, width, n_bins, groups, len(columns)))
    for j in range(width):
        at = slot * n_bins + (flat[chosen[slot, j] * m + rows] if slots > 1 else bins[chosen[0, j]])
        if group is not None:
            at = at * groups + group
        for c, values in enumerate(columns):
            out[:, j, :, :, c] = np.bincount(at, values, slots * n_bins * groups).reshape(slots, n_bins, groups)
    return out


def best_cuts(sums: np.ndarray, chosen: np.ndarray, cut_counts: np.ndarray, impurity: Callable, min_rows: int):
    """(feature, cut, gain, left sums, right sums) of the best cut of every slot, the first of equal ones.

    `sums` is (slot, feature, bin, column); `impurity` gives weight, impurity and rows of such sums. The
    gain is -inf where no cut leaves `min_rows` rows on both sides."""
    left = np.cumsum(sums, axis=2)
    total = left[:, :, -1:, :]
    left = left[:, :, :-1, :]
    right = total - left
    (w, own, _), (lw, li, lr), (rw, ri, rr) = (impurity(x) for x in (total, left, right))
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = own - lw / (lw + rw) * li - rw / (lw + rw) * ri
    exists = np.arange(left.shape[2])[None, None, :] < cut_counts[chosen][:, :, None]
    gain = np.where(exists & (lr >= min_rows) & (rr >= min_rows) & (gain >= 0), gain, -np.inf)
    slots, _, cuts = gain.shape
    best = gain.reshape(slots, -1).argmax(axis=1)
    rows, j, cut = np.arange(slots), best // cuts, best % cuts
    return chosen[rows, j], cut, gain[rows, j, cut], left[rows, j, cut], right[rows, j, cut]


# ------------------------------------------------------------------ boosting

def _variance(sums: np.ndarray):
    """Columns: weight, sum, sum of squares, rows."""
    w = sums[..., 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        return w, np.where(w > 0, (sums[..., 2] - sums[..., 1] ** 2 / w) / w, 0.0), sums[..., 3]


def _moved(block: tuple, steps: Sequence[tuple[Walker, np.ndarray]], depth: int, kinds: np.ndarray) -> tuple:
    """A block (bins, kind, rows, margin, residual) after the given trees."""
    bins, kind, n, margin, residual = block
    for walker, values in steps:
        margin = margin + values[walker.leaves(bins, depth)]
    if steps:
        y = (kinds[:, 0] * 2 - 1)[kind]
        with np.errstate(over="ignore"):
            residual = 4.0 * y / (1.0 + np.exp(2.0 * y * margin))
    return bins, kind, n, margin, residual


def boosted(cells: Cells, rounds: int, step: float, depth: int, min_rows: int) -> list[Tree]:
    """Trees on the residuals of the logistic loss; the first one is fitted on the labels as -1 and 1."""
    kinds = np.array(cells.kinds)

    def start(block: tuple) -> tuple:
        bins, kind, n = block
        return bins, kind, n.astype(np.min_scalar_type(n.max())), np.zeros(len(n)), (kinds[:, 0] * 2 - 1)[kind]

    trees, steps, state = [], [], None
    for number in range(rounds):
        if number % ROUNDS_CHAINED == 0:
            done = list(steps)
            fresh = cells.blocks.map(lambda b, done=done: _moved(start(b), done, depth, kinds))
        else:
            last = steps[-1:]
            fresh = state.map(lambda b, last=last: _moved(b, last, depth, kinds))
        fresh.persist(StorageLevel.MEMORY_AND_DISK)
        trees.append(_boosted_tree(fresh, cells, depth, min_rows))
        if state is not None:
            state.unpersist()
        state = fresh
        values = np.array([s[1] / s[0] if s[0] > 0 else 0.0 for s in trees[-1].stats])
        steps.append((trees[-1].walker(), values * (1.0 if number == 0 else step)))
    if state is not None:
        state.unpersist()
    return trees


def _boosted_tree(state: RDD, cells: Cells, depth: int, min_rows: int) -> Tree:
    tree, open_nodes, n_bins = Tree(), [0], cells.bins
    every, weights = np.arange(len(cells.cuts)), np.array(cells.kinds)[:, 1]
    for level in range(depth):
        chosen = np.tile(every, (len(open_nodes), 1))
        walker = tree.walker() if level else None
        slot_of = np.full(max(len(tree.feature), 1), -1)
        slot_of[open_nodes] = np.arange(len(open_nodes))

        def sums(block: tuple, walker=walker, slot_of=slot_of, chosen=chosen, level=level) -> np.ndarray:
            bins, kind, n, _, residual = block
            w = n * weights[kind]
            columns = [w, w * residual, w * residual * residual, n]
            if walker is None:
                slot = np.zeros(bins.shape[1], np.int64)
            else:
                slot = slot_of[walker.leaves(bins, level)]
                keep = slot >= 0
                if not keep.all():
                    bins, slot, columns = np.ascontiguousarray(bins[:, keep]), slot[keep], [c[keep] for c in columns]
            return level_sums(bins, slot, chosen, columns, n_bins)

        found = _total(state.map(sums))[:, :, :, 0, :]
        if not level:
            whole = found[0, 0].sum(axis=0)
            tree.add(whole[:3], int(whole[3]))
        open_nodes = _split_all(tree, open_nodes, best_cuts(found, chosen, cells.cut_counts, _variance, min_rows),
                                lambda s: (s[:3], int(s[3])), _variance)
        if not open_nodes:
            break
    return tree


def _split_all(tree: Tree, nodes: Sequence[int], best, stats_of: Callable, impurity: Callable) -> list[int]:
    """Split the nodes that gain by it; return the children that are not pure."""
    further = []
    for node, feature, cut, gain, left, right in zip(nodes, *best):
        if gain > 0:
            made = tree.split(node, int(feature), int(cut), float(gain), stats_of(left), stats_of(right))
            further += [c for c, s in zip(made, (left, right)) if abs(impurity(s)[1]) >= PURE]
    return further


def _total(parts: RDD):
    """The sum over all blocks, in their order where they are few."""
    if parts.getNumPartitions() > 64:
        return parts.treeReduce(lambda a, b: a + b)
    found = parts.collect()
    return sum(found[1:], found[0])


# ------------------------------------------------------------------ forests

def _gini(sums: np.ndarray):
    """Columns: weight of class 0, weight of class 1, rows."""
    w = sums[..., 0] + sums[..., 1]
    with np.errstate(divide="ignore", invalid="ignore"):
        return w, np.where(w > 0, 1.0 - (sums[..., 0] / w) ** 2 - (sums[..., 1] / w) ** 2, 0.0), sums[..., 2]


def _by_class(drawn: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Draws by kind (last axis) as (weight of class 0, weight of class 1, rows)."""
    weights = [(drawn * (kinds[:, 1] * (kinds[:, 0] == label))).sum(axis=-1) for label in (0, 1)]
    return np.stack([*weights, drawn.sum(axis=-1)], axis=-1)


def _pick_features(seed: int, tree: int, place: int, slots: int, width: int, take: int) -> np.ndarray:
    """`take` features per slot, each set equally likely, in the order of the features."""
    if take == width:
        return np.tile(np.arange(width), (slots, 1))
    rng = np.random.default_rng([seed, 1, tree, place])
    return np.sort(rng.random((slots, width)).argsort(axis=1)[:, :take], axis=1)


@dataclass(frozen=True)
class _Plan:
    seed: int
    depth: int
    take: int
    min_rows: int
    n_bins: int
    cut_counts: np.ndarray
    kinds: np.ndarray

    def drawn(self, tree: int, block: int, n: np.ndarray) -> np.ndarray:
        return np.random.default_rng([self.seed, 0, tree, block]).poisson(n)

    def grow(self, tree: Tree, nodes: Sequence[int], sums: np.ndarray, chosen: np.ndarray) -> list[int]:
        best = best_cuts(_by_class(sums, self.kinds), chosen, self.cut_counts, _gini, self.min_rows)
        return _split_all(tree, nodes, best, lambda s: (s[:2], int(round(s[2]))), _gini)


def forest(cells: Cells, trees: int, depth: int, take: int, min_rows: int, seed: int) -> list[Tree]:
    """Trees on Poisson draws of the rows, with `take` random features for every node."""
    plan = _Plan(seed, depth, take, min_rows, cells.bins, cells.cut_counts, np.array(cells.kinds))
    grown: list[Tree] = []
    for first in range(0, trees, TREES_AT_ONCE):
        numbers = range(first, min(first + TREES_AT_ONCE, trees))
        upper, small = _upper_levels(cells, plan, numbers)
        grown += _lower_levels(cells, plan, upper, small)
    return grown


def _upper_levels(cells: Cells, plan: _Plan, numbers: Sequence[int]):
    """Search the levels with nodes of more than LOCAL_CELLS cells over all blocks; return the trees, and
    (node, level) of the smaller nodes that are still open."""
    trees = {t: Tree() for t in numbers}
    width, n_kinds = len(cells.cuts), len(plan.kinds)
    small = {t: ([(0, 0)] if cells.count <= LOCAL_CELLS else []) for t in numbers}
    big = {t: ([] if small[t] else [0]) for t in numbers}
    level = 0
    while any(big.values()) and level < plan.depth:
        asked = {t: (trees[t].walker() if level else None, np.array(big[t]),
                     _pick_features(plan.seed, t, level, len(big[t]), width, plan.take)) for t in numbers if big[t]}

        def sums(parts, asked=asked, level=level):
            block, (bins, kind, n) = parts
            return [_block_sums(plan, t, block, bins, kind, n, *a, level, n_kinds) for t, a in asked.items()]

        found = _sum_lists(_numbered(cells.blocks).map(sums))
        for (t, (_, nodes, chosen)), (drawn, counts) in zip(asked.items(), found):
            tree = trees[t]
            if not level:
                whole = _by_class(drawn[0, 0].sum(axis=0), plan.kinds)
                tree.add(whole[:2], int(round(whole[2])))
            further = set(plan.grow(tree, list(nodes), drawn, chosen))
            big[t] = []
            for s, node in enumerate(nodes):
                if tree.is_leaf(node):
                    continue
                j = list(chosen[s]).index(tree.feature[node])
                below = counts[s, j, :tree.cut[node] + 1].sum()
                for c, size in ((tree.child[node], below), (tree.child[node] + 1, counts[s, j].sum() - below)):
                    if c in further and level + 1 < plan.depth:
                        big[t].append(c) if size > LOCAL_CELLS else small[t].append((c, level + 1))
        level += 1
    return trees, small


def _block_sums(plan: _Plan, tree: int, block: int, bins, kind, n, walker, nodes, chosen, level: int, n_kinds: int):
    drawn = plan.drawn(tree, block, n)
    slot = np.zeros(len(n), np.int64)
    if walker is not None:
        slot_of = np.full(len(walker.feature), -1)
        slot_of[nodes] = np.arange(len(nodes))
        slot = slot_of[walker.leaves(bins, level)]
    keep = (drawn > 0) & (slot >= 0)
    bins, slot, drawn, kind = np.ascontiguousarray(bins[:, keep]), slot[keep], drawn[keep], kind[keep]
    of_kind = level_sums(bins, slot, chosen, [drawn], plan.n_bins, kind, n_kinds)[..., 0]
    return of_kind, level_sums(bins, slot, chosen, [np.ones(len(slot))], plan.n_bins)[:, :, :, 0, 0]


def _lower_levels(cells: Cells, plan: _Plan, upper: dict[int, Tree], small: dict[int, list]) -> list[Tree]:
    """Send the drawn cells of every small node to one task, which grows the rest of the tree there."""
    groups = [(t, node, level) for t in upper for node, level in small[t]]
    if groups:
        number_of = {(t, node): g for g, (t, node, _) in enumerate(groups)}
        walkers = {t: (upper[t].walker() if upper[t].feature else None, max(level for _, level in small[t]),
                       np.array([node for node, _ in small[t]])) for t in upper if small[t]}

        def sent(parts):
            block, (bins, kind, n) = parts
            for t, (walker, levels, nodes) in walkers.items():
                drawn = plan.drawn(t, block, n)
                at = np.zeros(len(n), np.int64) if walker is None else walker.leaves(bins, levels)
                keep = np.flatnonzero((drawn > 0) & np.isin(at, nodes))
                keep = keep[at[keep].argsort(kind="stable")]
                ends = np.searchsorted(at[keep], nodes, "right")
                begins = np.searchsorted(at[keep], nodes, "left")
                for node, a, b in zip(nodes.tolist(), begins, ends):
                    if b > a:
                        own = keep[a:b]
                        some = drawn[own]
                        yield number_of[t, node], (block, np.ascontiguousarray(bins[:, own]), kind[own],
                                                   some.astype(np.min_scalar_type(some.max())))

        def finished(group):
            g, parts = group
            t, node, level = groups[g]
            tree = _grown_here(plan, t, node, level, sorted(parts, key=lambda p: p[0]))
            return g, (tree.feature, tree.cut, tree.child, tree.gain, tree.stats, tree.raw)

        sent_to = _numbered(cells.blocks).flatMap(sent).groupByKey(len(groups), int)
        for g, lists in sent_to.map(finished).collect():
            (t, node, _), tree = groups[g], Tree(*lists)
            if upper[t].feature:
                upper[t].graft(node, tree)
            else:
                upper[t] = tree
    for t in upper:
        if not upper[t].feature:  # no row was drawn
            upper[t].add(np.zeros(2), 0)
    return [upper[t] for t in sorted(upper)]


def _grown_here(plan: _Plan, number: int, place: int, level: int, parts: Sequence[tuple]) -> Tree:
    """A subtree from all cells of its root."""
    bins = np.concatenate([p[1] for p in parts], axis=1)
    kind = np.concatenate([p[2] for p in parts])
    drawn = np.concatenate([p[3].astype(np.int64) for p in parts])
    width, n_kinds = len(bins), len(plan.kinds)
    tree = Tree()
    whole = _by_class(np.bincount(kind, drawn, n_kinds), plan.kinds)
    tree.add(whole[:2], int(round(whole[2])))
    nodes, slot = [0], np.zeros(len(kind), np.int64)
    # the first number is the node's place in the whole tree, so that every draw of features is its own
    while nodes and level < plan.depth:
        chosen = _pick_features(plan.seed, number, (place + 1) * 64 + level, len(nodes), width, plan.take)
        sums = level_sums(bins, slot, chosen, [drawn], plan.n_bins, kind, n_kinds)[..., 0]
        further = plan.grow(tree, nodes, sums, chosen)
        slot_of = np.full(len(tree.feature), -1)
        slot_of[further] = np.arange(len(further))
        walker, of_slot, m = tree.walker(), np.array(nodes), len(kind)
        at = of_slot[slot]
        at = walker.child[at] + (bins.reshape(-1)[walker.feature[at] * m + np.arange(m)] > walker.cut[at])
        slot = slot_of[at]
        keep = slot >= 0
        if not keep.all():
            bins, kind, drawn, slot = np.ascontiguousarray(bins[:, keep]), kind[keep], drawn[keep], slot[keep]
        nodes, level = further, level + 1
    return tree


def _numbered(blocks: RDD) -> RDD:
    return blocks.mapPartitionsWithIndex(lambda i, parts: ((i, p) for p in parts))


def _sum_lists(parts: RDD):
    add = lambda a, b: [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a, b)]
    return parts.treeReduce(add)  # whole numbers: the order does not show


# ------------------------------------------------------------------ as models of pyspark.ml

_NODES = pa.schema([
    ("treeID", pa.int32()),
    ("nodeData", pa.struct([
        ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()),
        ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()), ("gain", pa.float64()),
        ("leftChild", pa.int32()), ("rightChild", pa.int32()),
        ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                             ("numCategories", pa.int32())]))]))])


def _node_rows(number: int, tree: Tree, cuts: Sequence[np.ndarray], impurity: Callable, prediction: Callable) -> list[dict]:
    """The nodes as stored by `pyspark.ml`: siblings that are leaves of equal prediction become one leaf."""
    stats = np.array(tree.stats)
    predicted, impure = prediction(stats), impurity(np.c_[stats, np.zeros(len(stats))])[1]
    leaf = [tree.is_leaf(i) for i in range(len(tree.feature))]
    for i in reversed(range(len(leaf))):
        if not leaf[i]:
            a, b = tree.child[i], tree.child[i] + 1
            leaf[i] = leaf[a] and leaf[b] and predicted[a] == predicted[b]
    order, places = [0], {0: 0}
    for i in order:  # grows while it is read
        if not leaf[i]:
            for c in (tree.child[i], tree.child[i] + 1):
                places[c] = len(order)
                order.append(c)
    rows = []
    for i in order:
        at = -1 if leaf[i] else places[tree.child[i]]
        cut = [] if leaf[i] else [float(cuts[tree.feature[i]][tree.cut[i]])]
        rows.append({"treeID": number, "nodeData": {
            "id": places[i], "prediction": float(predicted[i]), "impurity": float(impure[i]),
            "impurityStats": stats[i].tolist(), "rawCount": tree.raw[i], "gain": -1.0 if leaf[i] else tree.gain[i],
            "leftChild": at, "rightChild": -1 if leaf[i] else at + 1,
            "split": {"featureIndex": -1 if leaf[i] else tree.feature[i], "leftCategoriesOrThreshold": cut,
                      "numCategories": -1}}})
    return rows


_TREE_PARAMS = ("maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "seed", "weightCol", "featuresCol", "labelCol")


def _stored_model(spark: SparkSession, estimator: Estimator, trees: Sequence[Tree], weights: Sequence[float],
                  cells: Cells, impurity: Callable, prediction: Callable) -> Model:
    """The trees written in the layout of a stored model, and loaded as one."""
    forest_like = isinstance(estimator, RandomForestClassifier)
    path = scratch_path(spark, "trees")
    given = {p.name: v for p, v in estimator._paramMap.items()}
    default = {p.name: v for p, v in estimator._defaultParamMap.items() if v is not None}

    def text(name: str, uid: str, values: dict, **more) -> str:
        return json.dumps({"class": f"org.apache.spark.ml.{name}", "timestamp": int(time.time() * 1000),
                           "sparkVersion": spark.version, "uid": uid, "paramMap": values} | more)

    kind = "classification.RandomForestClassificationModel" if forest_like else "classification.GBTClassificationModel"
    of_tree = "classification.DecisionTreeClassificationModel" if forest_like else "regression.DecisionTreeRegressionModel"
    sizes = {"numFeatures": len(cells.cuts), "numTrees": len(trees)} | ({"numClasses": 2} if forest_like else {})
    own = {k: v for k, v in given.items() if k in _TREE_PARAMS}
    spark.createDataFrame([(text(kind, estimator.uid, given, defaultParamMap=default, **sizes),)], "value string").coalesce(
        1).write.text(f"{path}/metadata")
    each = [(i, text(of_tree, f"{estimator.uid}_{i}", own, defaultParamMap={}), float(w)) for i, w in enumerate(weights)]
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    tables = [pa.Table.from_pylist(_node_rows(i, t, cells.cuts, impurity, prediction), _NODES) for i, t in enumerate(trees)]
    spark.createDataFrame(pa.concat_tables(tables)).write.parquet(f"{path}/data")
    return (RandomForestClassificationModel if forest_like else GBTClassificationModel).load(path)


def _mean_of(stats: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(stats[:, 0] > 0, stats[:, 1] / stats[:, 0], 0.0)


def fits(estimator: Estimator) -> bool:
    """Whether the estimator grows its trees by rules that are followed here."""
    if not isinstance(estimator, (RandomForestClassifier, GBTClassifier)):
        return False
    plain = (estimator.getSubsamplingRate() == 1.0 and estimator.getMinInfoGain() == 0.0
             and estimator.getMinWeightFractionPerNode() == 0.0 and estimator.getMaxBins() <= 256
             and estimator.getMaxDepth() > 0)
    if isinstance(estimator, GBTClassifier):
        return plain and estimator.getFeatureSubsetStrategy() in ("all", "auto") and not estimator.isSet("validationIndicatorCol")
    return (plain and estimator.getBootstrap() and estimator.getNumTrees() > 1 and estimator.getImpurity() == "gini"
            and estimator.getFeatureSubsetStrategy() in ("auto", "sqrt"))


def fit_cells(rows: DataFrame, estimator: Estimator, features: Sequence[str],
              made: dict[tuple, Cells | None] | None = None) -> Model | None:
    """The estimator's model, fitted on the cells of the rows (features, `label` and the weight). None where
    the rows cannot be put into cells: no feature varies, or labels are not 0 and 1.

    `made` keeps the cells for further estimators over the same rows; `drop_cells` releases them."""
    weight = estimator.getWeightCol() if estimator.isSet("weightCol") else None
    seed, min_rows, depth = estimator.getSeed(), estimator.getMinInstancesPerNode(), estimator.getMaxDepth()
    held, asked = {} if made is None else made, (weight, estimator.getMaxBins(), seed)
    if asked not in held:
        held[asked] = make_cells(rows, features, *asked)
    cells = held[asked]
    if cells is None:
        return None
    if isinstance(estimator, RandomForestClassifier):
        take = int(np.ceil(np.sqrt(len(features))))
        trees = forest(cells, estimator.getNumTrees(), depth, take, min_rows, seed)
        model = _stored_model(rows.sparkSession, estimator, trees, [1.0] * len(trees), cells, _gini,
                              lambda s: (s[:, 1] > s[:, 0]).astype(float))
    else:
        trees = boosted(cells, estimator.getMaxIter(), estimator.getStepSize(), depth, min_rows)
        weights = [1.0] + [estimator.getStepSize()] * (len(trees) - 1)
        model = _stored_model(rows.sparkSession, estimator, trees, weights, cells, _variance, _mean_of)
    if made is None:
        drop_cells(held)
    return model


def drop_cells(made: dict[tuple, Cells | None]) -> None:
    for cells in made.values():
        if cells is not None:
            cells.blocks.unpersist()
    made.clear()
