"""Mixing sources to target weights by Pfair scheduling.

The rows of a source queue up, and the queue is cut into blocks of about `BLOCK_CHARS` characters.
A source with share w of the slots has its j-th block released at slot floor(j / w) and due by slot
ceil((j + 1) / w). Earliest deadline first over the released blocks keeps every source within one
block of its share at every slot.

Weights are exact: each is taken as the fraction it is, so release and deadline are whole-number
arithmetic over the whole run, and no rounding adds up. The driver walks the slots once, one of
about `BLOCK_CHARS` characters each, and keeps the blocks done at the start of every frame of
`FRAME` slots; a task that asks for a block's slot walks the frame it lies in. When a source runs
dry, a new phase begins in which all slots belong to the sources left, in the same proportions.
There are as many phases as sources at most. The driver holds one total per source, and one count
per source and frame.

Defined cases: a null source is a source of its own; a null or empty text has size 0 and joins the
block that is open. A source without a given weight gets the weight of its own share of all
characters to the power `temper`; a source of weight 0 or less comes last. Weights need not sum to one. Rows with equal
keys are told apart by their text. Extra columns are passed on. An empty table gives no rows. No
row is dropped or repeated.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from fractions import Fraction
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import documents, queue_offsets, text_of

BLOCK_CHARS = 1 << 16
FRAME = 1024
#: Power of a source's share of the characters in the registered mix.
TEMPER = 0.7
HELD_FRAMES = 256
LONGEST = (1 << 63) - 1


def ordered(names: Iterable) -> list:
    return sorted(names, key=lambda s: (s is not None, s or ""))


def whole_rates(weights: Mapping) -> dict:
    """Weights as whole numbers in exactly the same proportions."""
    exact = {s: Fraction(weights[s]) for s in ordered(weights)}
    unit = math.lcm(*(f.denominator for f in exact.values()))
    rates = {s: f.numerator * (unit // f.denominator) for s, f in exact.items()}
    common = math.gcd(*rates.values())
    return {s: n // common for s, n in rates.items()}


def window(j: int, rate: int, total: int) -> tuple[int, int]:
    """Release and deadline of a source's j-th block."""
    return j * total // rate, -(-(j + 1) * total // rate)


def walk(rates: Mapping, done: Mapping, slot: int) -> Iterator[tuple]:
    """(source, block) of each slot from `slot` on, where `done` blocks have run: earliest deadline
    first among the released."""
    names, total = ordered(rates), sum(rates.values())
    waiting, ready = [], []
    for at, s in enumerate(names):
        heapq.heappush(waiting, (window(done[s], rates[s], total)[0], at, done[s]))
    while True:
        while waiting and waiting[0][0] <= slot:
            _, at, j = heapq.heappop(waiting)
            heapq.heappush(ready, (window(j, rates[names[at]], total)[1], at, j))
        _, at, j = heapq.heappop(ready)
        yield names[at], j
        heapq.heappush(waiting, (window(j + 1, rates[names[at]], total)[0], at, j + 1))
        slot += 1


@dataclass(frozen=True)
class Phase:
    """Slots `first`.. of the schedule, in which only the sources in `rates` have blocks left; `done`
    is how many blocks each had before, `held` how many more at the start of each frame."""

    first: int
    frame: int
    rates: dict
    done: dict
    held: dict

    def slots_of(self, nth: int) -> dict:
        """(source, block of the phase) -> slot of the phase, over one frame."""
        start = {s: int(counts[nth]) for s, counts in self.held.items()}
        run = islice(walk(self.rates, start, nth * self.frame), self.frame)
        return {block: nth * self.frame + i for i, block in enumerate(run)}


def frame_pattern(shares: Mapping, frame: int) -> dict:
    """Slots of each source's blocks in the first `frame` slots."""
    pattern = {s: [] for s in shares}
    for slot, (s, _) in enumerate(islice(walk(shares, dict.fromkeys(shares, 0), 0), frame)):
        pattern[s].append(slot)
    return pattern


def phases_of(blocks: Mapping, weights: Mapping, frame: int = FRAME) -> list[Phase]:
    """The phases of the schedule for sources with so many blocks each."""
    left = {s: n for s, n in blocks.items() if n > 0}
    done, first, out = dict.fromkeys(left, 0), 0, []
    while left:
        live = {s: weights.get(s, 0) for s in left if weights.get(s, 0) > 0} or dict.fromkeys(left, 1)
        rates = whole_rates(live)
        got, held = dict.fromkeys(rates, 0), {s: [] for s in rates}
        for slot, (s, _) in enumerate(walk(rates, got.copy(), 0)):
            if slot % frame == 0:
                for name, n in got.items():
                    held[name].append(n)
            got[s] += 1
            if got[s] == left[s]:  # the first to run dry
                break
        out.append(Phase(first, frame, rates, dict(done), {s: np.asarray(n, np.int64) for s, n in held.items()}))
        for s, n in got.items():
            done[s] += n
            left[s] -= n
        left = {s: n for s, n in left.items() if n > 0}
        first += slot + 1
    return out


def _placing(phases: list[Phase], blocks: Mapping):
    """A function of columns (source, block asked for): block, release, deadline, slot."""
    runs = {s: [p for p in phases if s in p.rates] for s in blocks}
    begins = {s: [p.done[s] for p in own] for s, own in runs.items()}

    @F.pandas_udf("block long, release long, deadline long, slot long")
    def place(names: pd.Series, wanted: pd.Series) -> pd.DataFrame:
        frames, known, out = {}, {}, []
        for pair in zip(names, wanted, strict=True):
            if pair not in known:
                s = None if pd.isna(pair[0]) else pair[0]
                block = min(int(pair[1]), blocks[s] - 1)
                k = bisect(begins[s], block) - 1
                phase = runs[s][k]
                own = block - phase.done[s]
                nth = int(np.searchsorted(phase.held[s], own, "right")) - 1
                if (phase.first, nth) not in frames:
                    if len(frames) >= HELD_FRAMES:
                        frames.clear()
                    frames[phase.first, nth] = phase.slots_of(nth)
                release, deadline = window(own, phase.rates[s], sum(phase.rates.values()))
                known[pair] = (block, min(release, LONGEST), min(deadline, LONGEST),
                               phase.first + frames[phase.first, nth][s, own])
            out.append(known[pair])
        return pd.DataFrame(out, columns=["block", "release", "deadline", "slot"], dtype="int64")

    return place


def pfair_schedule(docs: DataFrame, weights: Mapping[str | None, float] | None = None,
                   source: str = "source", text: str = "text", key: str = "doc_id",
                   block_chars: int = BLOCK_CHARS, frame: int = FRAME, temper: float = 1.0) -> DataFrame:
    """One row per row of `docs`: row (all its columns as a struct), block, release, deadline, slot,
    queue_start. Reading by (slot, queue_start) is the mix. Release and deadline count slots from
    the start of the phase in which the block runs."""
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{source}`").cast("string").alias("name"),
                       F.char_length(text_of(text)).cast("long").alias("size"),
                       F.col(f"`{key}`").alias("key"), F.xxhash64(text_of(text)).alias("tie"))
    totals = {r[0]: r[1] for r in rows.groupBy("name").agg(F.sum("size")).collect()}  # one row per source
    given, volume = dict(weights or {}), max(sum(totals.values()), 1)
    targets = {s: given.get(s, (max(n, 1) / volume) ** temper) for s, n in totals.items()}
    blocks = {s: max(n - 1, 0) // block_chars + 1 for s, n in totals.items()}
    place = _placing(phases_of(blocks, targets, frame), blocks)
    queued = queue_offsets(rows, "name", "size", ["key", "tie"])
    # a text of size 0 at the very end belongs to the last block
    wanted = F.floor(F.col("queue_start") / block_chars).cast("long")
    placed = queued.withColumn("at", place("name", wanted))
    return placed.select("row", "at.block", "at.release", "at.deadline", "at.slot", "queue_start", "key", "tie")


def mixed(docs: DataFrame, weights: Mapping[str | None, float] | None = None, key: str = "doc_id",
          temper: float = 1.0) -> DataFrame:
    """All rows of `docs` in the order of the mix, in their columns."""
    plan = pfair_schedule(docs, weights, key=key, temper=temper)
    return plan.orderBy("slot", "queue_start", "key", "tie").select("row.*")


def op10_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its block and the slot of the mix; a source's weight is its share of all
    characters to the power `TEMPER`."""
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return pfair_schedule(docs, temper=TEMPER).select(
        "row.doc_id", "row.source", "block", "release", "deadline", "slot", "queue_start")
