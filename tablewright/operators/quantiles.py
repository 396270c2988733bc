"""Interpolated quantiles (T1), exact at any size.

The built-in `percentile` keeps one map entry per distinct value in a single buffer, so it only
serves columns of few values. Here one scan counts the rows and sketches a bracket around each wanted
rank. The next counts below each bracket and inside it; while a bracket holds more than `LAST_VALUES`
values it is narrowed to two neighbouring points of a sketch of its inside. The last scan takes the
few values inside the brackets. The plan is the same at every size, every aggregate has bounded
state, and what reaches the driver is a few thousand numbers per quantile at most.

These jobs run when the function is called and read their input each time: stage a costly input. The
quantiles that several reports of a step want are wished for first and searched for together. Where
sketches of the table are at hand (`operators.sketches`), they take the place of the first scan.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.cleaning import col_of

GRID = 128
ACCURACY = 40 * GRID
#: Values of a bracket that the last aggregate takes; brackets with more are narrowed first.
LAST_VALUES = 1024
#: Shares of the rows by which the first brackets reach to both sides; the first that is wide enough
#: for the sketch's error and both ranks counts.
MARGINS = (2 / ACCURACY, 1 / 64)


def sql_name(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """A string literal for SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_double(value: float | None) -> str:
    """A double literal for SQL text."""
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    return f"double('{value!r}')"


def measure_sql(df: DataFrame, name: str) -> str:
    """A numeric column as double, NaN as missing, as SQL text.

    Operators over many columns build one SQL text: a call into the JVM per column and step
    would take longer than the query.
    """
    c = sql_name(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.DoubleType):
        return f"nullif({c}, double('NaN'))"
    if isinstance(kind, T.FloatType):
        return f"nullif(double({c}), double('NaN'))"
    return f"double({c})"


def measure(df: DataFrame, name: str) -> Column:
    """The same as a Column."""
    return F.expr(measure_sql(df, name))


#: Wanted quantiles by column, and found ones by (column, share).
Wishes = Mapping[str, Iterable[float]]
Found = Mapping[tuple[str, float], float | None]


def all_wishes(*parts: Wishes) -> dict[str, list[float]]:
    """The wishes of several reports together."""
    out: dict[str, set[float]] = {}
    for part in parts:
        for column, probs in part.items():
            out.setdefault(column, set()).update(float(p) for p in probs)
    return {c: sorted(probs) for c, probs in out.items()}


def quantile_sql(df: DataFrame, cols: Sequence[str], probs: Sequence[float], mode: str = "exact",
                 last: int = LAST_VALUES, found: Found | None = None) -> dict[str, str]:
    """Per column an array<double> of its quantiles as SQL text, for use inside an aggregate.

    Mode 'exact' runs the jobs described above at once, unless the quantiles are among those `found`
    before, and its results are constants. Mode 'approx' is the built-in sketch, lazy and without
    interpolation.
    """
    if mode == "approx":
        points = f"array({', '.join(sql_double(float(p)) for p in probs)})"
        return {c: f"percentile_approx({measure_sql(df, c)}, {points}, {ACCURACY})" for c in cols}
    if mode != "exact":
        raise ValueError(f"unknown mode {mode!r}")
    if found is None:
        found = search_quantiles(df, dict.fromkeys(cols, probs), last)
    return {c: f"array({', '.join(sql_double(found[c, float(p)]) for p in probs)})" for c in cols}


def quantile_row(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                 mode: str = "exact", found: Found | None = None) -> DataFrame:
    """One row with one array<double> column per input column."""
    exprs = quantile_sql(df, cols, probs, mode, found=found)
    named = [f"{exprs[c]} AS {sql_name(c)}" for c in cols]
    return (df if mode == "approx" else df.sparkSession.range(1)).selectExpr(*named)


def as_scalar(row: DataFrame) -> Column:
    """A one-row table as a struct value: a scalar subquery, so no join is planned."""
    return row.select(F.struct("*")).scalar()


def with_stats(df: DataFrame, row: DataFrame, name: str = "__stats") -> DataFrame:
    """Attach a one-row table of statistics to every row as one struct column."""
    return df.withColumn(name, as_scalar(row))


@dataclass
class _Target:
    """A wanted pair of neighbouring ranks and the closed value bracket that holds them."""

    column: str
    ranks: tuple[int, int]
    lo: float
    hi: float
    slack: int = 1
    parent: tuple | None = None
    values: dict = field(default_factory=dict)
    skip: int = 0
    inner: int = 0
    final: bool = False

    @property
    def open_ranks(self) -> list[int]:
        """Ranks whose value is not settled yet; settled ones keep theirs."""
        return [r for r in self.ranks if r not in self.values]

    @property
    def done(self) -> bool:
        return not self.open_ranks

    def inside(self) -> str:
        return f"{self.column} > {sql_double(self.lo)} AND {self.column} < {sql_double(self.hi)}"


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    last: int = LAST_VALUES) -> dict[str, list[float | None]]:
    """The quantiles of each column as numbers; None for a column without values."""
    found = search_quantiles(df, dict.fromkeys(cols, probs), last)
    return {c: [found[c, float(p)] for p in probs] for c in cols}


@dataclass(frozen=True)
class ColumnStart:
    """What a search starts from: the number of values, their ends, and a bracket for each share."""

    count: int
    low: float | None
    high: float | None
    brackets: Mapping[float, tuple[float, float]]


def _first_scan(data: DataFrame, names: Mapping[str, str], wishes: Mapping[str, list[float]]) -> dict[str, ColumnStart]:
    def around(probs: list[float]) -> list[float]:
        return [min(max(p + side * d, 0.0), 1.0) for p in probs for d in MARGINS for side in (-1, 1)]

    basics = data.selectExpr(*[
        f"struct(count({m}), min({m}), max({m}), percentile_approx({m}, "
        f"array({', '.join(map(sql_double, around(wishes[c])))}), {ACCURACY})) AS {m}"
        for c, m in names.items()]).first()
    starts = {}
    for c, m in names.items():
        count, low, high, points = basics[m]
        brackets, ends = {}, around(wishes[c])
        for i, p in enumerate(wishes[c]):
            for j, margin in enumerate(MARGINS):
                if count * margin >= 8:  # else the bracket may not hold both ranks
                    at = 2 * (i * len(MARGINS) + j)
                    brackets[p] = (points[at] if ends[at] > 0 else low, points[at + 1] if ends[at + 1] < 1 else high)
                    break
        starts[c] = ColumnStart(count, low, high, brackets)
    return starts


def search_quantiles(df: DataFrame, wishes: Wishes, last: int = LAST_VALUES,
                     starts: Mapping[str, ColumnStart] | None = None) -> dict[tuple[str, float], float | None]:
    """All wanted quantiles, by (column, share), in one search; None for a column without values.

    `starts`, from sketches of exactly these rows, saves the first scan."""
    wishes = {c: probs for c, probs in all_wishes(wishes).items() if probs}
    if not wishes:
        return {}
    names = {c: f"m{i}" for i, c in enumerate(wishes)}
    data = df.selectExpr(*[f"{measure_sql(df, c)} AS {m}" for c, m in names.items()])
    if starts is None:
        starts = _first_scan(data, names, wishes)
    ranks, targets = {}, {}
    for c, m in names.items():
        start = starts[c]
        if not start.count:
            continue
        for p in wishes[c]:
            position = p * (start.count - 1)
            below = min(math.floor(position), start.count - 1)
            ranks[c, p] = (below, min(below + 1, start.count - 1), position - below)
            lo, hi = start.brackets.get(p, (start.low, start.high))
            targets[c, p] = _Target(m, ranks[c, p][:2], lo, hi, parent=(start.low, start.high))
    _select_by_rounds(data, list(targets.values()), max(last, 16))

    def quantile(c: str, p: float) -> float | None:
        if (c, p) not in ranks:
            return None
        below, above, share = ranks[c, p]
        a, b = (targets[c, p].values[r] for r in (below, above))
        return a if share == 0 or a == b else a + (b - a) * share

    return {(c, p): quantile(c, p) for c, probs in wishes.items() for p in probs}


def _ranked_sql(value: str, ranks: Sequence[int]) -> str:
    """The values at the given ranks of the sorted column. The lambda has it sorted once."""
    picked = ", ".join(f"element_at(s, {r + 1})" for r in ranks)
    return f"transform(array(sort_array(collect_list({value}))), s -> array({picked}))[0]"


def _select_by_rounds(data: DataFrame, targets: list[_Target], last: int) -> None:
    """Fill in the values of the targets' ranks. A bracket only narrows, or goes back once to a
    wider one that held the ranks, with more slack; so the rounds end."""
    grid = f"array({', '.join(f'{i / GRID}D' for i in range(GRID + 1))})"
    while pending := [t for t in targets if not t.done and not t.final]:
        row = data.selectExpr(*[f"{_round_aggregate(t, grid)} AS t{i}"
                                for i, t in enumerate(pending)]).first()
        for i, target in enumerate(pending):
            _narrow(target, row[i], last)

    if rest := [t for t in targets if not t.done]:
        row = data.selectExpr(*[
            _ranked_sql(f"CASE WHEN {t.inside()} THEN {t.column} END", [r - t.skip for r in t.open_ranks])
            + f" AS t{i}" for i, t in enumerate(rest)]).first()
        for i, target in enumerate(rest):
            target.values.update(zip(target.open_ranks, row[i]))


def _round_aggregate(t: _Target, grid: str) -> str:
    c, lo, hi = t.column, sql_double(t.lo), sql_double(t.hi)
    return (f"struct(count_if({c} < {lo}), count_if({c} = {lo}), count_if({t.inside()}), "
            f"count_if({c} = {hi}), "
            f"percentile_approx(CASE WHEN {t.inside()} THEN {c} END, {grid}, {ACCURACY}))")


def _narrow(t: _Target, counted, last: int) -> None:
    """Settle ranks that fall on the bracket's ends, then shrink the bracket or stop."""
    below, at_lo, inner, at_hi, grid = counted
    first_inside, first_hi = below + at_lo, below + at_lo + inner
    end = first_hi + (at_hi if t.hi != t.lo else 0)
    if not all(below <= r < end for r in t.open_ranks):
        if len(t.parent) == 2:  # the first sketch missed: take the whole column
            t.lo, t.hi = t.parent
            return
        # The sketch missed: go back to the wider bracket and take more of its cells.
        t.lo, t.hi, grid, first_inside, inner = t.parent
        t.slack *= 4
        _pick_cells(t, grid, first_inside, inner)
        return
    for r in t.open_ranks:
        if r < first_inside:
            t.values[r] = t.lo
        elif r >= first_hi:
            t.values[r] = t.hi
    t.skip, t.inner = first_inside, inner
    if t.done or inner <= last:
        t.final = True
        return
    t.parent = (t.lo, t.hi, grid, first_inside, inner)
    t.slack = 1
    _pick_cells(t, grid, first_inside, inner)


def _pick_cells(t: _Target, grid, first_inside: int, inner: int) -> None:
    positions = [r - first_inside for r in t.open_ranks]
    left = math.floor(min(positions) / inner * GRID) - t.slack
    right = math.ceil((max(positions) + 1) / inner * GRID) + t.slack
    if left >= 0:
        t.lo = grid[left]
    if right <= GRID:
        t.hi = grid[right]
