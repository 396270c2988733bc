"""Figures of a table taken while it is written, so that nothing has to read it again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tablewright.functions.cleaning import col_of
from tablewright.operators.profile import missing_sql
from tablewright.operators.projection import column_kind

SPLITS = ("train", "val", "test")


@dataclass(frozen=True)
class WriteFacts:
    """What one write put down: its place, columns with kinds, rows, missing cells per
    column, and rows and missing cells per split."""

    path: str
    kinds: Mapping[str, str]
    rows: int
    missing: Mapping[str, int]
    splits: Mapping[str, int] = field(default_factory=dict)
    split_missing: Mapping[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return list(self.kinds)

    @property
    def missing_cells(self) -> int:
        return sum(self.missing.values())


def observed_write(df: DataFrame, path: str, write, split: str | None = None,
                   splits: Sequence[str] = SPLITS) -> WriteFacts:
    """Run `write(df)` and return what it wrote.

    The figures are sums collected in the tasks that write, one small row per task, and need no
    shuffle and no scan of their own; a task that is run again counts once. A cell is missing where
    it is NULL or NaN. With `split`, rows and missing cells are also counted per value of that
    column; rows of a value not listed in `splits` raise after the write, as do rows without one. An
    empty table gives zeros.
    """
    measured = [c for c in df.columns if c != split]
    empty = {c: F.expr(missing_sql(df, c)) for c in measured}
    sums = [F.count(F.lit(1)).alias("rows")]
    sums += [F.count_if(gone).alias(f"m{i}") for i, gone in enumerate(empty.values())]
    if split is not None:
        gaps = sum((e.cast("bigint") for e in empty.values()), F.lit(0).cast("bigint"))
        for i, name in enumerate(splits):
            inside = col_of(split) == F.lit(name)
            sums.append(F.count_if(inside).alias(f"n{i}"))
            sums.append(F.sum(F.when(inside, gaps)).alias(f"g{i}"))
    seen = Observation()
    write(df.observe(seen, *sums))
    got = seen.get
    sizes = {name: got[f"n{i}"] for i, name in enumerate(splits)} if split is not None else {}
    if split is not None and sum(sizes.values()) != got["rows"]:
        raise ValueError(f"{got['rows'] - sum(sizes.values())} rows belong to none of {', '.join(splits)}")
    return WriteFacts(
        path, {f.name: column_kind(f.dataType) for f in df.schema if f.name != split}, got["rows"],
        {c: got[f"m{i}"] for i, c in enumerate(measured)}, sizes,
        {name: got[f"g{i}"] or 0 for i, name in enumerate(splits)} if split is not None else {})
