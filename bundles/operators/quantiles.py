"""Exact order statistics of whole columns by refining histograms.

The value of a given rank lies in one bin of a fixed-width histogram.  Every
round counts ``BINS`` bins inside the interval of each wanted rank, all columns
and ranks in one map-side combined aggregate, and takes the bin that holds the
rank, shrunk to the smallest and largest value found in it.  An interval of one
value is the answer.  A round divides an interval by ``BINS`` or more, so a few
scans do whatever the size of the table, and no task or driver ever holds more
than ranks x ``BINS`` counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 512


@dataclass
class _Interval:
    """Values in [low, high] of a column; ``below`` are smaller, ``rank`` (from 0) is inside."""
    column: str
    rank: int
    low: float
    high: float
    below: int = 0

    @property
    def open(self) -> bool:
        return self.low < self.high


def order_statistics(df: DataFrame, bounds: dict[str, tuple[int, float, float]], ranks: dict[str, Sequence[int]]) -> dict[tuple[str, int], float]:
    """``{(column, rank): value}`` of double columns; ``bounds``: column -> (non-null rows, smallest, largest finite value).

    Ranks count the finite values from 0.
    """
    wanted = [_Interval(c, r, bounds[c][1], bounds[c][2]) for c, rs in ranks.items() for r in sorted(set(rs))]
    while any(w.open for w in wanted):
        live = [w for w in wanted if w.open]
        # equal intervals of one column are counted once
        keys = sorted({(w.column, w.low, w.high, w.below) for w in live})
        cells = []
        for i, (c, low, high, _) in enumerate(keys):
            x = F.col(f"`{c}`")
            at = F.least(F.floor((x / 2 - low / 2) / (high / 2 - low / 2) * BINS), F.lit(BINS - 1)).cast("int")  # halves: no overflow
            cells.append(F.when(x.between(low, high), F.struct(F.lit(i).alias("i"), at.alias("bin"), x.alias("x"))))
        found = (df.select(F.explode(F.array_compact(F.array(*cells))).alias("cell")).select("cell.*")
                 .groupBy("i", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
                 .orderBy("i", "bin").collect())  # len(keys) * BINS rows at most
        for w in live:
            i, below = keys.index((w.column, w.low, w.high, w.below)), w.below
            for r in (r for r in found if r["i"] == i):
                if below + r["n"] > w.rank:
                    w.low, w.high, w.below = r["low"], r["high"], below
                    break
                below += r["n"]
    return {(w.column, w.rank): w.low for w in wanted}


def quantiles(df: DataFrame, bounds: dict[str, tuple[int, float, float]], shares: Sequence[float]) -> dict[str, list[float | None]]:
    """Interpolated quantiles per column, as ``quantile_cont``; null for a column without a value.

    Not-a-number and infinite values take no part.
    """
    places = {c: [s * (n - 1) for s in shares] for c, (n, _, _) in bounds.items() if n}
    told = order_statistics(df, bounds, {c: [k for p in ps for k in (int(p), min(int(p) + 1, bounds[c][0] - 1))] for c, ps in places.items()})
    out: dict[str, list[float | None]] = {c: [None] * len(shares) for c in bounds}
    for c, ps in places.items():
        for i, p in enumerate(ps):
            low, high = told[c, int(p)], told[c, min(int(p) + 1, bounds[c][0] - 1)]
            out[c][i] = low + (high - low) * (p - int(p))
    return out
