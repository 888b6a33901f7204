"""Removal of repeated byte strings by prefix doubling over thinned positions (operator 6).

Prefix doubling ranks the string of 2m bytes at a position by the pair of the
ranks of its two halves.  Ranks here are 64-bit fingerprints, so the rounds up
to ``SEED`` bytes need no shuffle: rank(i, 2m) mixes rank(i, m) and
rank(i + m, m).  From there Spark compares ranks over the whole corpus, but
not at every position: of each window of ``length`` bytes only the position of
the smallest seed rank is kept.  Equal windows keep the same place, so a window
whose seed rank is unique has no equal and drops out.  Consecutive windows
with the same place form a *run*.  The next, longer ranks are those of whole
runs: if a run occurs again as a whole, all its windows are repeated.  Only
where runs with one seed differ are their windows ranked at full length (pairs
of the ranks at both ends of the seed's rounds) and counted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, slices

#: Bytes of the seed rank; a power of two.
SEED = 32
_ADD, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S31, _S29 = np.uint64(31), np.uint64(29)


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The fingerprint of a pair of ranks."""
    x = (a ^ (a >> _S31)) * _M1 + b * _M2 + _ADD
    return x ^ (x >> _S29)


def ranks(data: np.ndarray, length: int, start: np.ndarray | None = None) -> np.ndarray:
    """Rank of the ``length``-byte string at every position, by doubling; the last pair may overlap."""
    r, m = (data.astype(np.uint64) + np.uint64(1)) * _ADD if start is None else start, 1 if start is None else SEED
    while 2 * m <= length:
        r, m = pair(r[:len(r) - m], r[m:]), 2 * m
    if m < length:
        gap = length - m
        r = pair(r[:len(r) - gap], r[gap:])
    return r


def first_smallest(r: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` values, the place of its smallest (of equal ones, the first)."""
    low, m = r, 1
    at = np.arange(len(r), dtype=np.int64)
    while m < width:
        step = min(m, width - m)
        left, right = low[:len(low) - step], low[step:]
        later = right < left
        # overlapping halves keep the first of equals, since the left half comes first
        low, at = np.where(later, right, left), np.where(later, at[step:], at[:len(at) - step])
        m += step
    return at


def runs(data: np.ndarray, length: int):
    """(place, first window, last window, seed rank) of every run; all windows of ``length`` bytes are in one."""
    seed = ranks(data, SEED)
    at = first_smallest(seed, length - SEED + 1)
    ends = np.flatnonzero(np.append(at[1:] != at[:-1], True))
    first = np.append(0, ends[:-1] + 1)
    return at[ends], first, ends, seed


#: A text is ranked in stretches of so many windows; runs are cut there, which costs window ranks but no result.
STRETCH = 4 << 20
#: Seeds with up to so many different runs are compared in one task, as their bytes; the windows of larger ones are
#: counted in Spark.  Few, so that what a task gathers of one passage is bounded and both ways grow with the input.
TOGETHER = 8

RUN = "k1 long, k2 int, first long, last long, seed long, run long"


def _all_runs(data: bytes, length: int):
    """(first, last, seed rank, run rank) of every run of a text."""
    for at in range(0, max(0, len(data) - length + 1), STRETCH):
        part = data[at:at + STRETCH + length - 1]
        place, first, last, seed = runs(np.frombuffer(part, np.uint8), length)
        whole = [xxhash.xxh3_64_intdigest(part[a:b + length]) for a, b in zip(first.tolist(), last.tolist())]
        whole = np.array(whole, np.uint64) + (place - first).astype(np.uint64) * _ADD  # equal bytes, equal place
        yield first + at, last + at, seed[place].view(np.int64), whole.view(np.int64)


def _emit_runs(length: int):
    def run(batches):
        for b in (b for whole in batches for b in slices(whole)):
            cols = [[] for _ in range(6)]
            for k1, k2, text in zip(*[b.column(i).to_pylist() for i in range(3)]):
                for made in _all_runs((text or "").encode(), length):
                    n = len(made[0])
                    for c, x in zip(cols, (np.full(n, k1, np.int64), np.full(n, k2, np.int32), *made)):
                        c.append(x)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names=["k1", "k2", "first", "last", "seed", "run"])

    return run


def _cut(length: int):
    """Per text and its open runs: the bytes of each."""
    names = ["k1", "k2", "first", "seed", "run", "m", "d"]

    def run(batches):
        for b in (b for whole in batches for b in slices(whole)):
            cols, data = [[] for _ in names], []
            for k1, k2, text, held in zip(*[b.column(i).to_pylist() for i in range(4)]):
                raw = text.encode()
                for r in held:
                    for c, x in zip(cols, (k1, k2, r["first"], r["seed"], r["run"], r["m"], r["d"])):
                        c.append(x)
                    data.append(raw[r["first"]:r["last"] + length])
            kinds = [pa.int64(), pa.int32()] + [pa.int64()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)] + [pa.array(data, pa.binary())], names=names + ["data"])

    return run


def _window_ranks(data: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, window, rank) for all windows of several byte strings, ranked in one pass over their concatenation."""
    sizes = np.array([len(x) for x in data])
    starts = np.cumsum(sizes) - sizes
    r = ranks(np.frombuffer(b"".join(data), np.uint8), length)
    n = sizes - length + 1
    row = np.repeat(np.arange(len(data)), n)
    window = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return row, window, r[starts[row] + window]


def _compare_together(length: int):
    """Rows sorted by seed: intervals (a, b) of the bytes that lie in a window which another run of the seed holds too."""
    def told(rows: list[dict]):
        rows = list({(r["seed"], r["run"]): r for r in rows}.values())  # repeated rows of a table
        row, window, rank = _window_ranks([r["data"] for r in rows], length)
        seed = np.array([r["seed"] for r in rows], np.int64).view(np.uint64)
        _, which, n = np.unique(pair(rank, seed[row]), return_inverse=True, return_counts=True)
        hit = (n[which] > 1) & (np.array([r["m"] for r in rows])[row] == 1)
        row, window = row[hit], window[hit]
        if not len(row):
            return None
        new = np.append(True, (row[1:] != row[:-1]) | (window[1:] != window[:-1] + 1))
        a, b = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(row)) - 1
        own = [rows[i] for i in row[a].tolist()]
        first = np.array([r["first"] for r in own])
        return pa.RecordBatch.from_arrays(
            [pa.array([r["k1"] for r in own], pa.int64()), pa.array([r["k2"] for r in own], pa.int32()),
             pa.array(first + window[a]), pa.array(first + window[b] + length)], names=["k1", "k2", "a", "b"])

    def run(batches):
        rows, size = [], 0
        for part in (part for whole in batches for part in slices(whole)):
            for r in part.to_pylist():
                if size > 4 << 20 and r["seed"] != rows[-1]["seed"]:
                    if (out := told(rows)) is not None:
                        yield out
                    rows, size = [], 0
                rows.append(r)
                size += len(r["data"])
        if rows and (out := told(rows)) is not None:
            yield out

    return run


def _explode_windows(length: int):
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                rows = b.slice(at, 2000).to_pylist()
                row, window, rank = _window_ranks([r["data"] for r in rows], length)
                take = lambda k, t=np.int64: np.array([r[k] for r in rows], t)[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(take("k1")), pa.array(take("k2", np.int32)), pa.array(take("first") + window), pa.array(take("run")),
                     pa.array(take("m")), pa.array(pair(rank, take("seed").view(np.uint64)).view(np.int64))],
                    names=["k1", "k2", "a", "run", "m", "rank"])

    return run


def _apply(intervals: list[tuple[int, int]], data: bytes) -> tuple[list[tuple[int, int]], bytes]:
    """Merged intervals, and the bytes outside them."""
    merged: list[list[int]] = []
    for a, b in sorted(intervals):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    kept, at = [], 0
    for a, b in merged:
        kept.append(data[at:a])
        at = b
    return [tuple(m) for m in merged], b"".join([*kept, data[at:]])


def remove_repeats(df: DataFrame, length: int = 200, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``df`` plus ``removed_spans`` array<struct<a long, b long>> (byte offsets) and ``kept`` binary.

    Every byte covered by a ``length``-byte string that also starts anywhere
    else in the table goes (the same text included; overlaps count; judged on
    the input).  Strings never cross texts.  Null and empty texts, and texts
    shorter than ``length`` bytes, keep all they have.  Rows that repeat each
    other in full lose all that they share, that is everything from ``length``
    bytes on.  Null keys are allowed, other columns pass through, an empty
    table stays empty.  Ranks are 64-bit fingerprints, compared within one seed
    rank of 64 bits.
    """
    if length < SEED:
        raise ValueError(f"length must be {SEED} or more")
    scratch = Scratch(df.sparkSession, "suffix")
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keys = [F.xxhash64(F.col(f"`{key}`"), t).alias("k1"), F.hash(t).alias("k2")]
    docs = df.select(*keys, t.alias("text")).where(F.octet_length("text") >= length)

    found = scratch.write(docs.mapInArrow(_emit_runs(length), RUN), "runs")
    again = scratch.write(found.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("seed"), "seeds")
    shared = scratch.write(found.join(again, "seed", "left_semi").select(*found.columns), "shared")
    scratch.drop(found, again)
    kinds = shared.groupBy("seed", "run").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("k1", "k2", "first", "last")).alias("x"))
    kinds = scratch.write(kinds, "kinds")
    whole = scratch.write(shared.join(kinds.where("m > 1").select("seed", "run"), ["seed", "run"])
                          .select("k1", "k2", F.col("first").alias("a"), (F.col("last") + length).alias("b")), "whole")
    several = scratch.write(kinds.groupBy("seed").agg(F.count(F.lit(1)).alias("d")).where("d > 1"), "several")
    opened = kinds.join(several, "seed").select("x.k1", "x.k2", F.struct("x.first", "x.last", "seed", "run", "m", "d").alias("r"))
    opened = scratch.write(opened.groupBy("k1", "k2").agg(F.collect_list("r").alias("held")), "open")  # bounded by the text
    cut = docs.join(opened, ["k1", "k2"]).select("k1", "k2", "text", "held").mapInArrow(
        _cut(length), "k1 long, k2 int, first long, seed long, run long, m long, d long, data binary")
    cut = scratch.write(cut, "cut")
    scratch.drop(shared, several, opened)

    interval = "k1 long, k2 int, a long, b long"
    few = cut.where(F.col("d") <= TOGETHER).repartition("seed").sortWithinPartitions("seed").mapInArrow(_compare_together(length), interval)
    many = scratch.write(cut.where(F.col("d") > TOGETHER).mapInArrow(
        _explode_windows(length), "k1 long, k2 int, a long, run long, m long, rank long"), "windows")
    twice = scratch.write(many.groupBy("rank").agg(F.min("run").alias("low"), F.max("run").alias("high")).where("low < high").select("rank"), "twice")
    many = many.where("m = 1").join(twice, "rank", "left_semi").select("k1", "k2", "a", (F.col("a") + length).alias("b"))
    spans = whole.unionByName(few).unionByName(many).groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "b")).alias("spans__"))
    spans = scratch.write(spans, "spans")  # per text, bounded by its length
    scratch.drop(whole, cut, kinds, twice)

    def cut_out(batches):
        for b in (b for whole in batches for b in slices(whole)):
            at = b.schema.get_field_index
            made, kept = [], []
            for raw, own in zip(b.column(at("text__")).to_pylist(), b.column(at("spans__")).to_pylist()):
                data = raw.encode()
                merged, rest = _apply([(s["a"], s["b"]) for s in own or []], data)
                made.append([{"a": x, "b": y} for x, y in merged])
                kept.append(rest)
            pair_type = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column(at(c)) for c in names] + [pa.array(made, pair_type), pa.array(kept, pa.binary())],
                                             names=names + ["removed_spans", "kept"])

    names = [c for c in df.columns if c not in ("removed_spans", "kept")]
    schema = T.StructType([df.schema[c] for c in names] + [
        T.StructField("removed_spans", T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))),
        T.StructField("kept", T.BinaryType())])
    told = df.select(*[f"`{c}`" for c in names], *[k.alias(f"{n}__") for k, n in zip(keys, ("k1", "k2"))], t.alias("text__"))
    spans = spans.withColumnsRenamed({"k1": "k1__", "k2": "k2__"})
    return told.join(spans, ["k1__", "k2__"], "left").mapInArrow(cut_out, schema)
