"""Embedding near-duplicates by exact comparison of all pairs (operator 4).

Vectors are dealt by hash to chunks of at most ``CHUNK`` of them.  A job a chunk
gives it to all tasks, which read the other vectors from the one table they
were written to: every unordered pair is met once, and neither vectors nor
pairs are ever shuffled for it, so disk grows with the table and not with the
number of pairs.

Unit vectors with cosine >= c are within squared distance 2 - 2c, and so is any
part of them after a rotation.  A tile of pairs is one matrix product over
``dims`` coordinates; what is near there is judged by the exact cosine (after a
product over all coordinates, if much is).  A task returns, per vector, its
number of links and the smallest vector it is connected with there.

Equal vectors are folded before.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components

#: Vectors of a chunk, on average, and their bytes at most: what every worker holds.
CHUNK, CHUNK_BYTES = 65_536, 32 << 20
#: Vectors that a task reads, at most and on average, and the tasks that a job is dealt to if there are vectors for it.
TASK_ROWS, TASKS = 32_768, 24
TILE = 1_024
#: Share of a tile's pairs that are judged one by one without a product over all coordinates.
FEW = 0.02
#: Relative slack on the budgets, above all rounding of the rotation.
SLACK = 1e-4
#: Above the rounding of squared distances of unit vectors in single precision.
ROUNDING = 1e-5


def rotation(d: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def valid(vector: Column) -> Column:
    """True for vectors that can have a cosine: not null or empty, finite, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class _Union:
    """Smallest-label union over positions, fed with arrays of pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def grow(self, n: int) -> int:
        """So many positions more; returns the first."""
        first = len(self.label)
        self.label = np.r_[self.label, np.arange(first, first + n)]
        return first

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.label[a], self.label[b]
            differ = x != y
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            low, high = np.minimum(x, y), np.maximum(x, y)
            np.minimum.at(self.label, high, low)
            while (self.label[self.label] != self.label).any():
                self.label = self.label[self.label]


class _Side:
    """Vectors of one length with what comparing them takes."""

    def __init__(self, rep: np.ndarray, n: np.ndarray, vector: np.ndarray, dims: int, turned: np.ndarray):
        self.rep, self.n, self.vector, d = rep, n, vector, vector.shape[1]
        x = vector.astype(np.float64)
        self.norm = np.sqrt((x * x).sum(axis=1))
        x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in the square
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        x = (x @ turned).astype(np.float32)
        self.cuts = [min(dims, d), d]
        # one product gives |p - q|^2; single precision is off by far less than ROUNDING, and what passes is judged anew
        self.part = [(x[:, :c], (x[:, :c] * x[:, :c]).sum(axis=1)[:, None]) for c in self.cuts]

    def rows(self, cut: int, at: slice) -> np.ndarray:
        part, square = self.part[cut]
        return np.hstack([-2 * part[at], square[at], np.ones_like(square[at])])

    def columns(self, cut: int, at: slice) -> np.ndarray:
        part, square = self.part[cut]
        return np.hstack([part[at], np.ones_like(square[at]), square[at]]).T.copy()


def linked_pairs(own: _Side, other: _Side, cosine: float, later: np.ndarray | None = None):
    """Arrays ``a, b`` of places with a cosine of ``cosine`` or more, some at a time.

    Rows where ``later`` is true are pairs with smaller names of ``other`` only.
    """
    limit = (2 - 2 * cosine) * (1 + SLACK)
    far = [np.float32(limit * (1 + SLACK) + ROUNDING * max(1.0, c / 64)) for c in own.cuts]
    for j in range(0, len(other.rep), TILE):
        columns, whole = other.columns(0, slice(j, j + TILE)), None
        for i in range(0, len(own.rep), TILE):
            at = slice(i, i + TILE)
            near = np.flatnonzero(own.rows(0, at) @ columns <= far[0])
            if len(near) > FEW * TILE * TILE:
                whole = other.columns(1, slice(j, j + TILE)) if whole is None else whole
                near = np.flatnonzero(own.rows(1, at) @ whole <= far[1])
            a, b = i + near // columns.shape[1], j + near % columns.shape[1]
            if later is not None and len(a):
                keep = ~later[a] | (own.rep[a] > other.rep[b])
                a, b = a[keep], b[keep]
            for k in range(0, len(a), 200_000):
                u, v = a[k:k + 200_000], b[k:k + 200_000]
                x, y = own.vector[u].astype(np.float64), other.vector[v].astype(np.float64)
                linked = (x * y).sum(axis=1) / (own.norm[u] * other.norm[v]) >= cosine
                yield u[linked], v[linked]


def _sides(rows: pa.RecordBatch | pa.Table, kind: str, dims: int, held: dict[int, np.ndarray]) -> dict[int, tuple[_Side, np.ndarray]]:
    """Vectors by length, with their places in ``rows``."""
    d, out = rows.column("d").to_numpy(), {}
    rep, n, vector = rows.column("rep").to_numpy(), rows.column("n").to_numpy(), rows.column("vector")
    for size in np.unique(d).tolist():
        place = np.flatnonzero(d == size)
        flat = vector.take(pa.array(place))
        flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
        if size not in held:
            held[size] = rotation(size)
        x = flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(kind)
        out[size] = _Side(rep[place], n[place], x, dims, held[size]), place
    return out


def near_duplicates(df: DataFrame, cosine: float = 0.95, dims: int = 16, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows ``(vec_id, n_links, component_id, kept)``, one per input row.

    Cosines are taken in double precision on the original vectors.  Null,
    empty and zero vectors, and vectors with null or non-finite components,
    link with nothing, nor do rows with a null key (their component is null,
    kept is false).  Vectors of different lengths do not link.  Equal vectors
    and repeated rows link, each row counting as one vector.  Other columns
    are ignored; an empty table gives no rows.
    """
    spark, scratch = df.sparkSession, Scratch(df.sparkSession, "vectors")
    # single-precision vectors travel as such; cosines are taken in double precision all the same
    kind = "float" if df.schema[vector].dataType.simpleString() == "array<float>" else "double"
    rows = df.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    usable = F.col("vec_id").isNotNull() & valid(F.col("vector"))
    same = F.transform("vector", lambda x: x + F.lit(0.0))  # 0 and -0 are equal
    folded = rows.where(usable).groupBy("vector").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("n"))
    # one vector id may stand for several vectors; the join needs one name per vector
    n_rows = rows.count()
    parts = max(1, math.ceil(n_rows / TASK_ROWS), min(TASKS, math.ceil(n_rows / TILE)))
    name, check = F.xxhash64("vector", F.lit(1)), F.xxhash64("vector")
    folded = folded.withColumn("vector", same).select("vec_id", "n", name.alias("rep"), check.alias("h"), F.size("vector").alias("d"),
                                                      F.col("vector").cast(f"array<{kind}>").alias("vector"))
    folded = scratch.write(folded.repartition(parts, "rep"), "folded")
    number, numbers = folded.agg(F.count(F.lit(1)), F.sum("d")).first()
    chunks = max(1, math.ceil(number / CHUNK), math.ceil((numbers or 0) * (4 if kind == "float" else 8) / CHUNK_BYTES))
    chunked = folded.withColumn("c", F.pmod(F.xxhash64("rep", F.lit(2)), F.lit(chunks)).cast("int"))
    dtype = "float32" if kind == "float" else "float64"

    def compared(chunk: int) -> DataFrame:
        """Links between a chunk's vectors and those of it and of later chunks."""
        table = spark.sparkContext.broadcast(chunked.where(F.col("c") == chunk).select("rep", "n", "d", "vector").toArrow())

        def run(batches):
            held: dict[int, np.ndarray] = {}
            base = _sides(table.value, dtype, dims, held)
            union, reps, links, at = _Union(len(table.value)), [table.value.column("rep").to_numpy()], [np.zeros(len(table.value), np.int64)], 0
            for b in batches:
                first = union.grow(b.num_rows)
                reps.append(b.column("rep").to_numpy())
                links.append(np.zeros(b.num_rows, np.int64))
                for size, (own, place) in _sides(b, dtype, dims, held).items():
                    if size not in base:
                        continue
                    other, there = base[size]
                    later = b.column("c").to_numpy()[place] == chunk
                    for u, v in linked_pairs(own, other, cosine, later):
                        np.add.at(links[-1], place[u], other.n[v])
                        np.add.at(links[0], there[v], own.n[u])
                        union.add(first + place[u], there[v])
            rep, links = np.concatenate(reps), np.concatenate(links)
            out = np.flatnonzero(links)
            if len(out):
                label = union.label[out]
                order = np.lexsort((rep[out], label))
                start = np.flatnonzero(np.r_[True, np.diff(label[order]) != 0])
                low = np.empty(len(out), np.int64)
                low[order] = np.repeat(rep[out][order][start], np.diff(np.r_[start, len(out)]))
                yield pa.RecordBatch.from_arrays([pa.array(rep[out]), pa.array(links[out]), pa.array(low)], names=["rep", "links", "low"])

        found = chunked.where(F.col("c") >= chunk).select("rep", "n", "d", "vector", "c").mapInArrow(run, "rep long, links long, low long")
        found = scratch.write(found, "linked")
        table.unpersist()
        return found

    linked = compared(0)
    for chunk in range(1, chunks):
        linked = linked.unionByName(compared(chunk))
    edges = linked.where("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b"))
    whole = components(scratch, edges)
    counts = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    named = folded.select("vec_id", "n", "rep", "h").join(counts, "rep", "left").join(whole.withColumnRenamed("node", "rep"), "rep", "left").select(
        "rep", "h", "vec_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("c"))
    named = scratch.write(named, "named")
    lowest = scratch.write(named.groupBy("c").agg(F.min("vec_id").alias("component_id")), "lowest")
    named = named.join(lowest, "c").select("rep", "h", "n_links", "component_id")
    # null when a row takes no part, so that it meets nothing
    asked = rows.withColumn("vector", F.when(usable, same)).select("vec_id", F.when(usable, name).alias("rep"), F.when(usable, check).alias("h"))
    joined = asked.join(named, ["rep", "h"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
