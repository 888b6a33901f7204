"""Embedding whitening by Chebyshev-filtered subspace iteration (operator 11).

The leading eigenvectors of a covariance are found without forming it: a block
of directions Q is multiplied by the covariance in passes over the rows, each
task summing its rows' part of X'(XQ) for centred X.  A round applies a
Chebyshev polynomial of the covariance to the block by its three-term
recurrence, one pass a degree: the polynomial is small on the interval that
holds the unwanted eigenvalues and grows fast above it.  Then QR, and a
Rayleigh-Ritz step in the block, whose pass also gives the residuals.  Rounds
end when every wanted pair is certified by its residual, or rounding stops
further progress.  The interval's lower end comes from a few Lanczos steps, its
upper end is the block's smallest Ritz value.

Entries are integers; centring is exact (n*x - S) before anything is multiplied.
Driver and tasks hold dimensions x block numbers, whatever the table.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices

#: Degree of a round's polynomial, Lanczos steps, and rounds at most (an error beyond).
DEGREE, LANCZOS, MAX_ROUNDS = 10, 12, 60
#: A pair is certified once its residual is below this share of the largest eigenvalue.
CERTIFIED = 1e-13
#: Entries beyond this are cut to it, so that sums of integers stay exact.
LIMIT = 2.0**31
#: Integers kept from 64-bit squares by going over to Python's.
SAFE = 2.0**62


def entries(vector: pa.Array, d: int) -> np.ndarray:
    """The list column's values as a matrix of ``d`` columns."""
    return vector.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def summed(df: DataFrame, d: int, width: int, part: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """Sum over all rows of ``part(rows)``, a (lines x width) matrix, where ``rows`` are batches of the column ``z``.

    A task adds up its batches and gives one row per line; these are added by Spark.
    """
    def run(batches):
        total = None
        for b in (b for whole in batches for b in slices(whole, 4096)):
            own = part(entries(b.column(0), d))
            total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(list(total))], names=["i", "v"])

    parts = df.select("z").mapInArrow(run, f"i int, v array<{kind}>")
    number = "decimal(38,0)" if kind == "bigint" else kind
    rows = parts.groupBy("i").agg(*[F.sum(F.col("v")[j].cast(number)).alias(f"s{j}") for j in range(width)]).orderBy("i").collect()
    return np.array([list(r)[1:] for r in rows], object if kind == "bigint" else np.float64).reshape(-1, width)


class Spectrum:
    """Leading eigenpairs of the covariance of ``rows`` (column ``z`` = n*x - S, array<long>)."""

    def __init__(self, rows: DataFrame, n: int, d: int):
        self.rows, self.n, self.d, self.passes = rows, n, d, 0

    def times(self, q: np.ndarray) -> np.ndarray:
        """The covariance times ``q``, by one pass."""
        self.passes += 1
        n, d = self.n, self.d

        def part(z: np.ndarray) -> np.ndarray:
            x = z / n
            return x.T @ (x @ q)

        return summed(self.rows, d, q.shape[1], part) / n

    def lowest(self, rng: np.random.Generator) -> float:
        """A lower bound, but for rounding, of the smallest eigenvalue that a random vector shows in a few Lanczos steps."""
        v, basis, alpha, beta = rng.standard_normal((self.d, 1)), [], [], []
        v /= np.linalg.norm(v)
        for _ in range(min(LANCZOS, self.d)):
            basis.append(v)
            w = self.times(v)
            alpha.append((v.T @ w).item())
            whole = np.hstack(basis)
            for _ in range(2):
                w -= whole @ (whole.T @ w)
            beta.append(np.linalg.norm(w))
            if beta[-1] <= 1e-12 * max(alpha):
                break
            v = w / beta[-1]
        values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta[:-1], 1) + np.diag(beta[:-1], -1))
        return max(0.0, values[0] - beta[-1] * abs(vectors[-1, 0]))

    def filtered(self, q: np.ndarray, low: float, high: float, top: float) -> np.ndarray:
        """The block after the polynomial that damps [low, high], scaled to 1 at ``top``."""
        half, centre = (high - low) / 2, (high + low) / 2
        first = scale = half / (top - centre)
        before, now = q, (self.times(q) - centre * q) * (scale / half)
        for _ in range(DEGREE - 1):
            then = 1 / (2 / first - scale)
            before, now = now, (self.times(now) - centre * now) * (2 * then / half) - (scale * then) * before
            scale = then
        return now

    def leading(self, k: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` largest eigenvalues, falling, and their unit vectors as columns."""
        rng = np.random.default_rng(seed)
        block = min(self.d, k + max(4, k // 2))
        q, low, best, stalled = np.linalg.qr(rng.standard_normal((self.d, block)))[0], None, math.inf, 0
        for _ in range(MAX_ROUNDS):
            image = self.times(q)
            inner = q.T @ image
            values, turn = np.linalg.eigh((inner + inner.T) / 2)
            values, turn = values[::-1], turn[:, ::-1]
            q, image = q @ turn, image @ turn
            residual = np.linalg.norm(image - q * values, axis=0)[:k].max()
            if residual < best / 2:
                best, kept, stalled = residual, (values[:k], q[:, :k]), 0
            else:
                stalled += 1
            top = values[0]
            if top <= 0 or residual <= CERTIFIED * top or block == self.d or (stalled >= 2 and best <= 1e-10 * top):
                return kept
            if low is None:
                low = self.lowest(rng)
            high = max(values[-1], low + 1e-9 * top)
            q = np.linalg.qr(self.filtered(q, low, high, top) if high < top else image)[0]
        raise RuntimeError(f"residual {best} of eigenvalue {top} after {MAX_ROUNDS} rounds")


def whiten(df: DataFrame, components: int = 32, scale: int = 64, shift: int = 1_000_000,
           key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows ``(vec_id, component, n, deviation, whitened, explained, identity_error)``.

    Rows whose vector is null, empty or holds null or non-finite entries are
    left out.  An entry c becomes the integer floor(scale * c) + shift (cut
    to +-2**31 before the shift).  Vectors of different lengths are fits of
    their own.  One output row per remaining row and component, up to the
    numerical rank; repeated rows and null keys count and are returned like all
    others.  ``deviation`` is null where it does not fit a long.  Other columns
    are ignored; an empty table gives no rows.
    """
    spark, scratch = df.sparkSession, Scratch(df.sparkSession, "whitening")
    v = F.col("vector")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    rows = rows.where(F.coalesce((F.size(v) > 0) & finite, F.lit(False)))
    whole = F.transform(v, lambda c: F.floor(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), c * scale))).cast("long") + shift)
    rows = scratch.write(rows.select("vec_id", F.size(v).alias("d"), whole.alias("z")), "integers")
    lengths = [(r["d"], r["n"]) for r in rows.groupBy("d").agg(F.count(F.lit(1)).alias("n")).collect()]
    results = [_whitened(scratch, rows.where(F.col("d") == d), d, n, components) for d, n in sorted(lengths)]
    out = spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    for r in results:
        out = out.unionByName(r)
    return out


def _whitened(scratch: Scratch, rows: DataFrame, d: int, n: int, components: int) -> DataFrame:
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    sums = np.array(summed(rows, d, 1, lambda z: z.sum(axis=0)[:, None], "bigint")[:, 0].tolist(), dtype=np.int64)

    def centre(batches):
        for b in (b for whole in batches for b in slices(whole, 4096)):
            z = n * entries(b.column(1), d) - sums
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * d), pa.array(z.reshape(-1)))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], names=["vec_id", "z"])

    centred = scratch.write(rows.select("vec_id", "z").mapInArrow(centre, "vec_id long, z array<long>"), "centred")
    trace = summed(centred, d, 1, lambda z: np.array([[((z / n) ** 2).sum()]]))[0, 0] / n
    values, q = Spectrum(centred, n, d).leading(min(components, d))
    rank = int((values > d * np.finfo(float).eps * max(values[0], 0)).sum())
    if not rank:
        return rows.sparkSession.createDataFrame([], schema)
    values, q = values[:rank], q[:, :rank]
    basis = q / np.sqrt(values)

    def moments(z: np.ndarray) -> np.ndarray:
        w = (z / n) @ basis
        return np.vstack([w.T @ w, w.sum(axis=0)])

    told = summed(centred, d, rank, moments) / n
    error = float(np.abs(told[:-1] - np.outer(told[-1], told[-1]) - np.eye(rank)).max())

    def project(batches):
        for b in (b for whole in batches for b in slices(whole, 1024)):
            z = entries(b.column(1), d)
            w = (z / n) @ basis
            if np.square(z, dtype=np.float64).sum(axis=1).max(initial=0) < SAFE:
                deviation = pa.array((z * z).sum(axis=1))
            else:
                exact = [sum(c * c for c in line) for line in z.tolist()]
                deviation = pa.array([e if e < 2**63 else None for e in exact], pa.int64())
            row, m = np.repeat(np.arange(len(z)), rank), len(z) * rank
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row)), pa.array(np.tile(np.arange(1, rank + 1, dtype=np.int32), len(z))),
                 pa.array(np.full(m, n)), deviation.take(pa.array(row)), pa.array(w.reshape(-1)),
                 pa.array(np.tile(values / trace, len(z))), pa.array(np.full(m, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return centred.select("vec_id", "z").mapInArrow(project, schema)
