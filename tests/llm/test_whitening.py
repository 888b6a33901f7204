"""Operator 11 against a dense eigendecomposition with exact integers."""

import numpy as np
import pytest

from bundles.llm import queries, whitening

SF = "/root/testdata/sf0.01"


def dense(vectors, k):
    """n, deviation, projections (any sign), explained by numpy."""
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    z = n * x - s
    deviation = [sum(c * c for c in line) for line in z.tolist()]
    c = z / n
    cov = c.T @ c / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    rank = int((e > len(cov) * np.finfo(float).eps * e[0]).sum()) if e[0] > 0 else 0
    return n, deviation, c @ v[:, :rank] / np.sqrt(e[:rank]), e[:rank] / np.trace(cov), rank


def check(rows, vectors, k, tolerance=1e-9):
    """``rows`` of the vectors whose ids are their positions."""
    n, deviation, white, explained, rank = dense(vectors, k)
    assert len(rows) == n * rank
    got = np.zeros((n, rank))
    for r in rows:
        got[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == deviation[r.vec_id] and r.identity_error <= 1e-6
        assert abs(r.explained / explained[r.component - 1] - 1) <= 1e-9
    sign = np.sign((got * white).sum(axis=0))
    assert np.abs(got * sign - white).max() <= tolerance * max(1, np.abs(white).max())


def table(spark, vectors, more=()):
    return spark.createDataFrame([(i, [float(c) for c in v], -1) for i, v in enumerate(vectors)] + [(*m, -1) for m in more],
                                 "vec_id long, embedding array<float>, n int")


def test_op11_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    out = queries.QUERIES["op11_whitening"](spark, SF)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    ids = {r.vec_id: i for i, r in enumerate(rows)}
    got = out.collect()
    assert sorted(ids.values()) == sorted(ids)[:len(ids)]
    check(got, [r.embedding for r in rows], 32)


@pytest.mark.parametrize("d, k, spread", [(24, 4, "falling"), (40, 5, "clustered"), (6, 6, "falling")])
def test_spectra(spark, d, k, spread):
    rng = np.random.default_rng(1)
    scale = {"falling": 2.0 ** -np.arange(d), "flat": np.ones(d), "clustered": np.where(np.arange(d) < 10, 9.0, 1.0)}[spread]
    x = rng.standard_normal((700, d)) * scale * 30 + 100
    x = x.astype(np.float32)
    check(whitening.whiten(table(spark, x), k).collect(), x, k, 1e-7)


def test_left_out_and_degenerate_rows(spark):
    rng = np.random.default_rng(2)
    x = np.repeat(rng.standard_normal((5, 8)), 9, axis=0).astype(np.float32)  # copies; rank 4 at most
    odd = [(90, None), (91, []), (92, [float("nan")] * 8), (93, [float("inf")] * 8), (94, [None] * 8)]
    out = whitening.whiten(table(spark, x, odd), 6).collect()
    check(out, x, 6)
    assert max(r.component for r in out) == 4
    # other lengths are fits of their own; constant vectors have no component
    both = whitening.whiten(table(spark, x, [(100, [1.0, 2.0]), (101, [3.0, 5.0]), (102, [0.0])]), 6).collect()
    assert len(both) == len(out) + 2 and {r.n for r in both} == {45, 2}
    assert whitening.whiten(table(spark, []), 6).collect() == []
    assert whitening.whiten(table(spark, [[1.0, 2.0]] * 4), 6).collect() == []


def test_large_entries_null_keys_and_sums_beyond_a_long(spark):
    vectors = [[3e38, 1.0], [-3e38, 2.0], [0.0, 5.0]] * 2000
    rows = whitening.whiten(spark.createDataFrame([(None, [float(c) for c in v]) for v in vectors], "vec_id long, embedding array<float>"), 2).collect()
    assert len(rows) == 12000 and all(r.vec_id is None and np.isfinite(r.whitened) for r in rows)
    assert {r.deviation is None for r in rows} == {True, False}


def test_filter_grows_only_what_is_wanted(spark):
    """Rounds of the filter do the work: the block is smaller than the space and the pairs are certified."""
    rng = np.random.default_rng(3)
    z = np.floor(rng.standard_normal((2000, 48)) * 64).astype(np.int64)
    z = 2000 * z - z.sum(axis=0)
    df = spark.createDataFrame([(v,) for v in z.tolist()], "z array<long>")
    spectrum = whitening.Spectrum(df, 2000, 48)
    values, q = spectrum.leading(8)
    cov = (z / 2000).T @ (z / 2000) / 2000
    assert q.shape == (48, 8) and spectrum.passes > whitening.LANCZOS + whitening.DEGREE
    assert np.abs(cov @ q - q * values).max() <= 1e-12 * values[0]
    assert np.allclose(values, np.linalg.eigvalsh(cov)[::-1][:8], rtol=1e-12)
