"""Operator 12 against plain Lloyd rounds in Python integers."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from bundles.llm import codes, queries

SF = "/root/testdata/sf0.01"


def plain(rows, parts=8, size=16, rounds=6):
    """rows: (vec_id, vector, label), all of one length that ``parts`` divides."""
    own = [(k, [int(np.floor(4096 * np.float64(x))) for x in v], label) for k, v, label in rows]
    w = len(own[0][1]) // parts
    first = sorted(own, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:size]
    cut = lambda v, p: v[w * p:w * (p + 1)]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def nearest(v, p):
        return min(range(len(books[p])), key=lambda e: (far(cut(v, p), books[p][e]), e))

    for _ in range(rounds):
        held = [[[] for _ in b] for b in books]
        for _, v, _ in own:
            for p in range(parts):
                held[p][nearest(v, p)].append(cut(v, p))
        books = [[[sum(c) // len(m) for c in zip(*m)] if m else e for m, e in zip(h, b)] for h, b in zip(held, books)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    coded = [(k, [nearest(v, p) for p in range(parts)], v, label) for k, v, label in own]
    error = [sum(far(cut(v, p), books[p][e]) for p, e in enumerate(c)) for _, c, v, _ in coded]
    by_label = defaultdict(int)
    for (*_, label), e in zip(coded, error):
        by_label[label] += e
    return sorted(((k, "".join(f"{e:02x}" for e in c), er, by_label[label], digest) for (k, c, _, label), er in zip(coded, error)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame([(k, v, label, "x") for k, v, label in rows], "vec_id long, embedding array<float>, label int, code string")


def test_op12_whole_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    out = queries.QUERIES["op12_vector_codes"](spark, SF)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert got(out) == plain(rows)


@pytest.mark.parametrize("block, leaf", [(4096, 24), (64, 3)])
def test_clusters_copies_ties_and_null_labels(spark, monkeypatch, block, leaf):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 16)) * 3
    x = np.float32(centres[rng.integers(0, 12, 600)] + rng.standard_normal((600, 16)) * rng.choice([0, 0.01, 1], (600, 1)))
    x[:40] = x[0]  # equal first entries: unused ones stay
    x[300:420] = np.round(x[300:420])  # ties
    rows = [(int(i) - 50 if i % 7 else None, [float(c) for c in v], None if i % 3 == 0 else int(i % 4)) for i, v in enumerate(x)]
    rows += [r for r in rows[100:140]]
    odd = [(9000, None, 1), (9001, [], 1), (9002, [float("nan")] * 16, 1), (9003, [float("inf")] * 16, None), (9004, [None] * 16, 2)]
    monkeypatch.setattr(codes, "BLOCK", block)
    monkeypatch.setattr(codes, "LEAF", leaf)
    assert got(codes.compress(table(spark, rows + odd))) == plain(rows)


def test_few_rows_other_lengths_and_empty_table(spark):
    short = [(i, [float(i), 1.5], 0) for i in range(5)]  # filled up to 8 parts of one component
    rows = [(i, [float(i * j % 5) for j in range(16)], 0) for i in range(3)]
    out = got(codes.compress(table(spark, rows + short)))
    want = plain(rows) + plain([(k, v + [0.0] * 6, label) for k, v, label in short])
    both = sum({(r[3], r[4]): r[3] for r in want}.values())
    assert out == sorted(((k, c, e, both, h) for k, c, e, _, h in want), key=str)
    assert codes.compress(table(spark, [])).collect() == []


def test_trees_hold_every_point_once_and_prune():
    rng = np.random.default_rng(4)
    q = (rng.standard_normal((20, 6))[rng.integers(0, 20, 3000)] * 9000 + rng.standard_normal((3000, 6)) * 200).astype(np.int64)
    tree = codes.Tree.load(codes.Tree.build(q).dump(), 6)
    assert sorted(tree.order) == list(range(3000))
    for n in range(len(tree.start)):
        own = q[tree.order[tree.start[n]:tree.end[n]]]
        assert (tree.sums[n] == own.sum(axis=0)).all()
        assert (np.sqrt(((own - tree.centre[n]) ** 2).sum(axis=1)) <= tree.radius[n] * (1 + 1e-9) + 1e-6).all()
        if tree.left[n] >= 0:
            assert (tree.start[tree.left[n]], tree.end[tree.left[n]], tree.end[tree.right[n]]) == (tree.start[n], tree.start[tree.right[n]], tree.end[n])
    book = q[rng.integers(0, 3000, 16)]
    exact = ((q[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (tree.nearest(q, book) == exact).all()
    nodes, _, points, _ = tree.descend(q, book)
    assert len(points) < 1500 and (tree.end - tree.start)[nodes].sum() + len(points) == 3000
    sums, n = tree.totals(q, book)
    assert (n == np.bincount(exact, minlength=16)).all() and (sums[exact[0]] == q[exact == exact[0]].sum(axis=0)).all()
