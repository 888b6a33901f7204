"""Operators 4 and 5 against brute force over all pairs."""

from collections import defaultdict

import numpy as np

from bundles.llm import hnsw, queries, vectors

SF = "/root/testdata/sf0.01"
ODD = [(9000, None), (9001, []), (9002, [0.0] * 64), (9003, [float("nan")] + [1.0] * 63), (9004, [float("inf")] * 64), (9005, [None] + [1.0] * 63),
       (None, [1.0] * 64), (9006, [1.0] * 64), (9007, [2.0] * 64), (9007, [2.0] * 64), (9008, [1.0, 2.0]), (9009, [2.0, 4.0]), (9020, [1.0] * 64), (9040, [-1.0])]


def usable(k, v):
    return k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute_links(rows, cosine):
    ok = [i for i, (k, v) in enumerate(rows) if usable(k, v)]
    unit = {i: np.array(rows[i][1], np.float64) / np.linalg.norm(np.array(rows[i][1], np.float64)) for i in ok}
    near = defaultdict(set)
    for a in ok:
        for b in ok:
            if a != b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                near[a].add(b)
    out = []
    for i, (k, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        c = None if k is None else min(rows[j][0] for j in seen)
        out.append((k, len(near[i]), c, k is not None and k == c))
    return sorted(out, key=str)


def clusters(n, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 64))
    for i in range(n // 2, n):  # chains and stars of near copies around the threshold
        base = x[rng.integers(0, i) if i % 3 else rng.integers(0, 5)]
        x[i] = base + rng.standard_normal(64) * rng.choice([0.0, 0.1, 0.25, 0.32, 0.36])
    return (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_op4_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got(queries.QUERIES["op4_vector_near_dups"](spark, SF)) == brute_links(rows, 0.95)


def test_op4_edges_and_chunks(spark, tmp_path, monkeypatch):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(clusters(400))] + ODD
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, n_links int")
    want = brute_links(rows, 0.95)
    assert got(vectors.near_duplicates(df)) == want
    monkeypatch.setattr(vectors, "CHUNK", 60)
    assert got(vectors.near_duplicates(df, dims=8)) == want
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def brute_nearest(rows, k):
    ok = [(i, a, np.array(v, np.float64)) for i, (a, v) in enumerate(rows) if usable(a, v)]
    out = defaultdict(list)
    for i, a, v in ok:
        if a % 20 == 0:
            hits = sorted((-float((v * w).sum()), b) for j, b, w in ok if j != i and len(w) == len(v))[:k]
            out[a].append([(b, -s) for s, b in hits])
    return out


def recall(rows, want):
    by = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["rank"]):
        by[r.query_id].append((r.vec_id, r.score))
    hit = sum(len({b for b, _ in by[q]} & {b for b, _ in lists[0]}) for q, lists in want.items())
    return hit / sum(len(lists[0]) for lists in want.values())


def test_op5_whole_table_is_exact_when_shards_are_small(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert recall(queries.QUERIES["op5_hnsw"](spark, SF).collect(), brute_nearest(rows, 20)) > 0.95


def test_op5_edges(spark):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(clusters(100))] + ODD + [(500 + i, [0.5] * 64) for i in range(60)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    from pyspark.sql import functions as F
    out = hnsw.nearest(df, F.col("vec_id") % 20 == 0, k=20, shard_rows=50).collect()
    want = brute_nearest(rows, 20)
    assert {r.query_id for r in out} == {q for q, lists in want.items() if lists[0]}
    for q, lists in want.items():
        mine = sorted((r["rank"], r.vec_id, r.score) for r in out if r.query_id == q)
        assert [m[1] for m in mine] == [b for b, _ in lists[0]], q
        assert np.allclose([m[2] for m in mine], [s for _, s in lists[0]], rtol=1e-12) and [m[0] for m in mine] == list(range(1, len(mine) + 1))
    assert hnsw.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_graph_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    x = np.array([r.embedding for r in rows], np.float32)
    scaled = x * np.random.default_rng(9).uniform(0.8, 1.2, (len(x), 1)).astype(np.float32)
    for data in (x, scaled):
        g, hits = hnsw.build_graph(data), 0
        for q in x[:100]:
            s = data @ q
            found = hnsw.search(g, data, q)
            hits += len(set(found[np.argsort(-s[found])[:20]].tolist()) & set(np.argsort(-s)[:20].tolist()))
        assert hits / 2000 > 0.95


def test_op4_shuffles_no_vectors_for_pairs(spark, monkeypatch):
    """Vectors of several chunks meet without an exchange, so disk does not grow with the pairs."""
    plans, write = [], vectors.Scratch.write
    monkeypatch.setattr(vectors.Scratch, "write", lambda self, df, name: (plans.append((name, df._jdf.queryExecution().toString())), write(self, df, name))[1])
    monkeypatch.setattr(vectors, "CHUNK", 70)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(clusters(300, seed=8))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert got(vectors.near_duplicates(df)) == brute_links(rows, 0.95)
    linked = [plan for name, plan in plans if name == "linked"]
    assert len(linked) > 3 and not any("Exchange" in plan for plan in linked)


def test_op4_signed_zeros_and_low_thresholds(spark):
    """Vectors that differ in the sign of a zero are equal; where most pairs pass the first product, the second tells."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.standard_normal((60, 20)))]
    rows += [(100, [0.0, 1.0] + [0.0] * 18), (101, [-0.0, 1.0] + [0.0] * 18)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for cosine in (0.2, 0.95):
        assert got(vectors.near_duplicates(df, cosine=cosine, dims=4)) == brute_links(rows, cosine)
