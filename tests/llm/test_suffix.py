"""Operator 6 against brute force over all windows."""

import hashlib
import random
from collections import Counter

import numpy as np

from bundles.llm import queries, suffix

SF = "/root/testdata/sf0.001"


def brute(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (k, _), d in zip(rows, data):
        mask = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                mask[i:i + length] = b"\1" * length
        kept = bytes(x for x, m in zip(d, mask) if not m)
        spans = sum(m and (i == 0 or not mask[i - 1]) for i, m in enumerate(mask))
        out.append((k, len(d), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def planted(rng):
    word = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, other = text(90), text(50)
    rows = [(i, text(rng.randint(0, 120))) for i in range(60)]
    rows += [(100 + i, text(rng.randint(0, 30)) + passage[rng.randint(0, 60):rng.randint(250, 400)] + text(rng.randint(0, 30))) for i in range(40)]
    rows += [(200 + i, other + passage + other[:i * 9]) for i in range(12)]
    copy = rows[5][1] + passage + text(100)
    rows += [(300, copy), (301, copy), (302, copy[:150] + "X" + copy[151:]), (303, copy[7:])]
    rows += [(400, None), (401, ""), (402, "a" * 700), (403, "a" * 199), (404, "ab" * 300), (405, "xyz" * 90), (406, "a" * 200 + "b"), (407, "é" * 150)]
    return rows + [(300, copy), (None, copy + "z"), (None, None), (1, rows[1][1])]


def test_op6_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(queries.QUERIES["op6_suffix_dedup"](spark, SF)) == brute(rows, 200)


def test_op6_planted(spark, tmp_path, monkeypatch):
    rows = planted(random.Random(6))
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, kept int").write.parquet(f"{tmp_path}/documents.parquet")
    want = brute(rows, 200)
    assert got(queries.QUERIES["op6_suffix_dedup"](spark, str(tmp_path))) == want
    monkeypatch.setattr(suffix, "TOGETHER", 2)  # the windows of most seeds are counted in Spark
    assert got(queries.QUERIES["op6_suffix_dedup"](spark, str(tmp_path))) == want
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert queries.QUERIES["op6_suffix_dedup"](spark, f"{tmp_path}/none").count() == 0


def test_runs_cover_all_windows_and_ties_go_first():
    rng = np.random.default_rng(1)
    for data in (rng.integers(97, 99, 900, dtype=np.uint8), np.full(500, 97, np.uint8), np.frombuffer(b"ab" * 300, np.uint8)):
        place, first, last, seed = suffix.runs(data, 200)
        assert first[0] == 0 and last[-1] == len(data) - 200 and (first[1:] == last[:-1] + 1).all()
        for p, a, b in zip(place, first, last):
            for i in (a, b):
                assert i + int(np.argmin(seed[i:i + 200 - suffix.SEED + 1])) == p


def test_stretches_do_not_change_the_result(monkeypatch):
    monkeypatch.setattr(suffix, "STRETCH", 300)
    data = bytes(np.random.default_rng(2).integers(97, 100, 2500, dtype=np.uint8))
    made = list(suffix._all_runs(data, 200))
    first, last = np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])
    assert first[0] == 0 and last[-1] == len(data) - 200 and (first[1:] == last[:-1] + 1).all()
