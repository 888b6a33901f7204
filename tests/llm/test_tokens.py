"""Operators 1 and 2 against the tokenizer libraries and packing invariants."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bundles.llm import bpe, packing, queries

SF = "/root/testdata/sf0.001"
RANKS = P.path("byte_bpe_50k.tiktoken")
EDGE = [(1, None), (2, ""), (3, " "), (4, "  two  spaces \n\n here "), (5, "x" * 50_000), (6, "a b" * 20_000),
        (11, "a <|endoftext|> b"), (12, "word <|endoftext|><|endoftext|>x <|endoftext"), (7, "<|endoftext|> don't naïve 汉字 🙂 12345 \x1c\x85 z"), (8, "dup text"), (8, "dup text"), (None, "no key"),
        (9, "aaaaaaaaab" * 3000), (10, "tail \n")]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def hf():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


@given(st.text(min_size=1, max_size=60))
@settings(max_examples=300, deadline=None)
def test_parts_and_words_match_tiktoken(text):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))} if not hasattr(test_parts_and_words_match_tiktoken, "enc") else None
    if ranks:
        test_parts_and_words_match_tiktoken.enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = np.frombuffer(bpe._coder(RANKS, P.PATTERN)[1].encode([text])[0], dtype="<u4").tolist()
    assert got == test_parts_and_words_match_tiktoken.enc.encode_ordinary(text)


def test_random_bytes_follow_the_merges():
    b, rng = bpe.BacktrackingBpe(RANKS), random.Random(1)
    for alphabet in (b"ab", b"the ", bytes(range(97, 123)), bytes(range(256))):
        for _ in range(60):
            piece = bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))
            assert b.encode(piece) == b.merged(piece)


def test_op1_round_trip(spark, reference):
    rows = queries.QUERIES["op1_byte_bpe"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r.doc_id] or ""
        ids = reference.encode_ordinary(t)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_bpe_edges(spark, reference):
    df = spark.createDataFrame([(k, t, "x") for k, t in EDGE], "doc_id long, text string, ids string")
    got = bpe.decode_bpe(bpe.encode_bpe(df, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert len(got) == len(EDGE)
    for r in got:
        assert r.ids == reference.encode_ordinary(r.text or "") and bytes(r.decoded).decode() == (r.text or "")
    assert bpe.encode_bpe(df.limit(0), RANKS, P.PATTERN).count() == 0


def check_packing(rows, docs, hf):
    want = {}
    for k, t in docs:
        want.setdefault(k, []).append(hf.encode(t or "", add_special_tokens=False).ids + [1])
    used, by_doc = {}, {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    for k, lists in want.items():
        have = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by_doc[k])
        cut = sorted((s, len(i[s:s + 2048]), zlib.crc32(np.array(i[s:s + 2048], "<u4").tobytes()), len(i))
                     for i in lists for s in range(0, len(i), 2048))
        assert have == cut
    total = sum(r.length for r in rows)
    return total, len(used)


def test_op2_packs_every_id_once(spark, hf):
    rows = queries.QUERIES["op2_packing"](spark, SF).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    total, sequences = check_packing(rows, docs, hf)
    assert total / (sequences * 2048) > 0.97


def test_op2_edges(spark, hf, tmp_path):
    spark.createDataFrame([(k, t, 0) for k, t in EDGE], "doc_id long, text string, sequence_id int").write.parquet(f"{tmp_path}/documents.parquet")
    check_packing(queries.QUERIES["op2_packing"](spark, str(tmp_path)).collect(), EDGE, hf)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert queries.QUERIES["op2_packing"](spark, f"{tmp_path}/none").count() == 0


@given(st.lists(st.integers(1, 64), min_size=1, max_size=80))
@settings(max_examples=100, deadline=None)
def test_first_fit_decreasing_is_first_fit(lengths):
    bins, offsets = packing.first_fit_decreasing(np.array(lengths), 64)
    free = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = next((b for b, f in enumerate(free) if f >= lengths[i]), len(free))
        if at == len(free):
            free.append(64)
        assert (bins[i], offsets[i]) == (at, 64 - free[at])
        free[at] -= lengths[i]


def test_first_fit_keeps_no_tokenizer(spark, monkeypatch):
    """A worker hands the tokenizer and its table of parts back before it deals pieces to sequences."""
    import pandas as pd
    from bundles.llm import common, packing

    pieces, dealt = spark.createDataFrame([(0, 5), (1, 2048)], "piece_row long, length long"), []
    kind = type(pieces.groupBy("length"))
    deal = kind.applyInPandas
    monkeypatch.setattr(kind, "applyInPandas", lambda self, fn, schema: (dealt.append(fn), deal(self, fn, schema))[1])
    assert packing.pack(pieces, 1).count() == 2
    common.kept("packing", "table", dict)
    out = dealt[0](pd.DataFrame({"piece_row": [0, 3], "length": [5, 7], "pack_group": [0, 0]}))
    assert out["offset"].tolist() == [7, 0] and not common._kept
