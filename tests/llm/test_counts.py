"""Operator 13 against the library itself."""

import json
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bundles.llm import counts, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.01"
PLANTED = ["", None, " ", "a", "x'sy''s 'sam I'LL  DON'T 're", "<|endoftext|>", "a <|endoftext|><|startoftext|> <|ENDOFTEXT|> <|endoftext", "a" * 5000, "ab" * 3000,
           "=" * 1000, "日本" * 2000, "1234567890" * 50, "ΣΑΣ ΌΔΟΣ İstanbul ǅ ①² Å é ﬁ ͸ ​　", "😀\U0001F468‍\U0001F469", "Straße\r\n\tÜber", "</w>a</w>"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return counts.Counter(PATH)


def told(library, texts):
    return [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_op13_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {(d.doc_id, len((d.text or "").encode()), n, n > 2048) for d, n in zip(docs, told(library, [d.text for d in docs]))}
    out = queries.QUERIES["op13_token_counts"](spark, SF)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert {tuple(r) for r in out.collect()} == want


def test_planted_texts_clashing_columns_and_empty_table(spark, library):
    rows = [(i, t, 7, "kept") for i, t in enumerate(PLANTED)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, `text to count` string")
    out = counts.count_tokens(df.drop("text to count"), PATH).collect()
    want = dict(enumerate(told(library, PLANTED)))
    assert len(out) == len(rows) and all(r.n_tokens == want[r.doc_id] for r in out)
    assert counts.count_tokens(df.limit(0), PATH, keep=["doc_id"]).collect() == []


@given(st.text(st.one_of(st.sampled_from(list("abcdesrtvlm '’.,!019\n\tßÄéΣσς日語한́ _-<|>")), st.characters(exclude_categories=["Cs"])), max_size=80))
@settings(max_examples=400, deadline=None)
def test_any_text(library, counter, text):
    assert counter.count([text]) == told(library, [text])


def test_long_texts_are_cut_without_a_change(library, counter):
    rng = random.Random(3)
    words = ["the", "don't", "Überraschung", "12", "...", "<|endoftext|>", "qzxv" * 90, "été", "\n"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(400))) for _ in range(40)]
    want = told(library, texts)
    for size in (1, 50, 1000):
        assert counter.count(texts, batch_chars=size) == want


def test_chunks_compose_to_the_whole(counter):
    """Any chunk length gives the counts of one sequential walk, also where a word spans many chunks."""
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("aeinrstzq", k=rng.choice([1, 3, 8, 700]))) for _ in range(60))
    symbols, _ = counter.symbols.read(text)
    state, want = 0, []
    for s in symbols.tolist():
        state, n = counter.machine.step(state, s)
        want.append(n)
    for chunk in (1, 2, 7, 64, 5000):
        assert counter.machine.counts(symbols, chunk).tolist() == want


def test_annotations_follow_the_merges(counter):
    """After every byte the counts so far are those of the merges' own result for the prefix."""
    machine, rng = counter.machine, random.Random(8)
    for _ in range(200):
        word = [rng.choice(b"abcdehilnorstuz") for _ in range(rng.randrange(1, 20))]
        state, total = 0, 0
        for i, s in enumerate(word):
            assert machine.step(state, 256 + s)[1] + total == len(machine.merges.merged((*word[:i], 256 + s)))
            state, n = machine.step(state, s)
            total += n
            assert total == len(machine.merges.merged(tuple(word[:i + 1])))


def test_full_tables_are_dropped(library, counter):
    small = counts.Counter.__new__(counts.Counter)
    small.symbols, small.machine = counter.symbols, counts.Transducer(counts.Merges(json.load(open(PATH))["model"]), max_transitions=50)
    texts = ["some words of a text that fills the table", "others come later", "and others again, 'til it is full"] * 3
    assert [n for t in texts for n in small.count([t])] == told(library, texts)
    assert small.machine.used < 200 and np.count_nonzero(small.machine.keys >= 0) == small.machine.used
