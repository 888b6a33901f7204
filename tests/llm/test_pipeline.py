"""The pipeline's stages, each against brute force on its own input."""

import re
import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from .test_jaccard import brute as brute_jaccard  # noqa: E402
from .test_secrets import brute as brute_secrets  # noqa: E402
from .test_suffix import planted  # noqa: E402

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.schema == docs.schema, name
        after = {r.doc_id: r for r in out.collect()}
        if name == "language":
            assert len(after) >= 0.97 * len(before) and all(after[k] == before[k] for k in after)
        elif name == "near_duplicates":
            want = {k for k, _, c in brute_jaccard([(k, r.text) for k, r in before.items()], 5, 80) if k == c}
            assert set(after) == want
        elif name == "repeats":
            data = [r.text.encode() for r in before.values()]
            seen = {}
            for d in data:
                for i in range(len(d) - 199):
                    seen[d[i:i + 200]] = seen.get(d[i:i + 200], 0) + 1
            for k, r in before.items():
                d = r.text.encode()
                cover = {i + j for i in range(len(d) - 199) if seen[d[i:i + 200]] > 1 for j in range(200)}
                assert after[k].text == bytes(b for i, b in enumerate(d) if i not in cover).decode(errors="ignore") and after[k].n_chars == len(after[k].text)
        else:
            assert set(after) == set(before)
            for k, r in before.items():
                assert (after[k].text == r.text) == (brute_secrets(r.text)[1] == "")
                assert not re.search(r"[0-9a-f]{32,}|AKIA[A-Z0-9]{12}", after[k].text)
        docs = spark.createDataFrame(out.collect(), docs.schema)


def test_run_packs_what_is_left_and_edges(spark, tmp_path):
    rows = [(k, t, random.Random(k).choice(["en", "de", None]), "s", None, "x") for k, t in planted(random.Random(2))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids string").write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert out and all(len(r.ids) == 4 * r.length for r in out)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_repeats_cut_whole_characters_only(spark):
    passage = "".join(random.Random(9).choice("abcdefgh ") for _ in range(300))
    other = "".join(random.Random(10).choice("ijklmnop ") for _ in range(300))
    texts = {  # ä and ö share the first byte, € and ₭ the first two, ä and Ĥ the second
        1: f"one \ufffd {passage}ä end", 2: f"two {passage}ö \ufffd end",
        3: f"€{other}🙂3", 4: f"₭{other}🙃4", 5: f"five ä{other}", 6: f"six Ĥ{other}",
        7: f"only \ufffd äö", 8: None,
        9: f"{passage}€{other} 9", 10: f"{passage}₭ and {other}",
    }
    rows = [(k, t, "de", "s", None) for k, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.repeat_stage(spark, docs, SF).collect()}
    want = {k: brute_cut(k, texts) for k in texts}
    assert {k: t for k, (t, _) in got.items()} == want
    assert want[1] == "one \ufffd end" and want[2] == "two \ufffd end" and want[3] == "3" and want[9] == " 9" and want[10] == " and "
    assert all(n == (len(t) if t != texts[k] else None) for k, (t, n) in got.items())


def brute_cut(key, texts):
    """Characters of which no byte lies in a 200-byte string that also starts elsewhere."""
    seen = {}
    for t in texts.values():
        d = (t or "").encode()
        for i in range(len(d) - 199):
            seen[d[i:i + 200]] = seen.get(d[i:i + 200], 0) + 1
    if texts[key] is None:
        return None
    d, out, at = texts[key].encode(), [], 0
    cover = {i + j for i in range(len(d) - 199) if seen[d[i:i + 200]] > 1 for j in range(200)}
    for ch in texts[key]:
        n = len(ch.encode())
        out += [] if cover & set(range(at, at + n)) else [ch]
        at += n
    return "".join(out)
