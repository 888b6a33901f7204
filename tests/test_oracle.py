"""A representative set of registered queries against their DuckDB oracles.

The full sweep (every key) is ``python scripts/check_oracle.py``.
"""

import math
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from bundles.fixtures import TABLES
from bundles.plans.registry import load_all

from conftest import ROOT, SF_MID

KEYS = [
    "prj_rename_origin", "prj_price", "flt_threshold_users", "flt_top_n_keys", "jn_key_overlap",
    "txt_smart_clean", "arr_parse_py", "img_main", "agg_describe", "agg_cat_summary", "agg_histogram",
    "win_cumulative_cut", "win_head_per_group", "smp_exact", "set_dedupe_key", "job_pack", "job_transactions",
    "job_freq_itemsets", "job_rules", "job_similarity_edges", "rec_similarity", "rec_cascade_item",
    "ml_split", "ml_metrics", "ml_mf_offsets", "ml_topk_factors", "jn_cat_match", "job_features_b", "src_jsonl", "snk_split", "run_stages",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_MID}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    return v


def _rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_MID)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    d_cols, d_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)


def test_every_query_has_a_builder_and_most_an_oracle():
    q, o = load_all()
    assert set(o) <= set(q)
    assert set(q) - set(o) == {"ml_mf", "ml_wmf", "ml_ease", "ml_bpr", "ml_topk", "ml_search"}
    assert set(q) <= set(E.queries()) and set(o) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_without_a_library_of_the_removable_part():
    """The other queries stay when a library that only the training-data operators need is missing."""
    code = "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as E; print(len(E.queries()), sum(k.startswith('op') for k in E.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert out == [str(len(load_all()[0])), "0"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["basket_id", "item_id", "rank", "score", "price", "title", "category", "image_url"]
