"""Same answers under different partitioning; restartable ingestion; reader edge lines."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as E
from bundles.session import scratch_path
from bundles.sources import readers as RD
from bundles.sources import writers as W
from bundles.streaming.incremental import ingest_folder, quarantine_counts, read_sink, write_batch

from conftest import SF_SMALL


@pytest.mark.parametrize("key", ["win_cumulative_cut", "job_pack", "rec_similarity", "smp_exact",
                                 "set_dedupe_key", "job_rules"])
def test_partition_invariance(spark, key):
    q = E.queries()[key]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = sorted(map(tuple, q(spark, SF_SMALL).collect()))
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        b = sorted(map(tuple, q(spark, SF_SMALL).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b and len(a) > 0


def test_incremental_ingest_resumes(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    src, sink, ck = scratch_path(spark, "in"), scratch_path(spark, "out"), scratch_path(spark, "ck")
    spark.range(0, 300).select("id", F.col("id").cast("string").alias("v")).repartition(3).write.json(src + "/a")
    first = ingest_folder(spark, src + "/*", schema, sink, ck, files_per_batch=2)
    assert read_sink(spark, sink).count() == 300 and first["batches"] >= 2
    spark.range(300, 500).select("id", F.col("id").cast("string").alias("v")).repartition(2).write.json(src + "/b")
    ingest_folder(spark, src + "/*", schema, sink, ck, files_per_batch=2)
    ids = [r.id for r in read_sink(spark, sink).collect()]
    assert sorted(ids) == list(range(500))  # every row exactly once after the restart


def test_jsonl_rejects_and_types(spark):
    path = scratch_path(spark, "lines")
    lines = ['{"rating": 5, "user_id": "u1", "price": "$3"}', "", "not json",
             '{"rating": "five", "user_id": 7, "helpful_vote": 2}', '{"user_id": "u3"']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    schema = T.StructType([T.StructField("rating", T.DoubleType()), T.StructField("user_id", T.StringType()),
                           T.StructField("helpful_vote", T.LongType()), T.StructField("price", T.StringType())])
    rows = sorted(RD.read_jsonl(spark, path, schema).collect(), key=lambda r: r.user_id)
    assert [(r.rating, r.user_id, r.helpful_vote, r.price) for r in rows] == [(None, "7", 2, None),
                                                                              (5.0, "u1", None, None)]
    assert RD.read_rejects(spark, path).count() == 3


def test_compact_and_split(spark):
    src = scratch_path(spark, "chunks")
    W.write_chunked(spark.range(0, 1000).repartition(4), src, chunk_rows=300)
    assert len(W.list_data_files(spark, src)) >= 4
    res = W.compact(spark, f"{src}/*.parquet", scratch_path(spark, "merged"), files=2)
    assert res["input_rows"] == res["output_rows"] == 1000 and res["output_files"] <= 2
    out = W.split_positional(spark.range(0, 1000), scratch_path(spark, "split"), ["id"], part_rows=400)
    parts = {r.part_id: r["count"] for r in out.groupBy("part_id").count().collect()}
    assert parts == {0: 400, 1: 400, 2: 200}
    assert sorted(r.id for r in out.where("part_id = 2").collect()) == list(range(800, 1000))


def test_jsonl_takes_what_json_loads_takes(spark):
    """One object a line, repeated keys and NaN included; lists, numbers, two objects and anything after an object are rejected."""
    good = ['{"rating": NaN, "user_id": "nan"}', '{"rating": 1, "rating": 2, "user_id": "twice"}', '{"helpful_vote": 3.0, "user_id": "whole"}',
            '{"helpful_vote": 3.5, "user_id": "half"}', '{"rating": -Infinity, "user_id": "inf"}', ' {"user_id": "space"}\t', '{"user_id": "{[\\"]}"}', '{}']
    bad = ["[1]", '[{"user_id": "x"}]', "1", '"x"', "null", '{"user_id": "x"} y', '{"user_id": "x"}{"user_id": "y"}', '{"user_id": "x"},{"user_id": "y"}',
           "{'user_id': 'x'}", '{"rating": 01}', '{"user_id": "x",}', "   ", "]", '{"user_id": "x"}]', "{},[", '{"user_id": "x"}]}', '{"user_id": "x"}]} "after it": "end"}', "{}, []"]
    path = scratch_path(spark, "edge-lines")
    spark.createDataFrame([(x,) for x in good + bad], "value string").coalesce(1).write.text(path)
    schema = T.StructType([T.StructField("rating", T.DoubleType()), T.StructField("user_id", T.StringType()), T.StructField("helpful_vote", T.LongType())])
    rows = {r.user_id: r for r in RD.read_jsonl(spark, path, schema).collect()}
    assert set(rows) == {"nan", "twice", "whole", "half", "inf", "space", '{["]}', None}
    assert rows["nan"].rating is None and rows["twice"].rating == 2.0 and rows["inf"].rating == float("-inf")
    assert rows["whole"].helpful_vote == 3 and rows["half"].helpful_vote is None
    assert sorted(r.value for r in RD.read_rejects(spark, path).collect()) == sorted(bad)
    assert [tuple(r)[1:] for r in RD.reject_counts(spark, path).collect()] == [(len(good + bad), len(bad))]


def test_ingest_quarantine_and_replay(spark):
    """Broken lines are counted per file; a batch that is written again adds nothing."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.StringType())])
    src, sink, ck = scratch_path(spark, "in"), scratch_path(spark, "out"), scratch_path(spark, "ck")
    for n, bad in ((0, 3), (1, 0), (2, 5)):
        lines = [f'{{"id": {i}, "ts": "2024-01-0{n + 1}"}}' for i in range(40 * n, 40 * n + 40)] + ['{"id": '] * bad
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{src}/f{n}")
    ingest_folder(spark, src + "/*", schema, sink, ck, files_per_batch=1)
    want = sorted((i, f"2024-01-0{i // 40 + 1}") for i in range(120))
    assert sorted(map(tuple, read_sink(spark, sink).collect())) == want
    assert sorted(r.n_rejected for r in quarantine_counts(spark, sink).collect()) == [3, 5]
    lines = spark.read.text(f"{src}/f2").select("value", F.lit("f2").alias("file_path"))
    batch = spark.read.parquet(f"{sink}/data").where("id = 100").first()["batch"]
    write_batch(lines, batch, schema, sink)  # as after a failure between the write and the commit
    assert sorted(map(tuple, read_sink(spark, sink).collect())) == want
    assert sorted(r.n_rejected for r in quarantine_counts(spark, sink).collect()) == [3, 5]


def test_latest_file_is_found_without_reading(spark, tmp_path):
    for v in range(3):
        spark.range(v, v + 1).coalesce(1).write.parquet(f"{tmp_path}/v{v}")
    files = sorted(tmp_path.glob("v*/*.parquet"))
    for i, f in enumerate(files):
        os.utime(f, (1000 + (5 if i == 1 else i),) * 2)
    assert RD.read_latest(spark, f"{tmp_path}/v*/*.parquet").first().id == 1
    with pytest.raises(FileNotFoundError):
        RD.read_latest(spark, f"{tmp_path}/none*/*.parquet")


def test_review_lines_grow_in_files_not_in_size(spark, monkeypatch):
    """The number of gzip files, each one read task, follows the number of lines; no file holds more than its limit."""
    from bundles.plans import q_io

    monkeypatch.setattr(q_io, "FILE_LINES", 700)
    path = q_io.write_review_lines(spark, SF_SMALL)
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    sizes = [r["count"] for r in RD.reject_counts(spark, path).select(F.col("n_lines").alias("count")).collect()]
    assert sum(sizes) == n and len(sizes) >= n / 700 and max(sizes) <= 700


def test_short_prefix_needs_no_index(spark, monkeypatch):
    """A short prefix is read off the rows; a long one comes from the index, and both are the same rows."""
    from bundles.operators import select

    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 3).alias("g")).repartition(6)
    asked, index = [], select.global_index
    monkeypatch.setattr(select, "global_index", lambda *a, **k: asked.append(1) or index(*a, **k))
    short = sorted(map(tuple, RD.first_rows(df, 40, ["g", "k"]).collect()))
    assert not asked
    monkeypatch.setattr(RD, "PREFIX_ROWS", 10)
    assert sorted(map(tuple, RD.first_rows(df, 40, ["g", "k"]).collect())) == short and asked
