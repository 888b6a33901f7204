"""Queries: sources, sinks, incremental streaming ingestion and staged runs.

Inputs of the readers are written first from the driver tables into a fresh
folder under the shared checkpoint directory (JSON lines with some broken
and blank lines, chunks, CSV, versions), then read back by the operator.
"""

from __future__ import annotations

import math
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixtures as fx
from ..operators import select as S
from ..session import scratch_path
from ..sources import readers as RD
from ..sources import writers as W
from ..streaming.incremental import ingest_folder, read_sink
from .registry import query
from .stages import Stage, StageRunner

JSON_COLS = ["rating", "title", "asin", "parent_asin", "user_id", "timestamp", "helpful_vote", "verified_purchase"]
REVIEW_SCHEMA_EXT = T.StructType(RD.REVIEW_SCHEMA.fields + [T.StructField("order_id", T.LongType()),
                                                              T.StructField("line_no", T.IntegerType())])

SQL_VALID = "select * from raw_reviews where not (order_id % 50 = 0 or (order_id % 50 = 1 and line_no = 1))"


#: Lines of a gzip file on average and at most (a file is one read task), and the fewest files.
FILE_LINES, FEWEST_FILES = 250_000, 4


def write_review_lines(spark, sf, files: int | None = None) -> str:
    """Reviews as gzip JSON lines; rows with order_id % 50 = 0 are cut in half
    (syntax error) and the first line of orders with order_id % 50 = 1 is blank.
    As many files as the rows of ``lineitem`` need, if not told otherwise."""
    files = files or max(FEWEST_FILES, math.ceil(fx.table(spark, sf, "lineitem").count() / FILE_LINES))
    r = fx.raw_reviews(spark, sf)
    line = F.to_json(F.struct(*JSON_COLS, "order_id", "line_no"))
    k = F.col("order_id") % 50
    text = (F.when(k == 0, F.substring(line, 1, 25)).when((k == 1) & (F.col("line_no") == 1), F.lit(""))
            .otherwise(line))
    path = scratch_path(spark, "reviews-jsonl")
    (r.select(text.alias("value")).repartition(files).write.option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_LINES).text(path))
    return path


def _valid_cols(df):
    return df.select(*JSON_COLS, "order_id", "line_no")


@query("src_jsonl", f"select {', '.join(JSON_COLS)}, order_id, line_no from ({SQL_VALID})")
def src_jsonl(spark, sf):
    path = write_review_lines(spark, sf)
    return _valid_cols(RD.read_jsonl(spark, path, REVIEW_SCHEMA_EXT))


@query("src_rejects", """
select count(*) as n_lines, count(*) filter (where order_id % 50 = 0 or (order_id % 50 = 1 and line_no = 1)) as n_rejected
from raw_reviews""")
def src_rejects(spark, sf):
    path = write_review_lines(spark, sf)
    c = RD.reject_counts(spark, path)
    return c.agg(F.sum("n_lines").alias("n_lines"), F.sum("n_rejected").alias("n_rejected"))


@query("src_limit", f"select {', '.join(JSON_COLS)}, order_id, line_no from ({SQL_VALID}) "
                    "order by order_id, line_no, parent_asin limit 5000")
def src_limit(spark, sf):
    path = write_review_lines(spark, sf)
    valid = _valid_cols(RD.read_jsonl(spark, path, REVIEW_SCHEMA_EXT))
    return RD.first_rows(valid, 5000, ["order_id", "line_no", "parent_asin"])


@query("src_chunks", f"select {', '.join(JSON_COLS)}, order_id, line_no from ({SQL_VALID})")
def src_chunks(spark, sf):
    """JSON lines -> 7,000-row parquet chunks -> the chunk folder read as one table."""
    path = write_review_lines(spark, sf)
    chunks = scratch_path(spark, "chunks")
    W.write_chunked(_valid_cols(RD.read_jsonl(spark, path, REVIEW_SCHEMA_EXT)), chunks, chunk_rows=7000)
    return RD.read_chunks(spark, chunks)


@query("src_parquet", """
select l_orderkey, l_partkey, l_linenumber, l_quantity, l_returnflag, strftime(l_shipdate, '%Y-%m-%d') as ship_date
from lineitem""", fx=False)
def src_parquet(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag",
                     F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"))


@query("src_parquet_proj", " union all ".join(
    f"select '{t}' as table_name, count(*) as n_rows from {t}" for t in fx.TABLES), fx=False)
def src_parquet_proj(spark, sf):
    return RD.row_counts(spark, {t: f"{sf.rstrip('/')}/{t}.parquet" for t in fx.TABLES})


COLLECTION_CSV_SCHEMA = "collection_id long, item_id string, rating int"


@query("src_csv", "select collection_id, item_id, rating from fx_collections")
def src_csv(spark, sf):
    path = scratch_path(spark, "collections-csv")
    W.write_csv(fx.collections(spark, sf).select("collection_id", "item_id", "rating"), path)
    missing = RD.read_csv(spark, path + "-absent", COLLECTION_CSV_SCHEMA, optional=True)
    assert missing is None
    return RD.read_csv(spark, path, COLLECTION_CSV_SCHEMA)


@query("src_latest", "select * from fx_products where parent_asin % 3 = 2")
def src_latest(spark, sf):
    base = scratch_path(spark, "versions")
    p = fx.products(spark, sf)
    for v in range(3):
        W.write_parquet(p.where(F.col("parent_asin") % 3 == v).coalesce(1), f"{base}/v{v}")
        time.sleep(1.1)
    return RD.read_latest(spark, f"{base}/v*/*.parquet")


EVENT_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.StringType()),
                             T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                             T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def _ingested(spark, sf):
    """Events as JSON lines in several files, every 97th followed by a broken copy of its line, ingested 2 files
    per micro-batch until caught up; run again at once, which finds nothing new."""
    src = scratch_path(spark, "events-in")
    ev = fx.table(spark, sf, "events").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    line = F.to_json(F.struct(*[f.name for f in EVENT_SCHEMA.fields]))
    broken = F.when(F.col("event_id") % 97 == 0, F.substring(line, 1, 24))
    ev.select(F.explode(F.array_compact(F.array(line, broken))).alias("value")).repartition(5).write.text(src)
    sink, ck = scratch_path(spark, "events-out"), scratch_path(spark, "events-ckpt")
    ingest_folder(spark, src, EVENT_SCHEMA, sink, ck, files_per_batch=2)
    ingest_folder(spark, src, EVENT_SCHEMA, sink, ck, files_per_batch=2)
    return sink


@query("src_incremental", """
select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, user_id, event_type, value, props from events""", fx=False)
def src_incremental(spark, sf):
    return read_sink(spark, _ingested(spark, sf))


@query("src_quarantine", """
select event_id, concat('{"event_id":', event_id, ',"ts":"')[1:16] as start from events where event_id % 97 = 0""", fx=False)
def src_quarantine(spark, sf):
    """The broken lines that the ingestion put aside."""
    put = read_sink(spark, _ingested(spark, sf), "quarantine")
    return put.select(F.regexp_extract("value", r"event_id\":(\d+)", 1).cast("long").alias("event_id"), F.substring("value", 1, 16).alias("start"))


@query("snk_parquet", "select * from fx_products")
def snk_parquet(spark, sf):
    path = scratch_path(spark, "products")
    W.write_parquet(fx.products(spark, sf), path)
    return spark.read.parquet(path)


@query("snk_chunked", "select count(*) as n_rows, cast(0 as bigint) as files_over_limit from fx_reviews")
def snk_chunked(spark, sf):
    path = scratch_path(spark, "chunked")
    W.write_chunked(fx.reviews(spark, sf), path, chunk_rows=7000)
    per_file = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count()
    return per_file.agg(F.sum("count").alias("n_rows"),
                        F.count(F.when(F.col("count") > 7000, 1)).cast("bigint").alias("files_over_limit"))


@query("snk_compact", """
select count(*) as input_rows, count(*) as output_rows, true as files_within_target from fx_reviews""")
def snk_compact(spark, sf):
    src = scratch_path(spark, "compact-in")
    W.write_chunked(fx.reviews(spark, sf).repartition(8), src, chunk_rows=3000)
    res = W.compact(spark, f"{src}/*.parquet", scratch_path(spark, "compact-out"), files=3)
    return spark.createDataFrame([(res["input_rows"], res["output_rows"], res["output_files"] <= 3)],
                                 "input_rows bigint, output_rows bigint, files_within_target boolean")


@query("snk_schema", """
select 'products' as name, cast(9 as bigint) as n_cols, count(*) as n_rows,
       'parent_asin,title,price,cat_1,cat_2,cat_3,cat_4,categories,image_url' as columns from fx_products""")
def snk_schema(spark, sf):
    return W.schema_sidecar(fx.products(spark, sf), scratch_path(spark, "schema"), "products").drop("tree")


@query("snk_csv", "select order_id, line_no, user_id, parent_asin, rating from fx_reviews")
def snk_csv(spark, sf):
    path = scratch_path(spark, "reviews-csv")
    W.write_csv(fx.reviews(spark, sf).select("order_id", "line_no", "user_id", "parent_asin", "rating"), path)
    return RD.read_csv(spark, path, "order_id long, line_no int, user_id long, parent_asin long, rating int")


@query("snk_split", """
select cast(floor((row_number() over (order by order_id, line_no, parent_asin) - 1) / 25000) as int) as part_id,
       order_id, line_no, parent_asin from fx_reviews""")
def snk_split(spark, sf):
    path = scratch_path(spark, "split")
    out = W.split_positional(fx.reviews(spark, sf).select("order_id", "line_no", "parent_asin"), path,
                             ["order_id", "line_no", "parent_asin"], part_rows=25000)
    return out.select("part_id", "order_id", "line_no", "parent_asin")


@query("snk_log", """
, c as (select parent_asin, count(*) as review_count from fx_reviews group by 1)
, s as (select *, sum(review_count) over (order by review_count desc, parent_asin rows unbounded preceding) as cum from c)
, k as (select parent_asin from s where cum - review_count < 30000)
select 'load_reviews' as stage, (select count(*) from fx_reviews) as rows_in, (select count(*) from fx_reviews) as rows_out
union all select 'top_k', (select count(*) from fx_reviews), (select count(*) from k)
union all select 'filter', (select count(*) from fx_reviews), (select count(*) from fx_reviews where parent_asin in (select parent_asin from k))""")
def snk_log(spark, sf):
    log = W.RunLog(spark, scratch_path(spark, "runlog"))
    r = fx.reviews(spark, sf)
    t0 = time.time()
    n = r.count()
    log.append("load_reviews", n, n, time.time() - t0)
    t0 = time.time()
    cut = S.cumulative_cut(r, "parent_asin", 30000)
    log.append("top_k", n, cut.count(), time.time() - t0)
    t0 = time.time()
    kept = r.join(cut.select("parent_asin"), "parent_asin", "left_semi").count()
    log.append("filter", n, kept, time.time() - t0)
    return log.read().select("stage", "rows_in", "rows_out")


def _stages(spark, sf):
    return [
        Stage("load_reviews", lambda: fx.reviews(spark, sf)),
        Stage("top_k", lambda r: S.cumulative_cut(r, "parent_asin", 30000), ["load_reviews"]),
        Stage("filter", lambda r, k: S.exact_sample(r.join(k.select("parent_asin"), "parent_asin", "left_semi"),
                                                    20000, ["order_id", "line_no", "parent_asin"]),
              ["load_reviews", "top_k"]),
        Stage("load_meta", lambda: fx.products(spark, sf)),
        Stage("join", lambda f, m: f.join(m, "parent_asin"), ["filter", "load_meta"]),
        Stage("extra", lambda j: j.limit(1), ["join"]),
        Stage("extra_report", lambda e: e, ["extra"]),
    ]


@query("run_stages", """
, c as (select parent_asin, count(*) as review_count from fx_reviews group by 1)
, s as (select *, sum(review_count) over (order by review_count desc, parent_asin rows unbounded preceding) as cum from c)
, k as (select parent_asin from s where cum - review_count < 30000)
, f as (select least(20000, (select count(*) from fx_reviews where parent_asin in (select parent_asin from k))) as n)
select 'load_reviews' as stage, 'reused' as status, (select count(*) from fx_reviews) as rows
union all select 'top_k', 'ran', (select count(*) from k)
union all select 'filter', 'ran', (select n from f)
union all select 'load_meta', 'reused', (select count(*) from fx_products)
union all select 'join', 'ran', (select n from f)
union all select 'extra', 'skipped_no_checkpoint', null
union all select 'extra_report', 'skipped_upstream', null""")
def run_stages(spark, sf):
    """First run: all stages but ``extra``; second run: loads disabled (their checkpoints are reused)."""
    root = scratch_path(spark, "stages")
    StageRunner(spark, root, {"extra": False}).run(_stages(spark, sf))
    _, status = StageRunner(spark, root, {"load_reviews": False, "load_meta": False, "extra": False}).run(
        _stages(spark, sf))
    return status.select("stage", "status", "rows")
