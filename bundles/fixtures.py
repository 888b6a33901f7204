"""Views over the driver tables that play the reference's roles.

``products`` (item metadata), ``reviews`` (user-item interactions) and
``collections`` (basket rows) are pure projections / joins of the TPC-H-like
tables, so every query built on them grows with the data.  The same three
statements are kept as SQL text (``*_SQL``) for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; ``timestamp_ntz`` columns become UTC ``timestamp``.

    The engine works in UTC: the session zone is pinned so timestamp casts and
    formatting do not depend on the machine's zone.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    casts = [F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, T.TimestampNTZType)
             else F.col(f.name) for f in df.schema.fields]
    return df.select(*casts)


PRODUCTS_SQL = """
select p_partkey as parent_asin, p_name as title, p_retailprice as price,
       lower(p_type) as cat_1, lower(p_brand) as cat_2,
       case when p_size % 5 = 0 then null else concat('size ', cast(p_size % 10 as varchar(10))) end as cat_3,
       case when p_size % 3 = 0 then null else concat('leaf ', cast(p_size as varchar(10))) end as cat_4,
       case when p_partkey % 11 = 0 then concat('["Sports & Outdoors","', p_type)
            when p_partkey % 2 = 0 then concat('["Sports & Outdoors","', p_type, '","', p_brand, '"]')
            else concat('[''Sports & Outdoors'',''', p_type, ''']') end as categories,
       concat('https://img.example/', cast(p_partkey as varchar(20)), '.jpg') as image_url
from part"""

REVIEWS_SQL = """
select o_custkey as user_id, l_partkey as parent_asin, l_orderkey as order_id, l_linenumber as line_no,
       (l_linenumber - 1) % 5 + 1 as rating, cast(l_quantity as bigint) % 8 as helpful_vote,
       case when l_returnflag = 'R' then null else l_returnflag = 'N' end as verified_purchase,
       l_shipdate as ts
from lineitem join orders on l_orderkey = o_orderkey"""

COLLECTIONS_SQL = """
select l_orderkey as collection_id, p_name as item_id,
       (l_linenumber - 1) % 5 + 1 as rating, l_partkey as order_key
from lineitem join part on l_partkey = p_partkey"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    size = F.col("p_size")
    key = F.col("p_partkey")
    return part.select(
        key.alias("parent_asin"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("price"),
        F.lower("p_type").alias("cat_1"),
        F.lower("p_brand").alias("cat_2"),
        F.when(size % 5 == 0, None).otherwise(F.concat(F.lit("size "), (size % 10).cast("string"))).alias("cat_3"),
        F.when(size % 3 == 0, None).otherwise(F.concat(F.lit("leaf "), size.cast("string"))).alias("cat_4"),
        F.when(key % 11 == 0, F.concat(F.lit('["Sports & Outdoors","'), "p_type"))
         .when(key % 2 == 0, F.concat(F.lit('["Sports & Outdoors","'), "p_type", F.lit('","'), "p_brand", F.lit('"]')))
         .otherwise(F.concat(F.lit("['Sports & Outdoors','"), "p_type", F.lit("']"))).alias("categories"),
        F.concat(F.lit("https://img.example/"), key.cast("string"), F.lit(".jpg")).alias("image_url"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    ln = F.col("l_linenumber")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("parent_asin"),
        F.col("l_orderkey").alias("order_id"),
        ln.alias("line_no"),
        ((ln - 1) % 5 + 1).alias("rating"),
        (F.col("l_quantity").cast("bigint") % 8).alias("helpful_vote"),
        F.when(F.col("l_returnflag") == "R", None).otherwise(F.col("l_returnflag") == "N").alias("verified_purchase"),
        F.col("l_shipdate").alias("ts"),
    )


def collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return li.join(pt, li.l_partkey == pt.p_partkey).select(
        F.col("l_orderkey").alias("collection_id"),
        F.col("p_name").alias("item_id"),
        ((F.col("l_linenumber") - 1) % 5 + 1).alias("rating"),
        F.col("l_partkey").alias("order_key"),
    )


# A review-side / metadata-side pair shaped like the reference's raw JSON
# records (names, types, the title clash), derived row by row from the tables.
RAW_REVIEWS_SQL = """
select cast(rating as double) as rating, concat('Order ', cast(order_id as varchar(20))) as title,
       cast(parent_asin as varchar(20)) as asin, cast(parent_asin as varchar(20)) as parent_asin,
       cast(user_id as varchar(20)) as user_id, epoch_ms(ts) as timestamp,
       helpful_vote, verified_purchase, order_id, line_no
from fx_reviews"""

RAW_META_SQL = """
select upper(cat_1) as main_category, title, cast(price as varchar(30)) as price, categories,
       cat_2 as store, cast(parent_asin as varchar(20)) as parent_asin
from fx_products"""


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reviews(spark, sf_dir)
    return r.select(
        F.col("rating").cast("double").alias("rating"),
        F.concat(F.lit("Order "), F.col("order_id").cast("string")).alias("title"),
        F.col("parent_asin").cast("string").alias("asin"),
        F.col("parent_asin").cast("string").alias("parent_asin"),
        F.col("user_id").cast("string").alias("user_id"),
        F.unix_millis("ts").alias("timestamp"),
        "helpful_vote", "verified_purchase", "order_id", "line_no")


def raw_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = products(spark, sf_dir)
    return p.select(F.upper("cat_1").alias("main_category"), "title",
                    F.col("price").cast("string").alias("price"), "categories",
                    F.col("cat_2").alias("store"), F.col("parent_asin").cast("string").alias("parent_asin"))
