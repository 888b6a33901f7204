"""Queries: similarity / co-occurrence edges, strategies, cascades, enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import collections as col
from ..operators import edges as ed
from ..operators import recommend as rec
from ..operators.topn import first_per_key
from .registry import query

# ---- shared SQL pieces (DuckDB) -------------------------------------------
SQL_MEMBERS = """
, c_dedup as (select * exclude (rn) from (select *, row_number() over (
        partition by collection_id, item_id order by order_key, rating desc) rn from fx_collections) where rn = 1)
, c_clean as (select *, coalesce(cast(rating > 0 as int), 0) as binary_rating from c_dedup
        where collection_id is not null and item_id is not null)
, members as (select * from c_clean where collection_id in
        (select collection_id from c_clean group by collection_id having count(*) >= 2))
"""

SQL_SIM = """
, sim_raw as (select a.item_id item1, b.item_id item2, cast(count(*) as double) weight
        from members a join members b on a.collection_id = b.collection_id and a.item_id <> b.item_id
        group by 1, 2)
, sim as (select item1, item2, weight / sum(weight) over (partition by item1) as weight from sim_raw)
"""

SQL_FIRST_ITEM_BASKETS = """
, baskets as (select collection_id as basket_id, item_id from (select *, row_number() over (
        partition by collection_id order by order_key, item_id) r from members) where r = 1)
"""

SQL_PRODUCT_META = """
, meta as (select title as item_id, price, title,
        case when cat_1 is not null and cat_1 <> '' then concat(cat_1, ' > ', coalesce(cat_2, '')) end as category,
        image_url from (select *, row_number() over (partition by title order by parent_asin) r
        from fx_products where title is not null) where r = 1)
"""


def members(spark, sf):
    return col.clean_collections(fx.collections(spark, sf))


def first_item_baskets(m):
    """Hold-one-in baskets: the first item (by order key) of every collection."""
    return (first_per_key(m, ["collection_id"], ["order_key", "item_id"])
            .select(F.col("collection_id").alias("basket_id"), "item_id"))


def _final_recs(df):
    return df.select("basket_id", "item_id", F.col("rank").cast("int").alias("rank"),
                     F.round("score", 6).alias("score"))


@query("rec_similarity", SQL_MEMBERS + SQL_SIM + SQL_FIRST_ITEM_BASKETS + """
, sc as (select b.basket_id, s.item2 as item_id, sum(s.weight) as score
        from baskets b join sim s on b.item_id = s.item1 where s.item2 <> b.item_id group by 1, 2)
select basket_id, item_id, cast(rank as int) as rank, round(score, 6) as score from (
    select *, row_number() over (partition by basket_id order by round(score, 9) desc, item_id) as rank from sc)
where rank <= 5
""")
def q_rec_similarity(spark, sf):
    m = members(spark, sf).cache()  # read by the edges, the baskets and the catalog
    e = ed.similarity_edges(m, normalize=True, assume_distinct=True).cache()
    return _final_recs(rec.per_distinct_basket(rec.by_edges, first_item_baskets(m).cache(), e, m, n=5))


@query("rec_enrich", SQL_MEMBERS + SQL_SIM + SQL_FIRST_ITEM_BASKETS + SQL_PRODUCT_META + """
, sc as (select b.basket_id, s.item2 as item_id, sum(s.weight) as score
        from baskets b join sim s on b.item_id = s.item1 where s.item2 <> b.item_id group by 1, 2)
, rk as (select * from (select *, row_number() over (partition by basket_id order by round(score, 9) desc, item_id) as rank
        from sc) where rank <= 5)
select rk.basket_id, rk.item_id, cast(rk.rank as int) as rank, round(rk.score, 6) as score,
       meta.price, meta.title, meta.category, meta.image_url
from rk left join meta on rk.item_id = meta.item_id
""")
def q_rec_enrich(spark, sf):
    m = members(spark, sf).cache()  # read by the edges, the baskets and the catalog
    e = ed.similarity_edges(m, normalize=True, assume_distinct=True).cache()
    recs = rec.per_distinct_basket(rec.by_edges, first_item_baskets(m).cache(), e, m, n=5)
    out = rec.enrich(recs, fx.products(spark, sf))
    return out.select("basket_id", "item_id", F.col("rank").cast("int").alias("rank"),
                      F.round("score", 6).alias("score"), "price", "title", "category", "image_url")
