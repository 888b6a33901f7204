"""Queries: projections, casts, scalar expressions, filters and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import expr as X
from ..operators import relational as R
from .registry import query


def _price_text(price_col, key_col):
    """Mixed price text derived from each product row (number, symbols, blanks, 'nan')."""
    k = F.col(key_col) % 6
    p = F.col(price_col).cast("string")
    return (F.when(k == 0, F.concat(F.lit("$"), p)).when(k == 1, F.lit("—"))
            .when(k == 2, F.concat(F.lit(" "), p, F.lit(" "))).when(k == 3, F.lit("nan"))
            .when(k == 4, F.lit("")).otherwise(p))


SQL_PRICE_TEXT = """case parent_asin % 6 when 0 then concat('$', cast(price as varchar)) when 1 then '—'
    when 2 then concat(' ', cast(price as varchar), ' ') when 3 then 'nan' when 4 then ''
    else cast(price as varchar) end"""

SQL_TO_DOUBLE = "(case when isnan(try_cast({x} as double)) then null else try_cast({x} as double) end)"


@query("prj_select", "select user_id, parent_asin, rating from fx_reviews")
def prj_select(spark, sf):
    return fx.reviews(spark, sf).select("user_id", "parent_asin", "rating")


@query("prj_drop_existing",
       "select parent_asin, title, price, cat_1, cat_2, cat_3, cat_4, categories from fx_products")
def prj_drop_existing(spark, sf):
    return fx.products(spark, sf).drop("image_url", "no_such_column")


SQL_JOINED = """
, joined as (select r.rating, r.title as title_review, r.asin, r.parent_asin, r.user_id, r.timestamp,
        r.helpful_vote, r.verified_purchase, r.order_id, r.line_no,
        m.main_category, m.title as title_meta, m.price, m.categories, m.store
    from raw_reviews r join raw_meta m on r.parent_asin = m.parent_asin)
"""


def joined(spark, sf):
    return R.join_with_suffixes(fx.raw_reviews(spark, sf), fx.raw_meta(spark, sf), ["parent_asin"])


@query("jn_reviews_meta", SQL_JOINED + "select * from joined")
def jn_reviews_meta(spark, sf):
    return joined(spark, sf)


@query("prj_rename_origin", SQL_JOINED + """
select rating as users_rating, title_review as users_title, asin as users_asin, parent_asin as users_parent_asin,
       user_id as users_user_id, timestamp as users_timestamp, helpful_vote as users_helpful_vote,
       verified_purchase as users_verified_purchase, order_id, line_no, main_category as item_main_category,
       title_meta as item_title, price as item_price, categories as item_categories, store as item_store
from joined""")
def prj_rename_origin(spark, sf):
    return R.rename_origin(joined(spark, sf))


@query("jn_key_overlap", """
select (select count(distinct parent_asin) from raw_reviews) as left_keys,
       (select count(distinct parent_asin) from raw_meta) as right_keys,
       (select count(*) from (select distinct parent_asin from raw_reviews where parent_asin is not null
            intersect select distinct parent_asin from raw_meta)) as common_keys""")
def jn_key_overlap(spark, sf):
    return R.key_overlap(fx.raw_reviews(spark, sf), fx.raw_meta(spark, sf), "parent_asin")


@query("prj_price", f"""
select parent_asin, price_text, {SQL_TO_DOUBLE.format(x='price_text')} as price_clean
from (select parent_asin, {SQL_PRICE_TEXT} as price_text from fx_products)""")
def prj_price(spark, sf):
    p = fx.products(spark, sf).select("parent_asin", _price_text("price", "parent_asin").alias("price_text"))
    return p.select("parent_asin", "price_text", X.clean_price("price_text").alias("price_clean"))


SQL_RATING_TEXT = """case order_id % 5 when 0 then cast(rating as varchar) when 1 then concat(cast(rating as varchar), '.7')
    when 2 then 'five' when 3 then null else concat(' ', cast(rating as varchar)) end"""


def _rating_text(df):
    k = F.col("order_id") % 5
    r = F.col("rating").cast("string")
    return (F.when(k == 0, r).when(k == 1, F.concat(r, F.lit(".7"))).when(k == 2, F.lit("five"))
            .when(k == 3, F.lit(None).cast("string")).otherwise(F.concat(F.lit(" "), r)))


@query("prj_numeric", f"""
select order_id, line_no, parent_asin, {SQL_TO_DOUBLE.format(x='rating_text')} as rating_num
from (select *, {SQL_RATING_TEXT} as rating_text from fx_reviews)""")
def prj_numeric(spark, sf):
    r = fx.reviews(spark, sf).withColumn("rating_text", _rating_text(fx.reviews(spark, sf)))
    return r.select("order_id", "line_no", "parent_asin", X.to_double("rating_text").alias("rating_num"))


@query("prj_rating_int", f"""
select order_id, line_no, parent_asin,
       cast(trunc(coalesce({SQL_TO_DOUBLE.format(x='rating_text')}, 0.0)) as int) as rating_int
from (select *, {SQL_RATING_TEXT} as rating_text from fx_reviews)""")
def prj_rating_int(spark, sf):
    r = fx.reviews(spark, sf).withColumn("rating_text", _rating_text(fx.reviews(spark, sf)))
    return r.select("order_id", "line_no", "parent_asin", X.rating_int("rating_text").alias("rating_int"))


@query("prj_binary_rating", """
select collection_id, item_id, order_key, coalesce(cast(rating - 1 > 0 as int), 0) as binary_rating
from fx_collections""")
def prj_binary_rating(spark, sf):
    c = fx.collections(spark, sf)
    return c.select("collection_id", "item_id", "order_key", X.binary(F.col("rating") - 1).alias("binary_rating"))


@query("prj_flag_verified", """
select order_id, line_no, parent_asin, cast(coalesce(verified_purchase, false) as int) as verified_purchase_flag
from fx_reviews""")
def prj_flag_verified(spark, sf):
    r = fx.reviews(spark, sf)
    return r.select("order_id", "line_no", "parent_asin", X.flag_true("verified_purchase").alias("verified_purchase_flag"))


@query("prj_flag_eq", """
select parent_asin, coalesce(cast(cat_1 = 'economy' as int), 0) as is_economy from fx_products""")
def prj_flag_eq(spark, sf):
    return fx.products(spark, sf).select("parent_asin", X.flag_eq("cat_1", "economy").alias("is_economy"))


@query("prj_interaction", """
select order_id, line_no, user_id, parent_asin,
       cast((coalesce(cast(verified_purchase as int), 0) = 1 or coalesce(helpful_vote, 0) > 0) as float) as value
from fx_reviews""")
def prj_interaction(spark, sf):
    r = fx.reviews(spark, sf)
    return r.select("order_id", "line_no", "user_id", "parent_asin",
                    X.interaction_label("verified_purchase", "helpful_vote").alias("value"))


@query("prj_confidence", """
select order_id, line_no, user_id, parent_asin, cast(coalesce(helpful_vote, 0) as float) as value from fx_reviews""")
def prj_confidence(spark, sf):
    r = fx.reviews(spark, sf)
    return r.select("order_id", "line_no", "user_id", "parent_asin", X.confidence("helpful_vote").alias("value"))


@query("prj_triplets", """
select cast(user_id as varchar) as user_id, cast(parent_asin as varchar) as item_id,
       cast(rating as float) as value from fx_reviews where rating is not null""")
def prj_triplets(spark, sf):
    from ..ml.data import triplets
    return triplets(fx.reviews(spark, sf), "mf")


@query("prj_category_label", """
select parent_asin, case when cat_1 is not null and cat_1 <> '' then concat(cat_1, ' > ', coalesce(cat_2, '')) end
    as category from fx_products""")
def prj_category_label(spark, sf):
    return fx.products(spark, sf).select("parent_asin", X.category_label("cat_1", "cat_2").alias("category"))


@query("prj_truncate", """
select parent_asin, case when length(title) > 8 then concat(substring(title, 1, 8), '...') else title end as title_short,
       printf('%.2f', price) as price_text from fx_products""")
def prj_truncate(spark, sf):
    return fx.products(spark, sf).select("parent_asin", X.truncate("title", 8).alias("title_short"),
                                         X.format_price("price").alias("price_text"))


# ---- filters ---------------------------------------------------------------
# Five-category cut used by the export (values of this data set).
FIVE_CATEGORIES = ["brand#1", "brand#2", "brand#3", "brand#4", "brand#5"]


@query("flt_isin", """
select * from fx_products where cat_2 in ('brand#1', 'brand#2', 'brand#3', 'brand#4', 'brand#5')""")
def flt_isin(spark, sf):
    return fx.products(spark, sf).where(F.col("cat_2").isin(*FIVE_CATEGORIES))


@query("flt_isin_table", """
select user_id, parent_asin, order_id, line_no, rating from fx_reviews r where parent_asin in
    (select parent_asin from fx_reviews group by parent_asin having count(*) >= 35)""")
def flt_isin_table(spark, sf):
    r = fx.reviews(spark, sf)
    keys = r.groupBy("parent_asin").count().where(F.col("count") >= 35).select("parent_asin")
    return R.semi(r, keys, "parent_asin").select("user_id", "parent_asin", "order_id", "line_no", "rating")


@query("flt_not_isin", """
select c.* from fx_collections c where not exists (
    select 1 from fx_collections o where o.collection_id = c.collection_id and o.item_id = c.item_id
      and o.order_key < c.order_key)""")
def flt_not_isin(spark, sf):
    """Rows whose item was not already owned earlier in the same collection."""
    c = fx.collections(spark, sf)
    first = c.groupBy("collection_id", "item_id").agg(F.min("order_key").alias("first_key"))
    owned = F.coalesce(F.col("first_key") < F.col("order_key"), F.lit(False))
    return c.join(first, ["collection_id", "item_id"], "left").where(~owned).select(*c.columns)


@query("flt_between", SQL_JOINED + f"""
select order_id, line_no, users_rating, item_price from (
    select order_id, line_no, rating as users_rating, {SQL_TO_DOUBLE.format(x='price')} as item_price from joined)
where users_rating between 1 and 5 and item_price between 1 and 1000""")
def flt_between(spark, sf):
    j = joined(spark, sf).select("order_id", "line_no", F.col("rating").alias("users_rating"),
                                 X.to_double("price").alias("item_price"))
    return j.where(F.col("users_rating").between(1, 5) & F.col("item_price").between(1, 1000))


@query("flt_dropna", "select * from fx_products where cat_3 is not null and cat_4 is not null")
def flt_dropna(spark, sf):
    return fx.products(spark, sf).dropna(subset=["cat_3", "cat_4"])


@query("flt_min_group", """
select * from fx_collections where collection_id in
    (select collection_id from fx_collections group by 1 having count(*) >= 2)""")
def flt_min_group(spark, sf):
    return R.min_group_size(fx.collections(spark, sf), "collection_id", 2)


@query("flt_threshold_users", """
with m as (select user_id, max(rating) as mx from fx_reviews group by 1)
select t.t as threshold, cast(count(*) as bigint) as n_users from (values (1), (2), (3), (4), (5)) t(t)
join m on m.mx >= t.t group by 1""")
def flt_threshold_users(spark, sf):
    r = fx.reviews(spark, sf)
    m = r.groupBy("user_id").agg(F.max("rating").alias("mx"))
    cols = [F.sum(F.when(F.col("mx") >= t, 1).otherwise(0)).cast("bigint").alias(str(t)) for t in range(1, 6)]
    wide = m.agg(*cols)
    return (wide.unpivot([], [str(t) for t in range(1, 6)], "threshold", "n_users")
            .select(F.col("threshold").cast("int").alias("threshold"), "n_users").where("n_users > 0"))


@query("flt_top_n_keys", """
with top as (select parent_asin from fx_reviews group by 1 order by count(*) desc, parent_asin limit 10)
select r.user_id, r.parent_asin, r.order_id, r.line_no, r.rating from fx_reviews r join top using (parent_asin)""")
def flt_top_n_keys(spark, sf):
    r = fx.reviews(spark, sf)
    return (R.semi(r, F.broadcast(R.top_n_keys(r, "parent_asin", 10).select("parent_asin")), "parent_asin")
            .select("user_id", "parent_asin", "order_id", "line_no", "rating"))
