"""Queries: cleaning job with funnel, feature passes, category export."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import relational as R
from . import clean as C
from .q_text import D_CLEAN, D_JSON_LIST, D_NORM, D_PY_LIST, D_STRIP, SQL_IMAGES
from .registry import query

# ---- the joined review + metadata view with list / image text -------------------
SQL_META_FULL = SQL_IMAGES.replace(", parsed as", ", parsed_unused as") + """
, meta_full as (select m.*, case cast(m.parent_asin as bigint) % 5 when 0 then '[]' when 1 then ' None ' when 2 then ''
        when 3 then null else m.categories end as features,
        concat('[''', m.title, ' for sport'', '' best '']') as description, i.images as images_meta
    from raw_meta m join imgs i on cast(i.parent_asin as varchar) = m.parent_asin)
, joined_full as (select r.rating, r.title as title_review, r.asin, r.parent_asin, r.user_id, r.timestamp,
        r.helpful_vote, r.verified_purchase, r.order_id, r.line_no, m.main_category, m.title as title_meta, m.price,
        m.categories, m.store, m.features, m.description, m.images_meta
    from raw_reviews r join meta_full m on r.parent_asin = m.parent_asin)
"""


def meta_full(spark, sf):
    m = fx.raw_meta(spark, sf)
    k = F.col("parent_asin").cast("bigint") % 5
    feats = (F.when(k == 0, F.lit("[]")).when(k == 1, F.lit(" None ")).when(k == 2, F.lit(""))
             .when(k == 3, F.lit(None).cast("string")).otherwise(F.col("categories")))
    desc = F.concat(F.lit("['"), F.col("title"), F.lit(" for sport', ' best ']"))
    imgs_text = _image_text(spark, sf)
    return (m.select("*", feats.alias("features"), desc.alias("description"))
            .join(imgs_text, "parent_asin"))


def _image_text(spark, sf):
    # same text as the image queries, keyed by the string id
    p = fx.products(spark, sf)
    k = F.col("parent_asin") % 5
    u = F.col("image_url")
    text = (F.when(k == 0, F.concat(F.lit("[{'variant': 'PT01', 'hi_res': None, 'large': '"), u,
                                    F.lit("?l', 'thumb': 't'}, {'variant': 'MAIN', 'hi_res': '"), u,
                                    F.lit("', 'large': 'x', 'thumb': 't'}]")))
            .when(k == 1, F.concat(F.lit('[{"variant": "PT02", "hi_res": "'), u, F.lit('?h", "large": "'), u,
                                   F.lit('?l", "thumb": "t"}]')))
            .when(k == 2, F.lit("[]"))
            .when(k == 3, F.concat(F.lit("[{'variant': 'MAIN', 'hi_res': None, 'large': None, 'thumb': '"), u,
                                   F.lit("?t'}]")))
            .otherwise(F.lit("None")))
    return p.select(F.col("parent_asin").cast("string").alias("parent_asin"), text.alias("images_meta"))


def joined_full(spark, sf):
    return R.join_with_suffixes(fx.raw_reviews(spark, sf), meta_full(spark, sf), ["parent_asin"])


# ---- job_clean ------------------------------------------------------------------
def _d_clean_basic():
    std = {c: D_CLEAN.format(x=c) for c in ["users_user_id", "users_parent_asin", "item_title", "item_price",
                                             "item_main_category"]}
    return f"""
, ren as (select user_id as users_user_id, parent_asin as users_parent_asin, rating as users_rating,
        title_meta as item_title, categories as item_categories, price as item_price,
        main_category as item_main_category from joined_full)
, s0 as (select {std['users_user_id']} as users_user_id, {std['users_parent_asin']} as users_parent_asin, users_rating,
        {std['item_title']} as item_title, item_categories, {std['item_price']} as item_price,
        {std['item_main_category']} as item_main_category from ren)
, s1 as (select distinct * from s0)
, s2 as (select * from s1 where users_user_id is not null and users_parent_asin is not null and users_rating is not null
        and item_title is not null)
, s3 as (select * from s2 where users_rating between 1 and 5)
, s4 as (select * exclude (item_price), case when isnan(try_cast(item_price as double)) then null
        else try_cast(item_price as double) end as item_price from s3)
, s5 as (select * from s4 where item_price between 1 and 1000)
"""


@query("job_clean", SQL_META_FULL + _d_clean_basic() + "select * from s5")
def job_clean(spark, sf):
    return C.clean_basic(R.rename_origin(joined_full(spark, sf)))


@query("agg_funnel", SQL_META_FULL + _d_clean_basic() + """
, f as (select 0 as step_no, 'input' as step, count(*) as rows from s0 union all select 1, 'dedupe', count(*) from s1
        union all select 2, 'dropna', count(*) from s2 union all select 3, 'rating_1_5', count(*) from s3
        union all select 4, 'price_1_1000', count(*) from s5)
select step_no, step, rows, coalesce(lag(rows) over (order by step_no) - rows, 0) as dropped from f""")
def agg_funnel(spark, sf):
    return C.funnel(R.rename_origin(joined_full(spark, sf)))


@query("job_features_a", SQL_META_FULL + _d_clean_basic() + f"""
, top as (select users_parent_asin from s5 where users_parent_asin is not null group by 1
        order by count(*) desc, users_parent_asin limit 100)
, lv as (select *, {D_JSON_LIST.format(x=D_STRIP.format(x='item_categories'))} as l from s5)
select users_user_id, users_parent_asin, users_rating, item_title, item_categories, item_price, item_main_category,
    lower(trim(l[1])) as category_level_0, lower(trim(l[2])) as category_level_1, lower(trim(l[3])) as category_level_2,
    lower(trim(l[4])) as category_level_3, lower(trim(l[-1])) as leaf_category,
    {D_NORM.format(x='item_main_category')} as item_main_category_cleaned,
    split_part(item_title, ',', 1) as item_title_clean,
    case when users_parent_asin in (select users_parent_asin from top) then 1 else 0 end as is_top100,
    coalesce(cast({D_NORM.format(x='item_main_category')} = 'sports and outdoors' as int), 0) as is_sports_and_outdoors
from lv""")
def job_features_a(spark, sf):
    return C.features_a(C.clean_basic(R.rename_origin(joined_full(spark, sf))))


def _d_smart(x, kind):
    base = D_STRIP.format(x=x) if kind == "id" else D_NORM.format(x=x)
    return f"case when {D_NORM.format(x=x)} in ('none', '', ' ', '[]') then null else {base} end"


SQL_FINAL = SQL_META_FULL + f"""
, j0 as (select distinct * from joined_full)
, j1 as (select {_d_smart('cast(rating as varchar)', 'text')} as rating_s, {_d_smart('title_review', 'text')} as title_review,
        {_d_smart('asin', 'id')} as asin, {_d_smart('parent_asin', 'id')} as parent_asin, {_d_smart('user_id', 'id')} as user_id,
        timestamp, helpful_vote, verified_purchase, order_id, line_no,
        {_d_smart('main_category', 'text')} as main_category, {_d_smart('title_meta', 'text')} as title_meta,
        {_d_smart('price', 'text')} as price, {_d_smart('categories', 'bracket')} as categories,
        {_d_smart('store', 'text')} as store, {_d_smart('features', 'bracket')} as features,
        {_d_smart('description', 'bracket')} as description,
        case when json_valid(replace(replace(images_meta, '''', '"'), 'None', 'null'))
             then cast(json(replace(replace(images_meta, '''', '"'), 'None', 'null'))
                  as struct(variant varchar, hi_res varchar, large varchar, thumb varchar)[]) end as imgs
    from j0)
, j2 as (select *, cast(trunc(coalesce(case when isnan(try_cast(rating_s as double)) then null
        else try_cast(rating_s as double) end, 0.0)) as int) as rating from j1)
, j3 as (select parent_asin, rating, title_review, user_id, helpful_vote, order_id, line_no, title_meta,
        case when isnan(try_cast(price as double)) then null else try_cast(price as double) end as price, store,
        coalesce(case when starts_with({D_STRIP.format(x='features')}, '[') then (case when json_valid(replace(features, '''', '"'))
            then array_to_string(list_transform(cast(json(replace(features, '''', '"')) as varchar[]),
            lambda e: {D_STRIP.format(x='e')}), ' ') end) end, {D_STRIP.format(x='features')}, '') as features_clean,
        coalesce(case when starts_with({D_STRIP.format(x='description')}, '[') then (case when json_valid(replace(description, '''', '"'))
            then array_to_string(list_transform(cast(json(replace(description, '''', '"')) as varchar[]),
            lambda e: {D_STRIP.format(x='e')}), ' ') end) end, {D_STRIP.format(x='description')}, '') as description_clean,
        (select coalesce(nullif(p.hi_res, ''), nullif(p.large, ''), nullif(p.thumb, ''))
            from (select coalesce(list_filter(imgs, lambda x: lower(x.variant) = 'main')[1], imgs[1]) as p)) as main_image_url,
        cast(coalesce(len(imgs), 0) as int) as num_images,
        array_to_string(list_filter(list_transform(imgs, lambda x: coalesce(nullif(x.hi_res, ''), x.large)),
            lambda y: y is not null), '|') as hi_res_images,
        strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d %H:%M:%S') as timestamp_utc,
        cast(len({D_JSON_LIST.format(x=D_STRIP.format(x='categories'))}) as int) as category_depth,
        cast(coalesce(verified_purchase, false) as int) as verified_purchase_flag,
        {D_PY_LIST.format(x=D_STRIP.format(x='categories'))} as pl
    from j2)
, j4 as (select * exclude (pl), lower(trim(pl[1])) as cat_0, lower(trim(pl[2])) as cat_1, lower(trim(pl[3])) as cat_2,
        lower(trim(pl[4])) as cat_3, lower(trim(pl[5])) as cat_4, round(ln(1 + price), 6) as price_log,
        case when helpful_vote > 5 then 5 else helpful_vote end as helpful_vote_clipped,
        cast(round_even(avg(rating) over (partition by parent_asin), 1) as double) as avg_rating_parent from j3)
, final as (select distinct * exclude (cat_0, cat_4), coalesce(cat_4, cat_3) as cat_4 from j4 where cat_0 is not null)
"""


def final_table(spark, sf):
    f = C.features_b(fx.raw_reviews(spark, sf), meta_full(spark, sf))
    return f.select("parent_asin", "rating", "title_review", "user_id", "helpful_vote", "order_id", "line_no",
                    "title_meta", "price", "store", "features_clean", "description_clean", "main_image_url", "num_images",
                    F.array_join("hi_res_images", "|").alias("hi_res_images"),
                    F.date_format("timestamp_utc", "yyyy-MM-dd HH:mm:ss").alias("timestamp_utc"),
                    "category_depth", "verified_purchase_flag", "cat_1", "cat_2", "cat_3",
                    F.round("price_log", 6).alias("price_log"), "helpful_vote_clipped", "avg_rating_parent", "cat_4")


@query("job_features_b", SQL_FINAL + "select * from final")
def job_features_b(spark, sf):
    return final_table(spark, sf)


# This data set's five most common second-level categories.
FIVE = ["brand#1", "brand#2", "brand#3", "brand#4", "brand#5"]


@query("job_top_categories", SQL_FINAL + """
select 'final' as table_name, count(*) as n_rows from final
union all select 'five_categories', count(*) from final where cat_2 in ('brand#1', 'brand#2', 'brand#3', 'brand#4', 'brand#5')""")
def job_top_categories(spark, sf):
    """Filter the final table to the five categories and export both tables (parquet), reporting row counts."""
    from ..sources import writers as W
    from ..session import scratch_path
    final = final_table(spark, sf)
    p1, p2 = scratch_path(spark, "final"), scratch_path(spark, "five")
    W.write_parquet(final, p1)
    W.write_parquet(C.top_categories(spark.read.parquet(p1), FIVE), p2)  # from what is written: the pipeline runs once
    a = spark.read.parquet(p1).select(F.lit("final").alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
    b = spark.read.parquet(p2).select(F.lit("five_categories").alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
    return a.groupBy("table_name").agg(F.sum("n_rows").alias("n_rows")).unionByName(
        b.groupBy("table_name").agg(F.sum("n_rows").alias("n_rows")))
