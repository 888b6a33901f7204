"""Queries: text cleaners, list parsing, category levels, images, numeric helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import expr as X
from .registry import query

# DuckDB renderings of the same expressions.
D_STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
D_NORM = "lower(" + D_STRIP + ")"
D_CLEAN = "regexp_replace(" + D_NORM + ", '^[\\[\\{{\"]+|[\\]\\}}\"]+$', '', 'g')"
D_PY_LIST = ("(case when starts_with({x}, '[') and json_valid(replace({x}, '''', '\"')) "
             "then cast(json(replace({x}, '''', '\"')) as varchar[]) else cast([] as varchar[]) end)")
D_JSON_LIST = ("(case when starts_with({x}, '[') and json_valid({x}) "
               "then cast(json({x}) as varchar[]) else cast([] as varchar[]) end)")


def docs(spark, sf):
    return fx.table(spark, sf, "documents")


@query("txt_clean", f"""
select doc_id, md5({D_CLEAN.format(x='text')}) as text_md5, cast(length({D_CLEAN.format(x='text')}) as int) as n_chars_clean
from documents""", fx=False)
def txt_clean(spark, sf):
    c = X.clean_text("text")
    return docs(spark, sf).select("doc_id", F.md5(c).alias("text_md5"), F.length(c).alias("n_chars_clean"))


@query("txt_norm", f"select doc_id, {D_NORM.format(x='source')} as source_norm, "
                   f"{D_NORM.format(x='lang')} as lang_norm from documents", fx=False)
def txt_norm(spark, sf):
    return docs(spark, sf).select("doc_id", X.norm("source").alias("source_norm"), X.norm("lang").alias("lang_norm"))


@query("txt_title_head", "select doc_id, md5(split_part(text, ',', 1)) as head_md5, "
                         "cast(length(split_part(text, ',', 1)) as int) as head_len from documents", fx=False)
def txt_title_head(spark, sf):
    h = X.title_head("text")
    return docs(spark, sf).select("doc_id", F.md5(h).alias("head_md5"), F.length(h).alias("head_len"))


SQL_FEATURES = """
, feats as (select parent_asin, case cast(parent_asin as bigint) % 5 when 0 then '[]' when 1 then ' None '
        when 2 then '' when 3 then null else categories end as features,
        main_category, title, store, categories from raw_meta)
"""


def _features(spark, sf):
    m = fx.raw_meta(spark, sf)
    k = F.col("parent_asin").cast("bigint") % 5
    f = (F.when(k == 0, F.lit("[]")).when(k == 1, F.lit(" None ")).when(k == 2, F.lit(""))
         .when(k == 3, F.lit(None).cast("string")).otherwise(F.col("categories")))
    return m.select("parent_asin", f.alias("features"), "main_category", "title", "store", "categories")


@query("txt_null_like", SQL_FEATURES + f"""
select parent_asin, case when {D_NORM.format(x='features')} in ('[]', 'none', '') then null else features end
    as features from feats""")
def txt_null_like(spark, sf):
    return _features(spark, sf).select("parent_asin", X.null_like("features").alias("features"))


def _d_smart(x, kind):
    base = D_STRIP.format(x=x) if kind == "id" else D_NORM.format(x=x)
    return f"case when {D_NORM.format(x=x)} in ('none', '', ' ', '[]') then null else {base} end"


@query("txt_smart_clean", SQL_FEATURES + f"""
select {_d_smart('parent_asin', 'id')} as parent_asin, {_d_smart('features', 'bracket')} as features,
       {_d_smart('categories', 'bracket')} as categories, {_d_smart('title', 'text')} as title,
       {_d_smart('store', 'text')} as store, {_d_smart('main_category', 'text')} as main_category
from feats""")
def txt_smart_clean(spark, sf):
    f = _features(spark, sf)
    return f.select(X.smart_clean("parent_asin", "id").alias("parent_asin"),
                    X.smart_clean("features", "bracket").alias("features"),
                    X.smart_clean("categories", "bracket").alias("categories"),
                    X.smart_clean("title").alias("title"), X.smart_clean("store").alias("store"),
                    X.smart_clean("main_category").alias("main_category"))


@query("arr_parse_json", f"""
select parent_asin, array_to_string(l, '|') as cats, cast(len(l) as int) as n from
    (select parent_asin, {D_JSON_LIST.format(x='categories')} as l from fx_products)""")
def arr_parse_json(spark, sf):
    a = X.parse_json_list("categories")
    return fx.products(spark, sf).select("parent_asin", F.array_join(a, "|").alias("cats"), F.size(a).alias("n"))


@query("arr_parse_py", f"""
select parent_asin, array_to_string(l, '|') as cats, cast(len(l) as int) as n from
    (select parent_asin, {D_PY_LIST.format(x='categories')} as l from fx_products)""")
def arr_parse_py(spark, sf):
    a = X.parse_py_list("categories")
    return fx.products(spark, sf).select("parent_asin", F.array_join(a, "|").alias("cats"), F.size(a).alias("n"))


@query("arr_join", f"""
select parent_asin, coalesce(case when starts_with({D_STRIP.format(x='categories')}, '[') then
    (case when json_valid(replace(categories, '''', '"')) then array_to_string(
        list_transform(cast(json(replace(categories, '''', '"')) as varchar[]), lambda e: {D_STRIP.format(x='e')}), ' ')
     end) end, {D_STRIP.format(x='categories')}, '') as categories_text
from fx_products""")
def arr_join(spark, sf):
    return fx.products(spark, sf).select("parent_asin", X.list_text("categories").alias("categories_text"))


SQL_LEVELS = f"""
, lv as (select parent_asin, {D_PY_LIST.format(x='categories')} as l from fx_products)
"""


def _levels(spark, sf):
    return fx.products(spark, sf).select("parent_asin", X.parse_py_list("categories").alias("l"))


@query("arr_level_i", SQL_LEVELS + """
select parent_asin, lower(trim(l[1])) as cat_0, lower(trim(l[2])) as cat_1, lower(trim(l[3])) as cat_2,
       lower(trim(l[4])) as cat_3, lower(trim(l[5])) as cat_4 from lv""")
def arr_level_i(spark, sf):
    return _levels(spark, sf).select("parent_asin", *[X.level("l", i).alias(f"cat_{i}") for i in range(5)])


@query("arr_leaf", SQL_LEVELS + "select parent_asin, lower(trim(l[-1])) as leaf from lv")
def arr_leaf(spark, sf):
    return _levels(spark, sf).select("parent_asin", X.leaf("l").alias("leaf"))


@query("arr_depth", SQL_LEVELS + "select parent_asin, cast(len(l) as int) as category_depth from lv")
def arr_depth(spark, sf):
    return _levels(spark, sf).select("parent_asin", X.depth("l").alias("category_depth"))


# Images: a list of variant records per product, derived from its URL.
SQL_IMAGES = """
, imgs as (select parent_asin, case parent_asin % 5
    when 0 then concat('[{''variant'': ''PT01'', ''hi_res'': None, ''large'': ''', image_url, '?l'', ''thumb'': ''t''}, {''variant'': ''MAIN'', ''hi_res'': ''', image_url, ''', ''large'': ''x'', ''thumb'': ''t''}]')
    when 1 then concat('[{"variant": "PT02", "hi_res": "', image_url, '?h", "large": "', image_url, '?l", "thumb": "t"}]')
    when 2 then '[]'
    when 3 then concat('[{''variant'': ''MAIN'', ''hi_res'': None, ''large'': None, ''thumb'': ''', image_url, '?t''}]')
    else 'None' end as images from fx_products)
, parsed as (select parent_asin, case when json_valid(replace(replace(images, '''', '"'), 'None', 'null'))
        then cast(json(replace(replace(images, '''', '"'), 'None', 'null'))
             as struct(variant varchar, hi_res varchar, large varchar, thumb varchar)[]) end as l from imgs)
"""


def _images(spark, sf):
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
    return p.select("parent_asin", X.parse_images(text).alias("l"))


@query("img_main", SQL_IMAGES + """
select parent_asin, coalesce(nullif(p.hi_res, ''), nullif(p.large, ''), nullif(p.thumb, '')) as main_image_url
from (select parent_asin, coalesce(list_filter(l, lambda x: lower(x.variant) = 'main')[1], l[1]) as p from parsed)""")
def img_main(spark, sf):
    return _images(spark, sf).select("parent_asin", X.main_image("l").alias("main_image_url"))


@query("img_count", SQL_IMAGES + "select parent_asin, cast(coalesce(len(l), 0) as int) as num_images from parsed")
def img_count(spark, sf):
    return _images(spark, sf).select("parent_asin", X.image_count("l").alias("num_images"))


@query("img_hi_res", SQL_IMAGES + """
select parent_asin, array_to_string(list_filter(list_transform(l, lambda x: coalesce(nullif(x.hi_res, ''), x.large)), lambda y: y is not null), '|') as hi_res_images
from parsed""")
def img_hi_res(spark, sf):
    return _images(spark, sf).select("parent_asin", F.array_join(X.hi_res_list("l"), "|").alias("hi_res_images"))


@query("num_log1p", "select parent_asin, round(ln(1 + price), 6) as price_log from fx_products")
def num_log1p(spark, sf):
    return fx.products(spark, sf).select("parent_asin", F.round(X.log1p("price"), 6).alias("price_log"))


@query("num_clip", """
select order_id, line_no, parent_asin,
       case when v > 5 then 5 else v end as helpful_vote_clipped from
    (select *, case when line_no = 3 then null else helpful_vote end as v from fx_reviews)""")
def num_clip(spark, sf):
    r = fx.reviews(spark, sf)
    v = F.when(F.col("line_no") == 3, None).otherwise(F.col("helpful_vote"))
    return r.select("order_id", "line_no", "parent_asin", X.clip(v, upper=5).alias("helpful_vote_clipped"))


@query("dt_millis", """
select order_id, line_no, strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d %H:%M:%S') as timestamp_utc
from raw_reviews""")
def dt_millis(spark, sf):
    r = fx.raw_reviews(spark, sf)
    return r.select("order_id", "line_no",
                    F.date_format(X.millis_to_ts("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("timestamp_utc"))


@query("null_fill_chain", """
select parent_asin, coalesce(cat_3, cat_2) as cat_3, coalesce(cat_4, cat_3, cat_2) as cat_4 from fx_products""")
def null_fill_chain(spark, sf):
    c3, c4 = X.fill_chain("cat_2", "cat_3", "cat_4")
    return fx.products(spark, sf).select("parent_asin", c3.alias("cat_3"), c4.alias("cat_4"))


@query("flag_top100", """
with top as (select parent_asin from fx_reviews group by 1 order by count(*) desc, parent_asin limit 100)
select r.order_id, r.line_no, r.parent_asin, case when t.parent_asin is null then 0 else 1 end as is_top100
from fx_reviews r left join top t using (parent_asin)""")
def flag_top100(spark, sf):
    from ..operators.relational import top_n_keys
    r = fx.reviews(spark, sf)
    top = F.broadcast(top_n_keys(r, "parent_asin", 100).select("parent_asin", F.lit(1).alias("is_top100")))
    return (r.join(top, "parent_asin", "left")
            .select("order_id", "line_no", "parent_asin", F.coalesce("is_top100", F.lit(0)).alias("is_top100")))


@query("uvs_wide", """
select parent_asin, level, value from (
    select parent_asin, 'cat_1' as level, cat_1 as value from fx_products union all
    select parent_asin, 'cat_2', cat_2 from fx_products union all
    select parent_asin, 'cat_3', cat_3 from fx_products union all
    select parent_asin, 'cat_4', cat_4 from fx_products) where value is not null""")
def uvs_wide(spark, sf):
    p = fx.products(spark, sf)
    return p.unpivot("parent_asin", ["cat_1", "cat_2", "cat_3", "cat_4"], "level", "value").where("value is not null")
