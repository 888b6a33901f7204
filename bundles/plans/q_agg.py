"""Queries: aggregates, profiles, windows, sorts, top-n, sampling and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import expr as X
from ..operators import profile as P
from ..operators import select as S
from ..operators.topn import first_per_key, top_n, top_n_per_group
from .registry import query

SQL_RP = """
, rp as (select r.*, p.cat_1, p.cat_2, p.cat_3, p.cat_4, p.price, p.title
        from fx_reviews r join fx_products p using (parent_asin))
"""


def rp(spark, sf):
    return fx.reviews(spark, sf).join(fx.products(spark, sf), "parent_asin")


@query("agg_value_counts", "select parent_asin, count(*) as count from fx_reviews group by 1")
def agg_value_counts(spark, sf):
    return S.value_counts(fx.reviews(spark, sf), "parent_asin").orderBy(F.desc("count"), "parent_asin")


@query("agg_count_group", "select cat_1, cat_2, count(*) as size from fx_products group by 1, 2")
def agg_count_group(spark, sf):
    return fx.products(spark, sf).groupBy("cat_1", "cat_2").agg(F.count(F.lit(1)).alias("size"))


@query("agg_nunique", """
select count(distinct user_id) as n_users, count(distinct parent_asin) as n_items,
       count(distinct verified_purchase) as nunique_verified,
       (select count(*) from (select distinct verified_purchase from fx_reviews)) as unique_verified
from fx_reviews""")
def agg_nunique(spark, sf):
    r = fx.reviews(spark, sf)
    uniq = r.select("verified_purchase").distinct().select(F.count(F.lit(1))).scalar()
    return r.agg(F.countDistinct("user_id").alias("n_users"), F.countDistinct("parent_asin").alias("n_items"),
                 F.countDistinct("verified_purchase").alias("nunique_verified")).select("*", uniq.alias("unique_verified"))


@query("agg_crosstab", """
select rating, count(*) filter (where f = 0) as flag_0, count(*) filter (where f = 1) as flag_1
from (select rating, cast(coalesce(verified_purchase, false) as int) as f from fx_reviews) group by rating""")
def agg_crosstab(spark, sf):
    r = fx.reviews(spark, sf).select("rating", X.flag_true("verified_purchase").alias("flag"))
    return P.crosstab(r, "rating", "flag", [0, 1])


@query("agg_describe", SQL_RP + """
select 'rating' as column_name, count(rating) as count, round(avg(rating), 6) as mean, round(stddev_samp(rating), 6) as std,
    cast(min(rating) as double) as min, quantile_cont(rating, 0.25) as q25, quantile_cont(rating, 0.5) as q50,
    quantile_cont(rating, 0.75) as q75, cast(max(rating) as double) as max from rp
union all
select 'helpful_vote', count(helpful_vote), round(avg(helpful_vote), 6), round(stddev_samp(helpful_vote), 6),
    cast(min(helpful_vote) as double), quantile_cont(helpful_vote, 0.25), quantile_cont(helpful_vote, 0.5),
    quantile_cont(helpful_vote, 0.75), cast(max(helpful_vote) as double) from rp
union all
select 'price', count(price), round(avg(price), 6), round(stddev_samp(price), 6), min(price),
    round(quantile_cont(price, 0.25), 6), round(quantile_cont(price, 0.5), 6), round(quantile_cont(price, 0.75), 6),
    max(price) from rp""")
def agg_describe(spark, sf):
    d = P.describe(rp(spark, sf), ["rating", "helpful_vote", "price"])
    return d.select("column_name", "count", *[F.round(c, 6).alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]])


@query("agg_min_max", "select min(price) as min_price, max(price) as max_price from fx_products")
def agg_min_max(spark, sf):
    return fx.products(spark, sf).agg(F.min("price").alias("min_price"), F.max("price").alias("max_price"))


@query("agg_mean_group", SQL_RP + """
, top as (select cat_2 from rp where cat_2 is not null group by 1 order by count(*) desc, cat_2 limit 10)
select cat_2, round(avg(rating), 6) as mean_rating from rp join top using (cat_2) group by 1""")
def agg_mean_group(spark, sf):
    from ..operators.relational import top_n_keys
    d = rp(spark, sf)
    top = F.broadcast(top_n_keys(d, "cat_2", 10).select("cat_2"))
    return (d.join(top, "cat_2", "left_semi").groupBy("cat_2")
            .agg(F.round(F.avg("rating"), 6).alias("mean_rating")).orderBy(F.desc("mean_rating"), "cat_2"))


@query("agg_cat_summary", """
, long as (select 'cat_1' as column_name, cat_1 as value from fx_products union all
           select 'cat_2', cat_2 from fx_products union all select 'cat_3', cat_3 from fx_products)
, c as (select column_name, value, count(*) as n from long where value is not null group by 1, 2)
, r as (select *, row_number() over (partition by column_name order by n desc, value) as r from c)
select column_name, (select count(*) from c c2 where c2.column_name = r0.column_name) as n_unique,
  coalesce(max(case when r = 1 then concat(value, ' (', cast(n as varchar), ')') end), '') as top_1,
  coalesce(max(case when r = 2 then concat(value, ' (', cast(n as varchar), ')') end), '') as top_2,
  coalesce(max(case when r = 3 then concat(value, ' (', cast(n as varchar), ')') end), '') as top_3,
  coalesce(max(case when r = 4 then concat(value, ' (', cast(n as varchar), ')') end), '') as top_4,
  coalesce(max(case when r = 5 then concat(value, ' (', cast(n as varchar), ')') end), '') as top_5
from r r0 group by column_name""")
def agg_cat_summary(spark, sf):
    return P.cat_summary(fx.products(spark, sf), ["cat_1", "cat_2", "cat_3"])


@query("agg_null_report", """
select column_name, n_null from (
  select 'cat_3' as column_name, count(*) filter (where cat_3 is null) as n_null from fx_products union all
  select 'cat_4', count(*) filter (where cat_4 is null) from fx_products union all
  select 'title', count(*) filter (where title is null) from fx_products union all
  select 'price', count(*) filter (where price is null) from fx_products) where n_null > 0""")
def agg_null_report(spark, sf):
    return P.null_report(fx.products(spark, sf), ["cat_3", "cat_4", "title", "price"])


@query("agg_usable_pct", """
, f as (select case parent_asin % 5 when 0 then '[]' when 1 then ' None ' when 2 then '' when 3 then null
        else categories end as features, cat_3 from fx_products)
select column_name, present, n_null, total, round((total - n_null) * 100.0 / total, 6) as usable_pct from (
  select 'features' as column_name, true as present, count(*) filter (where features is null or lower(trim(features)) in ('[]', 'none', '')) as n_null, count(*) as total from f
  union all select 'cat_3', true, count(*) filter (where cat_3 is null or lower(trim(cat_3)) in ('[]', 'none', '')), count(*) from f
  union all select 'description', false, null, count(*) from f)""")
def agg_usable_pct(spark, sf):
    p = fx.products(spark, sf)
    k = F.col("parent_asin") % 5
    f = (F.when(k == 0, F.lit("[]")).when(k == 1, F.lit(" None ")).when(k == 2, F.lit(""))
         .when(k == 3, F.lit(None).cast("string")).otherwise(F.col("categories")))
    return P.usable_report(p.select(f.alias("features"), "cat_3"), ["features", "cat_3", "description"])


@query("agg_sparsity", """
select count(*) as n, count(distinct user_id) as n_users, count(distinct parent_asin) as n_items,
       round(1 - count(*) / (count(distinct user_id) * 1.0 * count(distinct parent_asin)), 9) as sparsity
from fx_reviews""")
def agg_sparsity(spark, sf):
    return P.sparsity(fx.reviews(spark, sf), "user_id", "parent_asin")


SQL_DEPTH = """
, d as (select case when starts_with(trim(categories), '[') and json_valid(replace(categories, '''', '"'))
        then len(cast(json(replace(categories, '''', '"')) as varchar[])) else 0 end as depth from fx_products)
"""


@query("agg_depth_dist", SQL_DEPTH + "select cast(depth as int) as category_depth, count(*) as n from d group by 1")
def agg_depth_dist(spark, sf):
    p = fx.products(spark, sf).select(X.depth(X.parse_py_list("categories")).alias("category_depth"))
    return p.groupBy("category_depth").agg(F.count(F.lit(1)).alias("n")).orderBy("category_depth")


@query("agg_histogram", """
, b as (select cast(least(floor((least(greatest(price, 0), 2000) - 0) / 2000 * 50), 49) as int) as bin
        from fx_products where price is not null)
, allb as (select cast(range as int) as bin from range(50))
select allb.bin, cast(round(0 + allb.bin * 40.0, 6) as double) as lo, cast(round(0 + (allb.bin + 1) * 40.0, 6) as double) as hi,
       cast(count(b.bin) as bigint) as n from allb left join b using (bin) group by 1""")
def agg_histogram(spark, sf):
    p = fx.products(spark, sf).select(X.clip("price", 0, 2000).alias("price"))
    return P.histogram(p, "price", 0.0, 2000.0, 50)


@query("agg_rate", """
select user_id, round(avg(cast(coalesce(verified_purchase, false) as int)), 6) as verified_rate,
       (select round(avg(cast(coalesce(verified_purchase, false) as int)), 6) from fx_reviews) as overall_rate
from fx_reviews group by 1""")
def agg_rate(spark, sf):
    r = fx.reviews(spark, sf).withColumn("f", X.flag_true("verified_purchase").cast("double"))
    overall = r.select(F.round(F.avg("f"), 6)).scalar()
    return r.groupBy("user_id").agg(F.round(F.avg("f"), 6).alias("verified_rate")).select(
        "user_id", "verified_rate", overall.alias("overall_rate"))


@query("agg_schema_report", """
select cast(ordinal_position - 1 as int) as ordinal, column_name as column_name,
  case data_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'DOUBLE' then 'double'
    when 'VARCHAR' then 'string' when 'TIMESTAMP' then 'timestamp' else lower(data_type) end as type,
  (select count(*) from lineitem) as n_rows,
  (select count(*) from information_schema.columns where table_name = 'lineitem') as n_cols
from information_schema.columns where table_name = 'lineitem'""", fx=False)
def agg_schema_report(spark, sf):
    return P.schema_report(fx.table(spark, sf, "lineitem"))


# ---- windows, sorts, top-n ---------------------------------------------------
@query("win_cumulative_cut", """
, c as (select parent_asin, count(*) as review_count from fx_reviews where parent_asin is not null group by 1)
, s as (select *, sum(review_count) over (order by review_count desc, parent_asin rows unbounded preceding)
        as cumulative_reviews from c)
select parent_asin, review_count, cast(cumulative_reviews as bigint) as cumulative_reviews from s
where cumulative_reviews - review_count < 30000""")
def win_cumulative_cut(spark, sf):
    return S.cumulative_cut(fx.reviews(spark, sf), "parent_asin", 30000)


@query("win_cut_stats", """
, c as (select parent_asin, count(*) as review_count from fx_reviews where parent_asin is not null group by 1)
, s as (select *, sum(review_count) over (order by review_count desc, parent_asin rows unbounded preceding)
        as cumulative_reviews from c)
, k as (select * from s where cumulative_reviews - review_count < 30000)
select count(*) as top_k, cast(sum(review_count) as bigint) as actual_reviews,
       round(count(*) * 100.0 / (select count(*) from c), 6) as pct_products,
       round(sum(review_count) / count(*), 6) as mean_reviews,
       round(sum(review_count) * 100.0 / 30000, 6) as efficiency_pct from k""")
def win_cut_stats(spark, sf):
    r = fx.reviews(spark, sf)
    return S.cut_stats(S.cumulative_cut(r, "parent_asin", 30000), S.value_counts(r, "parent_asin"), 30000)


@query("win_group_mean", """
select order_id, line_no, parent_asin, cast(round_even(avg(rating) over (partition by parent_asin), 1) as double)
    as avg_rating_parent from fx_reviews""")
def win_group_mean(spark, sf):
    r = fx.reviews(spark, sf)
    means = r.groupBy("parent_asin").agg(F.bround(F.avg("rating"), 1).alias("avg_rating_parent"))
    return r.join(means, "parent_asin").select("order_id", "line_no", "parent_asin", "avg_rating_parent")


@query("win_head_per_group", SQL_RP + """
, c as (select cat_2, cat_4, count(*) as n from rp where cat_2 is not null group by 1, 2)
select cat_2, cat_4, n, cast(r as int) as rank from (select *, row_number() over (partition by cat_2
    order by n desc, cat_4 nulls last) as r from c) where r <= 5""")
def win_head_per_group(spark, sf):
    d = rp(spark, sf).where(F.col("cat_2").isNotNull())
    c = d.groupBy("cat_2", "cat_4").agg(F.count(F.lit(1)).alias("n"))
    return top_n_per_group(c, ["cat_2"], [F.desc("n"), F.asc_nulls_last("cat_4")], 5).select(
        "cat_2", "cat_4", "n", F.col("rank").cast("int").alias("rank"))


@query("win_rank_long", """
, c as (select user_id, parent_asin, count(*) as n from fx_reviews group by 1, 2)
select user_id, cast(rank as int) as rank, parent_asin from (select *, row_number() over (partition by user_id
    order by n desc, parent_asin) as rank from c) where rank <= 3""")
def win_rank_long(spark, sf):
    c = fx.reviews(spark, sf).groupBy("user_id", "parent_asin").agg(F.count(F.lit(1)).alias("n"))
    t = top_n_per_group(c, ["user_id"], [F.desc("n"), F.asc("parent_asin")], 3, salt_cols=["parent_asin"])
    return t.select("user_id", F.col("rank").cast("int").alias("rank"), "parent_asin")


@query("win_first_per_key", """
select user_id, parent_asin, order_id, line_no from (select *, row_number() over (partition by user_id
    order by ts, order_id, line_no, parent_asin) as r from fx_reviews) where r = 1""")
def win_first_per_key(spark, sf):
    r = fx.reviews(spark, sf)
    return first_per_key(r, ["user_id"], ["ts", "order_id", "line_no", "parent_asin"]).select(
        "user_id", "parent_asin", "order_id", "line_no")


@query("srt_sort", "select cat_1, cat_2, parent_asin, price from fx_products")
def srt_sort(spark, sf):
    return fx.products(spark, sf).select("cat_1", "cat_2", "parent_asin", "price").orderBy(
        "cat_1", F.desc("price"), "parent_asin")


@query("top_n", "select parent_asin, title, price from fx_products order by price desc, parent_asin limit 10")
def q_top_n(spark, sf):
    return top_n(fx.products(spark, sf).select("parent_asin", "title", "price"), [F.desc("price"), "parent_asin"], 10)


@query("lim_head", "select * from fx_products order by parent_asin limit 5")
def lim_head(spark, sf):
    return fx.products(spark, sf).orderBy("parent_asin").limit(5)


SQL_SAMPLE = """
select order_id, line_no, parent_asin, user_id from fx_reviews
order by md5(concat('42|', cast(order_id as varchar), '|', cast(line_no as varchar), '|', cast(parent_asin as varchar))),
         order_id, line_no, parent_asin limit {n}"""


@query("smp_exact", SQL_SAMPLE.format(n=1500))
def smp_exact(spark, sf):
    r = fx.reviews(spark, sf).select("order_id", "line_no", "parent_asin", "user_id")
    return S.exact_sample(r, 1500, ["order_id", "line_no", "parent_asin"], seed=42)


@query("smp_users", """
select user_id from (select distinct user_id from fx_reviews)
order by md5(concat('7|', cast(user_id as varchar))), user_id limit 100""")
def smp_users(spark, sf):
    u = fx.reviews(spark, sf).select("user_id").distinct()
    return S.exact_sample(u, 100, ["user_id"], seed=7)


# ---- set operations ----------------------------------------------------------
@query("set_concat", """
select parent_asin, title, cat_1, null as cat_2 from fx_products where parent_asin % 2 = 0
union all select parent_asin, title, null, cat_2 from fx_products where parent_asin % 2 = 1""")
def set_concat(spark, sf):
    p = fx.products(spark, sf)
    a = p.where(F.col("parent_asin") % 2 == 0).select("parent_asin", "title", "cat_1")
    b = p.where(F.col("parent_asin") % 2 == 1).select("parent_asin", "title", "cat_2")
    return a.unionByName(b, allowMissingColumns=True)


@query("set_intersect", """
select parent_asin from fx_reviews where rating = 5 intersect select parent_asin from fx_reviews where rating = 1""")
def set_intersect(spark, sf):
    r = fx.reviews(spark, sf)
    return r.where("rating = 5").select("parent_asin").intersect(r.where("rating = 1").select("parent_asin"))


@query("set_dedupe_full", "select distinct cat_1, cat_2, cat_3 from fx_products")
def set_dedupe_full(spark, sf):
    return fx.products(spark, sf).select("cat_1", "cat_2", "cat_3").dropDuplicates()


@query("set_dedupe_key", """
select collection_id, item_id, rating, order_key from (select *, row_number() over (
    partition by collection_id, item_id order by order_key, rating desc) as r from fx_collections) where r = 1""")
def set_dedupe_key(spark, sf):
    c = fx.collections(spark, sf)
    return first_per_key(c, ["collection_id", "item_id"], [("order_key", "asc", True), ("rating", "desc")])
