"""Queries: packing, collection cleaning, transactions, itemsets, rules, edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import collections as col
from ..operators import edges as ed
from ..operators import mining as mn
from ..operators.pack import pack_collections
from ..operators.topn import top_n
from .q_recommend import SQL_MEMBERS, members
from .registry import query

# The oracle SQL computes the first adaptive candidate, int(n * 0.5 / 100),
# from the transaction count; at sf0.01 it lies in the 10..1000 window
# (checked by job_adaptive_support), so both engines mine the same support.
SQL_SUPPORT = "(select greatest(1, cast(floor(count(*) * 0.5 / 100) as bigint)) from txn)"


def transactions(spark, sf):
    """One row per collection; its own size filter is that of ``members``, so the rows are not sized twice."""
    return col.transactions(col.clean_collections(fx.collections(spark, sf), min_size=1))


def mined(spark, sf):
    """Transactions, the adaptive support and its itemsets (mined once, cached)."""
    txn = transactions(spark, sf).cache()
    choice = mn.adaptive_support(txn)
    return txn, txn.count(), choice, choice.itemsets


def rules_at_choice(pats, n):
    allr = mn.association_rules(pats, min(mn.CONFIDENCE_STEPS), n)
    t = mn.pick_confidence(allr)
    return allr.where(F.col("confidence") >= (t if t is not None else 2.0)), t


def _txt(c):
    return F.array_join(c, "|")


# ---- SQL pieces ---------------------------------------------------------------
SQL_TXN = SQL_MEMBERS + """
, txn as (select collection_id, list_sort(list(item_id)) as items from members group by 1 having count(*) >= 2)
"""


def sql_patterns(s):
    return f"""
, p1 as (select item_id as i1, count(*) as freq from members group by 1 having count(*) >= {s})
, m1 as (select m.collection_id, m.item_id from members m join p1 on m.item_id = p1.i1)
, p2 as (select a.item_id as i1, b.item_id as i2, count(*) as freq from m1 a join m1 b
        on a.collection_id = b.collection_id and a.item_id < b.item_id group by 1, 2 having count(*) >= {s})
, p3 as (select a.item_id as i1, b.item_id as i2, c.item_id as i3, count(*) as freq from m1 a
        join m1 b on a.collection_id = b.collection_id and a.item_id < b.item_id
        join p2 on p2.i1 = a.item_id and p2.i2 = b.item_id
        join m1 c on c.collection_id = a.collection_id and b.item_id < c.item_id
        group by 1, 2, 3 having count(*) >= {s})
, patterns as (select [i1] as items, freq from p1 union all select [i1, i2], freq from p2
        union all select [i1, i2, i3], freq from p3)
"""


SQL_RULES = """
, f1 as (select i1, freq from p1), f2 as (select i1, i2, freq from p2)
, rules_all as (
    select [p.i1] as ante, [p.i2] as cons, p.freq as sup, cast(p.freq as double) / s.freq as conf from p2 p join f1 s on s.i1 = p.i1
    union all select [p.i2], [p.i1], p.freq, cast(p.freq as double) / s.freq from p2 p join f1 s on s.i1 = p.i2
    union all select [p.i1], [p.i2, p.i3], p.freq, cast(p.freq as double) / s.freq from p3 p join f1 s on s.i1 = p.i1
    union all select [p.i2], [p.i1, p.i3], p.freq, cast(p.freq as double) / s.freq from p3 p join f1 s on s.i1 = p.i2
    union all select [p.i3], [p.i1, p.i2], p.freq, cast(p.freq as double) / s.freq from p3 p join f1 s on s.i1 = p.i3
    union all select [p.i1, p.i2], [p.i3], p.freq, cast(p.freq as double) / s.freq from p3 p join f2 s on s.i1 = p.i1 and s.i2 = p.i2
    union all select [p.i1, p.i3], [p.i2], p.freq, cast(p.freq as double) / s.freq from p3 p join f2 s on s.i1 = p.i1 and s.i2 = p.i3
    union all select [p.i2, p.i3], [p.i1], p.freq, cast(p.freq as double) / s.freq from p3 p join f2 s on s.i1 = p.i2 and s.i2 = p.i3)
, conf_t as (select min(t) as t from (values (0.5), (0.3), (0.1), (0.05), (0.01)) v(t)
        where t <= (select max(conf) from rules_all) and t = (select max(t2) from (values (0.5), (0.3), (0.1), (0.05), (0.01)) w(t2)
        where t2 <= (select max(conf) from rules_all)))
, rules as (select * from rules_all where conf >= (select t from conf_t))
, rules1 as (select * exclude (r) from (select *, row_number() over (partition by array_to_string(ante, chr(1))
        order by conf desc, len(cons) desc, array_to_string(cons, chr(1))) as r from rules) where r = 1)
, nt as (select count(*) as n from txn)
"""


@query("job_pack", """
with recursive src as (
    select cat_1 as g, cat_2 as c2, cat_3 as c3, parent_asin as k, cast(parent_asin % 5 + 1 as int) as rating,
           row_number() over (partition by cat_1 order by parent_asin) as rn
    from fx_products where cat_1 is not null),
walk as (
    select g, cast(0 as bigint) as rn, cast([] as bigint[]) as bk, cast([] as varchar[]) as b2,
           cast([] as varchar[]) as b3, cast(0 as bigint) as seq, cast(null as bigint[]) as emit,
           cast(null as bigint) as emit_seq
    from (select distinct g from src)
    union all
    select g, nrn,
        case when acc and len(bk) = 4 then cast([] as bigint[]) when acc then list_append(bk, k) else bk end,
        case when acc and len(bk) = 4 then cast([] as varchar[]) when acc then list_append(b2, c2) else b2 end,
        case when acc and len(bk) = 4 then cast([] as varchar[]) when acc then list_append(b3, c3) else b3 end,
        case when acc and len(bk) = 4 then seq + 1 else seq end,
        case when acc and len(bk) = 4 then list_append(bk, k) end,
        case when acc and len(bk) = 4 then seq end
    from (select w.g, w.bk, w.b2, w.b3, w.seq, s.k, s.c2, s.c3, s.rn as nrn,
                 (len(list_filter(w.b2, lambda x: x is not distinct from s.c2)) < 2
                  and len(list_filter(w.b3, lambda x: x is not distinct from s.c3)) < 2) as acc
          from walk w join src s on s.g = w.g and s.rn = w.rn + 1) t)
, emitted as (select g, emit_seq, unnest(emit) as k, cast(generate_subscripts(emit, 1) - 1 as int) as position
        from walk where emit is not null)
, ids as (select g, emit_seq, row_number() over (order by g, emit_seq) as collection_id
        from (select distinct g, emit_seq from emitted))
select ids.collection_id, e.k as item_id, src.rating, e.g as "group", e.position
from emitted e join ids using (g, emit_seq) join src on src.k = e.k""")
def job_pack(spark, sf):
    p = fx.products(spark, sf).withColumn("rating", (F.col("parent_asin") % 5 + 1).cast("int"))
    return pack_collections(p, "cat_1", "cat_2", "cat_3", "parent_asin", "parent_asin", "rating")


@query("job_clean_collections", SQL_MEMBERS + """
select collection_id, item_id, rating, order_key, binary_rating from members""")
def job_clean_collections(spark, sf):
    return members(spark, sf).select("collection_id", "item_id", "rating", "order_key", "binary_rating")


@query("job_item_codes", SQL_MEMBERS + """
select item_id, row_number() over (order by item_id) - 1 as item_code from (select distinct item_id from members)""")
def job_item_codes(spark, sf):
    return col.item_codes(members(spark, sf))


@query("job_transactions", SQL_TXN + """
select collection_id, array_to_string(items, '|') as items, cast(len(items) as int) as n_items from txn""")
def job_transactions(spark, sf):
    t = transactions(spark, sf)
    return t.select("collection_id", _txt(F.col("items")).alias("items"), F.size("items").alias("n_items"))


@query("agg_collect", SQL_MEMBERS + """
select collection_id, array_to_string(list_sort(list(item_id)), '|') as items from members group by 1""")
def agg_collect(spark, sf):
    m = members(spark, sf)
    return m.groupBy("collection_id").agg(_txt(F.array_sort(F.collect_set("item_id"))).alias("items"))


@query("agg_txn_stats", SQL_TXN + """
select count(*) as n_transactions, round(avg(len(items)), 6) as avg_len, cast(max(len(items)) as bigint) as max_len,
       cast(min(len(items)) as bigint) as min_len from txn""")
def agg_txn_stats(spark, sf):
    return col.transaction_stats(transactions(spark, sf))


@query("agg_collection_stats", SQL_MEMBERS + """
, sz as (select collection_id, count(*) as n from members group by 1)
, ic as (select item_id, count(distinct collection_id) as n from members group by 1)
select (select count(*) from sz) as n_collections, (select count(*) from ic) as n_items,
       (select count(*) from members) as n_interactions,
       (select round(avg(rating), 6) from members) as mean_rating,
       (select round(stddev_samp(rating), 6) from members) as std_rating,
       (select round(avg(n), 6) from sz) as mean_length,
       (select count(*) from ic where n > 1) as items_in_many""")
def agg_collection_stats(spark, sf):
    m = members(spark, sf)
    sz = m.groupBy("collection_id").agg(F.count(F.lit(1)).alias("n"))
    ic = m.groupBy("item_id").agg(F.countDistinct("collection_id").alias("n"))
    base = m.agg(F.count(F.lit(1)).alias("n_interactions"), F.round(F.avg("rating"), 6).alias("mean_rating"),
                 F.round(F.stddev_samp("rating"), 6).alias("std_rating"))
    s1 = sz.agg(F.count(F.lit(1)).alias("n_collections"), F.round(F.avg("n"), 6).alias("mean_length"))
    s2 = ic.agg(F.count(F.lit(1)).alias("n_items"), F.count(F.when(F.col("n") > 1, 1)).alias("items_in_many"))
    return s1.select("n_collections", s2.select("n_items").scalar().alias("n_items"),
                     base.select("n_interactions").scalar().alias("n_interactions"),
                     base.select("mean_rating").scalar().alias("mean_rating"),
                     base.select("std_rating").scalar().alias("std_rating"), "mean_length",
                     s2.select("items_in_many").scalar().alias("items_in_many"))


@query("agg_item_freq", SQL_TXN + """
select item, count(*) as freq from (select unnest(items) as item from txn) group by 1""")
def agg_item_freq(spark, sf):
    return mn.item_frequency(transactions(spark, sf))


@query("job_freq_itemsets", SQL_TXN + sql_patterns(SQL_SUPPORT) + """
select array_to_string(items, '|') as items, cast(len(items) as int) as size, freq from patterns""")
def job_freq_itemsets(spark, sf):
    _, _, _, p = mined(spark, sf)
    return p.select(_txt(F.col("items")).alias("items"), F.size("items").alias("size"), "freq")


@query("job_adaptive_support", SQL_TXN + sql_patterns(SQL_SUPPORT) + f"""
select {SQL_SUPPORT} as support, (select count(*) from patterns) as n_patterns, 'in_window' as status,
       (select count(*) from txn) as n_transactions""")
def job_adaptive_support(spark, sf):
    txn, n, choice, pats = mined(spark, sf)
    return pats.agg(F.count(F.lit(1)).alias("n_patterns")).select(
        F.lit(choice.support).cast("bigint").alias("support"), "n_patterns",
        F.lit(choice.status).alias("status"), F.lit(n).cast("bigint").alias("n_transactions"))


@query("job_rules", SQL_TXN + sql_patterns(SQL_SUPPORT) + SQL_RULES + """
select array_to_string(r.ante, '|') as antecedent, array_to_string(r.cons, '|') as consequent,
       round(r.conf, 6) as confidence, r.sup as support,
       round(r.conf / (cast(c.freq as double) / (select n from nt)), 6) as lift
from rules r left join patterns c on array_to_string(c.items, '|') = array_to_string(r.cons, '|')""")
def job_rules(spark, sf):
    txn, n, choice, pats = mined(spark, sf)
    r, _ = rules_at_choice(pats, n)
    return r.select(_txt(F.col("antecedent")).alias("antecedent"), _txt(F.col("consequent")).alias("consequent"),
                    F.round("confidence", 6).alias("confidence"), "support", F.round("lift", 6).alias("lift"))


@query("job_top_patterns", SQL_TXN + sql_patterns(SQL_SUPPORT) + """
select array_to_string(items, '|') as items, freq from patterns order by freq desc, array_to_string(items, '|') limit 10""")
def job_top_patterns(spark, sf):
    txn, n, choice, pats = mined(spark, sf)
    p = pats.select(_txt(F.col("items")).alias("items"), "freq")
    return top_n(p, [F.desc("freq"), F.asc("items")], 10)


@query("job_top_rules", SQL_TXN + sql_patterns(SQL_SUPPORT) + SQL_RULES + """
select array_to_string(ante, '|') as antecedent, array_to_string(cons, '|') as consequent, round(conf, 6) as confidence
from rules order by conf desc, array_to_string(ante, '|'), array_to_string(cons, '|') limit 10""")
def job_top_rules(spark, sf):
    txn, n, choice, pats = mined(spark, sf)
    r, _ = rules_at_choice(pats, n)
    r = r.select(_txt(F.col("antecedent")).alias("antecedent"), _txt(F.col("consequent")).alias("consequent"),
                 "confidence")
    return top_n(r, [F.desc("confidence"), "antecedent", "consequent"], 10).select(
        "antecedent", "consequent", F.round("confidence", 6).alias("confidence"))


SQL_COOC = """
, cooc_raw as (select item1, item2, cast(sum(freq) as double) as weight from (
    select i1 as item1, i2 as item2, freq from p2 union all select i2, i1, freq from p2
    union all select i1, i2, freq from p3 union all select i2, i1, freq from p3
    union all select i1, i3, freq from p3 union all select i3, i1, freq from p3
    union all select i2, i3, freq from p3 union all select i3, i2, freq from p3) group by 1, 2)
, cooc_norm as (select item1, item2, weight / sum(weight) over (partition by item1) as weight from cooc_raw)
"""


@query("agg_cooc_patterns", SQL_TXN + sql_patterns(SQL_SUPPORT) + SQL_COOC + """
select item1, item2, round(weight, 6) as weight from cooc_raw""")
def agg_cooc_patterns(spark, sf):
    e = ed.cooccurrence_edges(mined(spark, sf)[3], normalize=False)
    return e.select("item1", "item2", F.round("weight", 6).alias("weight"))


@query("job_cooc_edges", SQL_TXN + sql_patterns(SQL_SUPPORT) + SQL_COOC + """
select item1, item2, round(weight, 6) as weight from cooc_norm""")
def job_cooc_edges(spark, sf):
    e = ed.cooccurrence_edges(mined(spark, sf)[3], normalize=True)
    return e.select("item1", "item2", F.round("weight", 6).alias("weight"))


SQL_POP = """
, pop_raw as (select item, cast(sum(freq) as double) as s from (select unnest(items) as item, freq from patterns) group by 1)
, pop as (select item, s / (select max(s) from pop_raw) as popularity from pop_raw)
"""


@query("agg_popularity", SQL_TXN + sql_patterns(SQL_SUPPORT) + SQL_POP + """
select item, round(popularity, 6) as popularity from pop""")
def agg_popularity(spark, sf):
    p = ed.popularity(mined(spark, sf)[3])
    return p.select("item", F.round("popularity", 6).alias("popularity"))


@query("job_popularity", SQL_TXN + sql_patterns(SQL_SUPPORT) + SQL_POP + """
select item, round(popularity, 6) as popularity from pop order by popularity desc, item limit 20""")
def job_popularity(spark, sf):
    p = ed.popularity(mined(spark, sf)[3])
    return top_n(p, [F.desc("popularity"), "item"], 20).select("item", F.round("popularity", 6).alias("popularity"))


SQL_SIM_RAW = """
, sim_raw as (select a.item_id item1, b.item_id item2, cast(count(*) as double) weight
        from members a join members b on a.collection_id = b.collection_id and a.item_id <> b.item_id group by 1, 2)
"""


@query("job_similarity_edges", SQL_MEMBERS + SQL_SIM_RAW + """
select item1, item2, weight as count, round(weight / sum(weight) over (partition by item1), 6) as weight from sim_raw""")
def job_similarity_edges(spark, sf):
    m = members(spark, sf)
    raw = ed.similarity_edges(m, normalize=False, assume_distinct=True).withColumnRenamed("weight", "count")
    norm = ed.row_normalize(raw.withColumn("weight", F.col("count")))
    return norm.select("item1", "item2", "count", F.round("weight", 6).alias("weight"))


@query("win_row_norm", SQL_MEMBERS + SQL_SIM_RAW + """
select item1, round(sum(w), 6) as row_sum, count(*) as n_edges from (
    select item1, weight / sum(weight) over (partition by item1) as w from sim_raw) group by 1""")
def win_row_norm(spark, sf):
    e = ed.similarity_edges(members(spark, sf), normalize=True, assume_distinct=True)
    return e.groupBy("item1").agg(F.round(F.sum("weight"), 6).alias("row_sum"), F.count(F.lit(1)).alias("n_edges"))


@query("jn_pairs", SQL_MEMBERS + """
select a.collection_id, a.item_id as item1, b.item_id as item2 from members a join members b
    on a.collection_id = b.collection_id and a.item_id <> b.item_id""")
def jn_pairs(spark, sf):
    return ed.basket_pairs(members(spark, sf), block_size=2)
