"""Queries: recommendation strategies, both cascades, basket joins, metadata lookups.

Baskets come from the collections themselves: every collection's first item
(hold-one-in), or its first two items, so the whole collection table is
scored in one job.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import collections as col
from ..operators import edges as ed
from ..operators import mining as mn
from ..operators import recommend as rec
from ..operators import store
from ..operators.topn import top_n_per_group
from ..session import materialize, scratch_path_of
from .q_mining import SQL_COOC, SQL_POP, SQL_RULES, SQL_SUPPORT, SQL_TXN, _txt, rules_at_choice, sql_patterns
from .q_recommend import SQL_SIM, first_item_baskets, members
from .registry import query

N_CASCADE = 10

# ---- Spark side -----------------------------------------------------------------


def two_item_baskets(m):
    r = top_n_per_group(m, ["collection_id"], [F.asc("order_key"), F.asc("item_id")], 2)
    return r.select(F.col("collection_id").alias("basket_id"), "item_id")


class Model:
    """Tables shared by the strategies of one query; each is built when first asked for."""

    def __init__(self, spark, sf):
        self.members = members(spark, sf).cache()
        self._memo = {}

    def _keep(self, key, build):
        """Edge tables are read by several strategies: build each once and cache it."""
        if key not in self._memo:
            self._memo[key] = build().cache()
        return self._memo[key]

    @property
    def catalog(self):
        return self._keep("catalog", lambda: self.members.select("item_id").distinct())

    @property
    def txn(self):
        return self._keep("txn", lambda: col.transactions(self.members))

    @property
    def patterns(self):
        return self._keep("patterns", lambda: mn.adaptive_support(self.txn).itemsets)

    @property
    def rules(self):
        return self._keep("rules", lambda: mn.one_per_antecedent(rules_at_choice(self.patterns, self.txn.count())[0]))

    def sim(self, normalize):
        return self._keep(("sim", normalize),
                          lambda: ed.similarity_edges(self.members, normalize=normalize, assume_distinct=True))

    def cooc(self, normalize):
        return self._keep(("cooc", normalize), lambda: ed.cooccurrence_edges(self.patterns, normalize=normalize))

    def ranked_pop(self):
        return self._keep("pop", lambda: ed.rank_popularity(ed.popularity(self.patterns)))


def collection_cascade(md, baskets, n=N_CASCADE):
    return rec.per_distinct_basket(_collection_cascade, baskets, md, n)


def item_cascade(md, baskets, n=N_CASCADE):
    return rec.per_distinct_basket(_item_cascade, baskets, md, n)


def _collection_cascade(baskets, md, n=N_CASCADE):
    return rec.cascade([
        rec.Strategy("rules", 1.0, rec.by_rules(baskets, md.rules, md.catalog, n)),
        rec.Strategy("co-occurrence", 0.8, rec.by_edges(baskets, md.cooc(False), md.catalog, n)),
        rec.Strategy("collection_similarity", 0.6, rec.by_edges(baskets, md.sim(False), md.catalog, n)),
        rec.Strategy("popular", 0.4, rec.by_popular_same_collections(baskets, md.members, n)),
    ], n)


def _item_cascade(baskets, md, n=N_CASCADE):
    known = rec.known_items(baskets, md.catalog)
    return rec.cascade([
        rec.Strategy("association_rules", 1.0, rec.by_rules(known, md.rules, md.catalog, n)),
        rec.Strategy("item_similarity", 0.8, rec.by_edges(known, md.sim(True), md.catalog, n)),
        rec.Strategy("co_occurrence", 0.6, rec.by_edges(known, md.cooc(True), md.catalog, n)),
        rec.Strategy("popularity", 0.4, rec.by_popularity(known, md.ranked_pop(), md.catalog, n)),
    ], n)


def _out(df):
    return df.select("basket_id", "item_id", F.col("rank").cast("int").alias("rank"),
                     F.round("score", 6).alias("score"))


def _cascade_out(df):
    return df.select("basket_id", "item_id", F.col("rank").cast("int").alias("rank"),
                     F.round("recommendation_score", 6).alias("recommendation_score"), "recommendation_method")


# ---- SQL side -------------------------------------------------------------------
BASE = SQL_TXN + sql_patterns(SQL_SUPPORT) + SQL_RULES + SQL_COOC + SQL_POP + SQL_SIM + """
, sim_cnt as (select item1, item2, weight from sim_raw)
"""

SQL_B1 = """
, baskets as (select collection_id as basket_id, item_id from (select *, row_number() over (
        partition by collection_id order by order_key, item_id) r from members) where r = 1)
"""
SQL_B2 = """
, baskets as (select collection_id as basket_id, item_id from (select *, row_number() over (
        partition by collection_id order by order_key, item_id) r from members) where r <= 2)
"""

SQL_KNOWN = """
, known as (select distinct basket_id, item_id from baskets where item_id in (select item_id from members))
, nk as (select basket_id, count(*) as k from known group by 1)
, bi as (select distinct basket_id, item_id from baskets where item_id is not null)
"""


def _rank(name, scored, n):
    return f"""
, {name} as (select * from (select basket_id, item_id, score, row_number() over (partition by basket_id
        order by round(score, 9) desc, item_id) as rank from ({scored})) where rank <= {n})"""


def sql_rules_strategy(name, n):
    return f"""
, rl as (select row_number() over () as rid, ante, cons, conf from rules1)
, ante_x as (select rid, unnest(ante) as item_id, len(ante) as asz from rl)
, ov as (select k.basket_id, a.rid, count(*) as overlap, any_value(a.asz) as asz from known k join ante_x a
        using (item_id) group by 1, 2)
, votes as (select ov.basket_id, unnest(rl.cons) as item_id, rl.conf * ov.overlap / ov.asz as w from ov join rl using (rid))
""" + _rank(name, """select basket_id, item_id, sum(w) as score from votes v where not exists (select 1 from known k
        where k.basket_id = v.basket_id and k.item_id = v.item_id) group by 1, 2""", n)


def sql_edge_strategy(name, edges, n):
    return _rank(name, f"""select k.basket_id, e.item2 as item_id, sum(e.weight) / any_value(nk.k) as score
        from known k join {edges} e on k.item_id = e.item1 join nk on nk.basket_id = k.basket_id
        where not exists (select 1 from known o where o.basket_id = k.basket_id and o.item_id = e.item2)
        group by 1, 2""", n)


def sql_popular_same(name, n):
    return """
, shared as (select distinct bi.basket_id, m.collection_id from bi join members m using (item_id))
""" + _rank(name, """select s.basket_id, m.item_id, cast(count(*) as double) as score from shared s
        join members m using (collection_id) where not exists (select 1 from bi where bi.basket_id = s.basket_id
        and bi.item_id = m.item_id) group by 1, 2""", n)


def sql_popularity(name, n):
    return f"""
, pr as (select item, popularity, row_number() over (order by popularity desc, item) as pop_rank from pop)
, {name} as (select basket_id, item_id, score, rank from (select b.basket_id, pr.item as item_id, pr.popularity as score,
        row_number() over (partition by b.basket_id order by pr.pop_rank) as rank
        from (select distinct basket_id from known) b cross join pr
        where not exists (select 1 from known k where k.basket_id = b.basket_id and k.item_id = pr.item))
        where rank <= {n})"""


def sql_cascade(parts, n):
    u = " union all ".join(
        f"select basket_id, item_id, score * cast({w} as double) as rs, '{m}' as method, {p} as prio, rank as r from {t}"
        for p, (t, w, m) in enumerate(parts))
    return f"""
, u as ({u})
, d as (select * from (select *, row_number() over (partition by basket_id, item_id order by prio, r) as x from u) where x = 1)
, kept as (select * from (select *, row_number() over (partition by basket_id order by prio, r) as y from d) where y <= {n})
select basket_id, item_id, cast(row_number() over (partition by basket_id order by round(rs, 9) desc, prio, r) as int) as rank,
       round(rs, 6) as recommendation_score, method as recommendation_method from kept"""


def _sel_rank(t):
    return f"select basket_id, item_id, cast(rank as int) as rank, round(score, 6) as score from {t}"


# ---- strategies ---------------------------------------------------------------
@query("rec_rules", BASE + SQL_B2 + SQL_KNOWN + sql_rules_strategy("s", 5) + _sel_rank("s"))
def rec_rules(spark, sf):
    md = Model(spark, sf)
    return _out(rec.per_distinct_basket(rec.by_rules, two_item_baskets(md.members), md.rules, md.catalog, 5))


@query("rec_cooc", BASE + SQL_B2 + SQL_KNOWN + sql_edge_strategy("s", "cooc_raw", 5) + _sel_rank("s"))
def rec_cooc(spark, sf):
    md = Model(spark, sf)
    return _out(rec.per_distinct_basket(rec.by_edges, two_item_baskets(md.members), md.cooc(False), md.catalog, 5))


@query("rec_popular_same", BASE + SQL_B2 + SQL_KNOWN + sql_popular_same("s", 5) + _sel_rank("s"))
def rec_popular_same(spark, sf):
    md = Model(spark, sf)
    return _out(rec.per_distinct_basket(rec.by_popular_same_collections, two_item_baskets(md.members),
                                        md.members, 5))


@query("rec_popular", BASE + SQL_B2 + SQL_KNOWN + sql_popularity("s", 5) + _sel_rank("s"))
def rec_popular(spark, sf):
    md = Model(spark, sf)
    return _out(rec.per_distinct_basket(rec.by_popularity, two_item_baskets(md.members), md.ranked_pop(), md.catalog, 5))


COLLECTION_PARTS = [("s1", 1.0, "rules"), ("s2", 0.8, "co-occurrence"), ("s3", 0.6, "collection_similarity"),
                    ("s4", 0.4, "popular")]
ITEM_PARTS = [("s1", 1.0, "association_rules"), ("s2", 0.8, "item_similarity"), ("s3", 0.6, "co_occurrence"),
              ("s4", 0.4, "popularity")]


def sql_collection_cascade(n):
    return (sql_rules_strategy("s1", n) + sql_edge_strategy("s2", "cooc_raw", n)
            + sql_edge_strategy("s3", "sim_cnt", n) + sql_popular_same("s4", n) + sql_cascade(COLLECTION_PARTS, n))


def sql_item_cascade(n):
    return (sql_rules_strategy("s1", n) + sql_edge_strategy("s2", "sim", n)
            + sql_edge_strategy("s3", "cooc_norm", n) + sql_popularity("s4", n) + sql_cascade(ITEM_PARTS, n))


@query("rec_cascade_collection", BASE + SQL_B1 + SQL_KNOWN + sql_collection_cascade(N_CASCADE))
def rec_cascade_collection(spark, sf):
    md = Model(spark, sf)
    return _cascade_out(collection_cascade(md, first_item_baskets(md.members)))


@query("rec_cascade_item", BASE + SQL_B1 + SQL_KNOWN + sql_item_cascade(N_CASCADE))
def rec_cascade_item(spark, sf):
    md = Model(spark, sf)
    return _cascade_out(item_cascade(md, first_item_baskets(md.members)))


SQL_IMAGES_TABLE = """
, images as (select title as asin, concat(image_url, '?v=', cast(parent_asin % 3 as varchar)) as hi_res_url from fx_products)
"""

SQL_SERVED = """
, meta as (select title as item_id, price, title, concat_ws(' ', cat_1, cat_2) as description,
        case when cat_1 is not null and cat_1 <> '' then concat(cat_1, ' > ', coalesce(cat_2, '')) end as category, image_url
        from (select *, row_number() over (partition by title order by parent_asin) r from fx_products where title is not null) where r = 1)
, img as (select asin as item_id, min(hi_res_url) as hi_res_url from images where asin is not null group by 1)
select res.*, meta.price, meta.title, meta.description, meta.category, coalesce(img.hi_res_url, meta.image_url) as image_url
from res left join meta using (item_id) left join img using (item_id)"""


def images_table(spark, sf):
    p = fx.products(spark, sf)
    return p.select(F.col("title").alias("asin"),
                    F.concat("image_url", F.lit("?v="), (F.col("parent_asin") % 3).cast("string")).alias("hi_res_url"))


def described(spark, sf):
    return fx.products(spark, sf).withColumn("description_clean", F.concat_ws(" ", "cat_1", "cat_2"))


def kept_recommender(spark, sf):
    """The recommender of these input files: fitted when first asked for, read from its tables afterwards."""
    path = scratch_path_of(spark, "recommender", [f"{sf}/{t}.parquet" for t in ("lineitem", "part")])
    if not store.versions(spark, path):
        store.fit(spark, members(spark, sf), described(spark, sf), path, images_table(spark, sf))
    return store.Kept(spark, path)


def _as_res(cascade_sql):
    return cascade_sql.replace("select basket_id, item_id, cast(row_number()", ", res as (select basket_id, item_id, cast(row_number()") + ")"


def _served(df):
    return df.withColumn("recommendation_score", F.round("recommendation_score", 6))


@query("rec_entry", BASE + SQL_B2 + SQL_KNOWN + _as_res(sql_item_cascade(5)) + SQL_IMAGES_TABLE + SQL_SERVED)
def rec_entry(spark, sf):
    """``get_item_recommendations(items, 5)`` for every two-item basket at once, from the kept recommender:
    joins with its tables, no mining; score, method, price, title, description, category and image per row."""
    return _served(kept_recommender(spark, sf).recommend(two_item_baskets(members(spark, sf)), 5))


@query("rec_probe", BASE + """
, first5 as (select collection_id from members group by 1 having count(*) >= 2 order by collection_id limit 5)
, baskets as (select collection_id as basket_id, item_id from (select *, row_number() over (
        partition by collection_id order by order_key, item_id) r from members
        where collection_id in (select collection_id from first5)) where r = 1)
""" + SQL_KNOWN + sql_item_cascade(5).replace(
    "select basket_id, item_id, cast(row_number()",
    ", res as (select basket_id, item_id, cast(row_number()") + """)
select * from res where basket_id = (select min(basket_id) from res)""")
def rec_probe(spark, sf):
    """Smoke probe: the first five collections' first items, the first basket with results."""
    md = Model(spark, sf)
    first5 = (md.members.groupBy("collection_id").count().where("count >= 2")
              .orderBy("collection_id").limit(5).select("collection_id"))
    b = first_item_baskets(md.members.join(first5, "collection_id", "left_semi"))
    res = _cascade_out(item_cascade(md, b, 5)).cache()  # at most 5 baskets x 5 rows
    return res.join(res.agg(F.min("basket_id").alias("basket_id")), "basket_id")


# ---- basket joins ---------------------------------------------------------------
@query("jn_basket_rules", BASE + SQL_B2 + SQL_KNOWN + """
, rl as (select ante, cons, conf from rules1)
select k.basket_id, array_to_string(rl.ante, '|') as antecedent, array_to_string(rl.cons, '|') as consequent,
       count(*) as overlap, cast(len(any_value(rl.ante)) as int) as ante_size
from known k join (select ante, cons, unnest(ante) as item_id from rl) rl using (item_id) group by 1, 2, 3""")
def jn_basket_rules(spark, sf):
    md = Model(spark, sf)
    known = rec.known_items(two_item_baskets(md.members), md.catalog)
    r = md.rules.select(_txt(F.col("antecedent")).alias("antecedent"), _txt(F.col("consequent")).alias("consequent"),
                        F.size("antecedent").alias("ante_size"), F.explode("antecedent").alias("item_id"))
    return (known.join(r, "item_id").groupBy("basket_id", "antecedent", "consequent")
            .agg(F.count(F.lit(1)).alias("overlap"), F.first("ante_size").alias("ante_size")))


@query("jn_basket_edges", BASE + SQL_B2 + SQL_KNOWN + """
select k.basket_id, e.item1, e.item2 as item_id, round(e.weight, 6) as weight from known k join sim e on k.item_id = e.item1
where not exists (select 1 from known o where o.basket_id = k.basket_id and o.item_id = e.item2)""")
def jn_basket_edges(spark, sf):
    """Each basket carries its (at most two) items to the edges, so the edge rows are told from its own where they arise."""
    md = Model(spark, sf)
    known = rec.known_items(two_item_baskets(md.members), md.catalog)
    own = known.groupBy("basket_id").agg(F.collect_set("item_id").alias("own"))
    e = materialize(md.sim(True), spark, "basket-edges")  # of known size from here on
    return (own.select("basket_id", "own", F.explode("own").alias("item1")).join(e, "item1")
            .where(~F.array_contains("own", F.col("item2")))
            .select("basket_id", "item1", F.col("item2").alias("item_id"), F.round("weight", 6).alias("weight")))


@query("jn_same_collections", BASE + SQL_B2 + SQL_KNOWN + """
select basket_id, count(*) as n_shared, min(collection_id) as first_shared, max(collection_id) as last_shared
from (select distinct bi.basket_id, m.collection_id from bi join members m using (item_id)) group by 1""")
def jn_same_collections(spark, sf):
    """Collections sharing an item with each basket (summarised per basket)."""
    md = Model(spark, sf)
    return rec.per_distinct_basket(rec.shared_collections, two_item_baskets(md.members), md.members, md.sim(False))


@query("jn_meta_lookup", BASE + SQL_IMAGES_TABLE + """
, items as (select distinct item_id from members)
, meta as (select title as item_id, price, case when cat_1 is not null and cat_1 <> '' then concat(cat_1, ' > ',
        coalesce(cat_2, '')) end as category from (select *, row_number() over (partition by title order by parent_asin) r
        from fx_products where title is not null) where r = 1)
, img as (select asin as item_id, hi_res_url from (select *, row_number() over (partition by asin order by hi_res_url) r
        from images where asin is not null) where r = 1)
select i.item_id, meta.price, meta.category, img.hi_res_url as image_url from items i left join meta using (item_id)
left join img using (item_id)""")
def jn_meta_lookup(spark, sf):
    m = members(spark, sf).select("item_id").distinct()
    out = rec.enrich(m, fx.products(spark, sf).drop("image_url"), images_table(spark, sf))
    return out.select("item_id", "price", "category", "image_url")


@query("set_except", SQL_TXN + """
, cat as materialized (select distinct item_id from members)
, req as materialized (select l_orderkey as basket_id, p_name as item_id from lineitem join part on l_partkey = p_partkey
          union select l_orderkey, p_brand from lineitem join part on l_partkey = p_partkey where l_linenumber = 1)
, known as materialized (select distinct basket_id from req semi join cat using (item_id))
select basket_id, item_id from req anti join cat using (item_id) semi join known using (basket_id)""")
def set_except(spark, sf):
    """Requested minus known items per basket; baskets with no known item return nothing."""
    li = fx.table(spark, sf, "lineitem")
    pt = fx.table(spark, sf, "part")
    j = li.join(pt, li.l_partkey == pt.p_partkey)
    req = (j.select(F.col("l_orderkey").alias("basket_id"), F.col("p_name").alias("item_id"))
           .unionByName(j.where("l_linenumber = 1").select(F.col("l_orderkey").alias("basket_id"),
                                                           F.col("p_brand").alias("item_id"))).distinct())
    catalog = members(spark, sf).select("item_id").distinct()
    known = req.join(catalog, "item_id", "left_semi")
    missing = req.join(catalog, "item_id", "left_anti")
    return missing.join(known.select("basket_id").distinct(), "basket_id", "left_semi")
