"""Queries: split, ranking metrics, annotation, diversity, and the CF baselines."""

from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..ml import bpr as BP
from ..ml import ease as EA
from ..ml import metrics as M
from ..ml import models as ML
from ..ml.data import triplets
from ..ml.split import exclude_unknown, ratio_split
from ..operators.relational import category_match
from ..operators.select import exact_sample
from ..operators.topn import top_n_per_group
from ..session import materialize
from .registry import query

K = 10

SQL_SPLIT = """
, trip as (select cast(user_id as varchar) as user_id, cast(parent_asin as varchar) as item_id,
        cast(rating as float) as value from fx_reviews where rating is not null)
, dd as (select user_id, item_id, max(value) as value from trip group by 1, 2)
, sp as (select *, case when cast(('0x' || substr(md5(concat('42|', user_id, '|', item_id)), 1, 8)) as bigint)
        / 4294967296.0 < 0.2 then 'test' else 'train' end as split from dd)
, tr as (select * from sp where split = 'train')
, te as (select * from sp where split = 'test' and user_id in (select user_id from tr)
        and item_id in (select item_id from tr))
, splitd as (select * from tr union all select * from te)
, items as (select distinct cast(parent_asin as varchar) as item_id, cat_2, cat_4 from fx_products)
, un as (select cast(c_custkey as varchar) as user_id, c_nationkey as nation, c_mktsegment as seg from customer)
"""


def sql_ranker(name, seg_col):
    return f"""
, {name}_pop as (select un.{seg_col} as seg, tr.item_id, count(*) as n from tr join un using (user_id) group by 1, 2)
, {name}_top as (select * from (select *, row_number() over (partition by seg order by n desc, item_id) as rank
        from {name}_pop) where rank <= {K})
, {name} as (select un.user_id, t.item_id, t.rank from un join {name}_top t on t.seg = un.{seg_col}
        where un.user_id in (select user_id from te))
"""


def sql_metrics(recs):
    return f"""
select count(*) as n_users, round(avg(f1), 6) as f1, round(avg(ndcg), 6) as ndcg, round(avg(recall), 6) as recall,
       round(avg(ncrr), 6) as ncrr from (
  select user_id, hits / n_rel as recall,
         case when hits > 0 then 2 * (hits / {K}.0) * (hits / n_rel) / ((hits / {K}.0) + (hits / n_rel)) else 0 end as f1,
         dcg / list_sum(list_transform(range(1, m + 1), lambda i: 1 / log2(i + 1))) as ndcg,
         crr / list_sum(list_transform(range(1, m + 1), lambda i: cast(1 as double) / i)) as ncrr
  from (select nrel.user_id, n_rel, least(n_rel, {K}) as m, coalesce(h.hits, 0) as hits, coalesce(h.dcg, 0) as dcg,
               coalesce(h.crr, 0) as crr
        from (select user_id, count(*) as n_rel from (select distinct user_id, item_id from te where value >= 4) group by 1) nrel
        left join (select r.user_id, count(*) as hits, sum(1 / log2(r.rank + 1)) as dcg, sum(cast(1 as double) / r.rank) as crr
                   from {recs} r join (select distinct user_id, item_id from te where value >= 4) rel using (user_id, item_id)
                   where r.rank <= {K} group by 1) h using (user_id)))"""


SQL_LABELS = """
, inter as (select tr.user_id, tr.item_id, items.cat_2, items.cat_4 from tr join items using (item_id))
, lab as (select r.user_id, r.item_id, r.rank, i.cat_2, i.cat_4,
        case when exists (select 1 from inter x where x.user_id = r.user_id and x.cat_4 = i.cat_4) then 'same_cat4'
             when exists (select 1 from inter x where x.user_id = r.user_id and x.cat_2 = i.cat_2) then 'same_cat2_diff_cat4'
             else 'diff_cat2' end as match
    from {recs} r left join items i using (item_id))
"""


def split(spark, sf):
    return ratio_split(triplets(fx.reviews(spark, sf), "mf"), 0.2, 42, exclude_unknowns=True)


def items_table(spark, sf):
    return fx.products(spark, sf).select(F.col("parent_asin").cast("string").alias("item_id"), "cat_2", "cat_4").distinct()


def segment_popular(spark, sf, sp, seg_col):
    """Popular-in-your-segment recommender (segment = nation or market segment)."""
    un = fx.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("user_id"),
                                                F.col(seg_col).alias("seg"))
    tr = sp.where("split = 'train'")
    te_users = sp.where("split = 'test'").select("user_id").distinct()
    pop = tr.join(un, "user_id").groupBy("seg", "item_id").agg(F.count(F.lit(1)).alias("n"))
    top = top_n_per_group(pop, ["seg"], [F.desc("n"), F.asc("item_id")], K, salt_cols=["item_id"])
    return un.join(te_users, "user_id", "left_semi").join(top, "seg").select("user_id", "item_id", "rank")


def relevant(sp, threshold=4.0):
    return sp.where((F.col("split") == "test") & (F.col("value") >= threshold)).select("user_id", "item_id")


@query("ml_split", SQL_SPLIT + "select user_id, item_id, value, split from splitd")
def ml_split(spark, sf):
    return split(spark, sf).select("user_id", "item_id", "value", "split")


@query("jn_exclude_unknown", SQL_SPLIT + """
select * from sp where split = 'test' and user_id in (select user_id from tr) and item_id in (select item_id from tr)""")
def jn_exclude_unknown(spark, sf):
    sp = ratio_split(triplets(fx.reviews(spark, sf), "mf"), 0.2, 42, exclude_unknowns=False)
    return exclude_unknown(sp.where("split = 'test'"), sp.where("split = 'train'"))


@query("ml_metrics", SQL_SPLIT + sql_ranker("nat", "nation") + sql_metrics("nat"))
def ml_metrics(spark, sf):
    sp = split(spark, sf)
    return M.ranking_metrics(segment_popular(spark, sf, sp, "c_nationkey"), relevant(sp), K)


@query("jn_topk_meta", SQL_SPLIT + sql_ranker("nat", "nation") + """
select r.user_id, cast(r.rank as int) as rank, r.item_id as parent_asin, i.cat_2, i.cat_4 from nat r left join items i using (item_id)""")
def jn_topk_meta(spark, sf):
    sp = split(spark, sf)
    r = segment_popular(spark, sf, sp, "c_nationkey")
    return (r.join(items_table(spark, sf), "item_id", "left")
            .select("user_id", F.col("rank").cast("int").alias("rank"), F.col("item_id").alias("parent_asin"), "cat_2", "cat_4"))


@query("ml_annotate", SQL_SPLIT + sql_ranker("nat", "nation") + """
select r.user_id, cast(r.rank as int) as rank, r.item_id as parent_asin, i.cat_2, i.cat_4 from nat r left join items i using (item_id)""")
def ml_annotate(spark, sf):
    """Wide top-k (one column per rank) -> long with 1-based rank -> item categories."""
    sp = split(spark, sf)
    r = segment_popular(spark, sf, sp, "c_nationkey")
    wide = r.groupBy("user_id").pivot("rank", list(range(1, K + 1))).agg(F.first("item_id"))
    long = (wide.unpivot("user_id", [str(i) for i in range(1, K + 1)], "rank", "item_id")
            .where(F.col("item_id").isNotNull()).withColumn("rank", F.col("rank").cast("int")))
    return (long.join(items_table(spark, sf), "item_id", "left")
            .select("user_id", "rank", F.col("item_id").alias("parent_asin"), "cat_2", "cat_4")
            .orderBy("user_id", "rank"))


def _labelled(spark, sf, seg_col="c_nationkey"):
    sp = split(spark, sf)
    items = items_table(spark, sf)
    recs = segment_popular(spark, sf, sp, seg_col).join(items, "item_id", "left")
    inter = sp.where("split = 'train'").join(items, "item_id")
    return sp, recs, inter


@query("jn_cat_match", SQL_SPLIT + sql_ranker("nat", "nation") + SQL_LABELS.format(recs="nat") + """
select user_id, item_id, cast(rank as int) as rank, match from lab""")
def jn_cat_match(spark, sf):
    sp, recs, inter = _labelled(spark, sf)
    return category_match(recs, inter).select("user_id", "item_id", F.col("rank").cast("int").alias("rank"), "match")


@query("ml_diversity", SQL_SPLIT + sql_ranker("nat", "nation") + SQL_LABELS.format(recs="nat") + """
select user_id, round(avg(cast(match = 'same_cat2_diff_cat4' as double)), 6) as rate,
       (select round(avg(cast(match = 'same_cat2_diff_cat4' as double)), 6) from lab) as overall_rate
from lab group by 1""")
def ml_diversity(spark, sf):
    sp, recs, inter = _labelled(spark, sf)
    overall, lab, per_user = M.diversity(recs, inter)
    return per_user.select("user_id", F.round("rate", 6).alias("rate"), F.round(overall, 6).alias("overall_rate"))


SQL_SUMMARY_PARTS = []
for _name, _col in (("nat", "nation"), ("seg", "seg")):
    SQL_SUMMARY_PARTS.append(sql_ranker(_name, _col) + SQL_LABELS.format(recs=_name).replace(", inter as", f", inter_{_name} as")
                             .replace(", lab as", f", lab_{_name} as").replace("from inter x", f"from inter_{_name} x"))


@query("ml_summary", SQL_SPLIT + "".join(SQL_SUMMARY_PARTS) + """
, m_nat as (""" + sql_metrics("nat") + """)
, m_seg as (""" + sql_metrics("seg") + """)
select 'nation_popular' as model, m.*, (select round(avg(cast(match = 'same_cat2_diff_cat4' as double)), 6) from lab_nat)
    as diversity_rate from m_nat m
union all
select 'segment_popular', m.*, (select round(avg(cast(match = 'same_cat2_diff_cat4' as double)), 6) from lab_seg)
    from m_seg m""")
def ml_summary(spark, sf):
    sp = split(spark, sf)
    items = items_table(spark, sf)
    inter = sp.where("split = 'train'").join(items, "item_id")
    out = None
    for name, col in (("nation_popular", "c_nationkey"), ("segment_popular", "c_mktsegment")):
        recs = segment_popular(spark, sf, sp, col)
        m = M.ranking_metrics(recs, relevant(sp), K)
        overall, _, _ = M.diversity(recs.join(items, "item_id", "left"), inter)
        row = m.select(F.lit(name).alias("model"), "*", F.round(overall, 6).alias("diversity_rate"))
        out = row if out is None else out.unionByName(row)
    return out


# ---- model baselines (no SQL form: rows-only checks) ----------------------------
# The reference's iterations, its cut of the metrics, and the middle of the ranges it tunes in (geometric where it
# draws in logs; alpha = a / b - 1 of its confidences).
TOP = 50
MF = {"rank": 105, "reg": 0.01, "max_iter": 100}
WMF = {"rank": 150, "reg": 0.01, "max_iter": 50, "alpha": 3161.0}
EASE = {"lam": 100.0}
BPR = {"k": 150, "lr": 0.007, "reg": 0.01, "epochs": 500}
#: A test row is relevant from this value on: ratings of 4, and 0.5 for the other models' labels.
RELEVANT = {"mf": 4.0, "wmf": 0.5, "bpr": 0.5, "ease": 0.5}


def model_split(spark, sf, model):
    """The model's own interactions, split 4 to 1."""
    return materialize(ratio_split(triplets(fx.reviews(spark, sf), model), 0.2, 42), spark, f"split-{model}")


def _model_metrics(name, topk, sp, k=TOP):
    m = M.ranking_metrics(topk, relevant(sp, RELEVANT[name]), k)
    return m.select(F.lit(name).alias("model"), "*")


def _eval_users(sp):
    return sp.where("split = 'test'").select("user_id").distinct()


@query("ml_mf")
def ml_mf(spark, sf):
    sp = model_split(spark, sf, "mf")
    top = ML.als_topk(sp.where("split = 'train'"), _eval_users(sp), TOP, implicit=False, exclude_seen=True, **MF)
    return _model_metrics("mf", top, sp)


@query("ml_mf_offsets", SQL_SPLIT + """
, mu as (select avg(cast(value as double)) as mean from tr)
, bi as (select item_id, avg(cast(value as double)) - any_value(mean) as b_i from tr, mu group by 1)
, bu as (select user_id, avg(cast(value as double) - mean - b_i) as b_u from tr join bi using (item_id), mu group by 1)
select user_id, item_id, round(cast(value as double) - mean - b_i - b_u, 6) + 0.0 as rest from tr join bi using (item_id) join bu using (user_id), mu""")
def ml_mf_offsets(spark, sf):
    """What mean, item and user biases leave of every training rating: the values MF's factors are fitted to."""
    tr = split(spark, sf).where("split = 'train'").withColumn("value", F.col("value").cast("double"))
    mean, b_i, b_u = ML.offsets(tr)
    rest = F.col("value") - F.lit(mean) - F.col("b_i") - F.col("b_u")
    return tr.join(b_i, "item_id").join(b_u, "user_id").select("user_id", "item_id", (F.round(rest, 6) + 0.0).alias("rest"))


@query("ml_wmf")
def ml_wmf(spark, sf):
    sp = model_split(spark, sf, "wmf")
    top = ML.als_topk(sp.where("split = 'train'"), _eval_users(sp), TOP, implicit=True, exclude_seen=True, **WMF)
    return _model_metrics("wmf", top, sp)


@query("ml_ease")
def ml_ease(spark, sf):
    sp = model_split(spark, sf, "ease")
    return _model_metrics("ease", EA.topk(sp.where("split = 'train'"), _eval_users(sp), TOP, **EASE), sp)


SQL_EASE_TRAIN = """
, tr_e as (select * from (
    select user_id, item_id, value, case when cast(('0x' || substr(md5(concat('42|', user_id, '|', item_id)), 1, 8)) as bigint)
        / 4294967296.0 < 0.2 then 'test' else 'train' end as split
    from (select user_id, item_id, max(value) as value from (
        select cast(user_id as varchar) as user_id, cast(parent_asin as varchar) as item_id,
               cast((coalesce(cast(verified_purchase as int), 0) = 1 or coalesce(helpful_vote, 0) > 0) as float) as value
        from fx_reviews) group by 1, 2)) where split = 'train')"""


@query("ml_ease_normal", SQL_EASE_TRAIN + """
, x as (select distinct user_id, item_id from tr_e where value > 0)
, g as (select a.item_id as item1, b.item_id as item2, cast(count(*) as double) as g
        from x a join x b on a.user_id = b.user_id and a.item_id <> b.item_id group by 1, 2)
select item2 as item_id, count(*) as pairs, sum(g) as g_sum, sum(g * g) as g_squares from g group by 1""")
def ml_ease_normal(spark, sf):
    """The solved weights against their definition: off the diagonal (G + lam I) B is the Gram matrix G.

    Every entry of the product is rounded to 3 places; per item, the number, sum
    and sum of squares of those that are not 0 must be G's own.
    """
    sp = ratio_split(triplets(fx.reviews(spark, sf), "ease"), 0.2, 42, exclude_unknowns=False)
    return EA.normal_digest(sp.where("split = 'train'"), **EASE)


@query("ml_ease_gram", SQL_EASE_TRAIN + """
, x as (select distinct t.user_id, t.item_id, concat(i.cat_2, '#0') as block from tr_e t
        join (select distinct cast(parent_asin as varchar) as item_id, cat_2 from fx_products where cat_2 is not null) i
        using (item_id) where t.value > 0)
select a.block, a.item_id as item1, b.item_id as item2, cast(count(*) as double) as g
from x a join x b on a.user_id = b.user_id and a.block = b.block and a.item_id <> b.item_id group by 1, 2, 3
union all select block, item_id, item_id, cast(count(*) as double) from x group by 1, 2, 3""")
def ml_ease_gram(spark, sf):
    """The Gram step of EASE (per item block), which has an exact SQL form."""
    sp = ratio_split(triplets(fx.reviews(spark, sf), "ease"), 0.2, 42, exclude_unknowns=False)
    tr = sp.where("split = 'train'")
    blocks = items_table(spark, sf).select("item_id", F.col("cat_2").alias("block"))
    return ML.ease_gram(tr, blocks)


@query("ml_bpr")
def ml_bpr(spark, sf):
    sp = model_split(spark, sf, "bpr")
    tr = sp.where("split = 'train'")
    uf, vf = BP.fit(tr, **BPR)
    return _model_metrics("bpr", ML.factor_topk(uf, vf, _eval_users(sp), TOP, train=tr), sp)


@query("ml_topk")
def ml_topk(spark, sf):
    """Top-k for 100 sampled users from the explicit model; seen items are kept (as the reference)."""
    sp = split(spark, sf).cache()
    tr = sp.where("split = 'train'")
    users = exact_sample(tr.select("user_id").distinct(), 100, ["user_id"], seed=7)
    top = ML.als_topk(tr, users, K, implicit=False, **MF)
    return top.select("user_id", F.col("rank").cast("int").alias("rank"), "item_id")


DIMS = 8


def _hash_factor(id_, d, part):
    """A number in [0, 1) from md5 of ``part|id|d``, in either engine."""
    h = F.md5(F.concat(F.lit(f"{part}|"), F.col(id_).cast("string"), F.lit(f"|{d}")))
    return F.conv(F.substring(h, 1, 6), 16, 10).cast("bigint") / F.lit(16777216.0)


def _sql_factor(id_, d, part):
    return f"cast(('0x' || substr(md5(concat('{part}|', cast({id_} as varchar), '|{d}')), 1, 6)) as bigint) / 16777216.0"


@query("ml_topk_factors", f"""
, uf as (select cast(c_custkey as varchar) as user_id, [{", ".join(f"cast({_sql_factor('c_custkey', d, 'u')} - 0.5 as double)" for d in range(DIMS))}] as f
    from customer)
, vf as (select cast(p_partkey as varchar) as item_id, [{", ".join(f"cast(({_sql_factor('p_partkey', d, 'i')} - 0.5) / (0.02 + {_sql_factor('p_partkey', DIMS, 'i')}) as double)" for d in range(DIMS))}] as f
    from part)
, seen as (select distinct cast(user_id as varchar) as user_id, cast(parent_asin as varchar) as item_id from fx_reviews)
, sc as (select user_id, item_id, list_inner_product(uf.f, vf.f) as score from uf, vf)
select user_id, item_id, cast(rank as int) as rank, round(score, 6) as score from (
  select *, row_number() over (partition by user_id order by round(score, 9) desc, item_id) as rank
  from sc anti join seen using (user_id, item_id)) where rank <= {K}""")
def ml_topk_factors(spark, sf):
    """Factor scoring itself: every customer's best unseen parts by inner product of hashed factors with norms of many sizes."""
    u = fx.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("user_id"),
                                               F.array(*[_hash_factor("c_custkey", d, "u") - 0.5 for d in range(DIMS)]).alias("f"))
    v = fx.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("item_id"), F.array(
        *[(_hash_factor("p_partkey", d, "i") - 0.5) / (0.02 + _hash_factor("p_partkey", DIMS, "i")) for d in range(DIMS)]).alias("f"))
    seen = fx.reviews(spark, sf).select(F.col("user_id").cast("string").alias("user_id"), F.col("parent_asin").cast("string").alias("item_id"))
    top = ML.factor_topk(u, v, u, K, train=seen)
    return top.select("user_id", "item_id", F.col("rank").cast("int").alias("rank"), F.round("score", 6).alias("score"))


# The reference's ranges: whole numbers, "log" or plain.
SEARCH_SPACE = {
    "mf": {"rank": (10, 200, "int"), "reg": (0.001, 0.1, "log")},
    "bpr": {"k": (100, 200, "int"), "lr": (0.001, 0.05, "log"), "reg": (0.001, 0.1, "log")},
    "wmf": {"rank": (50, 250, "int"), "reg": (0.001, 0.1, "log"), "a": (1.0, 10.0, "plain"), "b": (0.0001, 0.01, "log")},
    "ease": {"lam": (10.0, 1000.0, "log")},
}


def draw(space, rnd):
    p = {}
    for name, (low, high, how) in space.items():
        p[name] = rnd.randint(low, high) if how == "int" else \
            math.exp(rnd.uniform(math.log(low), math.log(high))) if how == "log" else rnd.uniform(low, high)
    if "a" in p:
        p["alpha"] = p.pop("a") / p.pop("b") - 1
    return p


@query("ml_search")
def ml_search(spark, sf, trials: int = 15, seed: int = 42, k: int = TOP, models=tuple(SEARCH_SPACE),
              iterations: int | None = None):
    """Seeded random search over each model's settings maximising F1@k; one row per model and trial.

    ``iterations`` replaces the models' own (MF 100, WMF 50, BPR 500)."""
    sp = split(spark, sf).cache()
    users = _eval_users(sp).cache()
    out = None
    for model in models:
        tr = ratio_split(triplets(fx.reviews(spark, sf), model), 0.2, 42).where("split = 'train'")
        tr = ML.Coded(tr) if model in ("mf", "wmf") else tr.cache()
        rnd = random.Random(f"{seed}|{model}")
        rounds = {"mf": MF.get("max_iter"), "wmf": WMF.get("max_iter"), "bpr": BPR.get("epochs"), "ease": None}[model]
        rounds = iterations or rounds if rounds else None
        for t in range(trials):
            p = draw(SEARCH_SPACE[model], rnd)
            if model == "ease":
                top = EA.topk(tr, users, k, **p)
            elif model == "bpr":
                top = ML.factor_topk(*BP.fit(tr, epochs=rounds, **p), users, k, train=tr)
            else:
                top = ML.als_topk(tr, users, k, implicit=model == "wmf", max_iter=rounds, exclude_seen=True, **p)
            m = M.ranking_metrics(top, relevant(sp), k)
            row = m.select(F.lit(model).alias("model"), F.lit(t).alias("trial"), F.lit(p.get("rank", p.get("k"))).cast("int").alias("rank"),
                           F.lit(p.get("reg", p.get("lam"))).cast("double").alias("reg"), F.lit(p.get("alpha")).cast("double").alias("alpha"),
                           F.lit(rounds).cast("int").alias("max_iter"), "*")
            row = materialize(row, spark, f"search-{model}-{t}")  # a trial's plan ends here
            out = row if out is None else out.unionByName(row)
    return out
