"""Complementary-item recommendation for whole tables of baskets.

A basket table is long: ``(basket_id, item_id)``.  Every strategy returns
``(basket_id, item_id, score, rank)`` with at most ``n`` rows per basket,
ranked by score desc then item id asc.  The cascades merge the strategies
the way the sequential fill does: each strategy list is cut to ``n`` first,
items already given by an earlier strategy are skipped, the first ``n`` by
(priority, in-strategy rank) are kept and finally ordered by weighted score.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .edges import basket_pairs
from .topn import top_n_per_group

B, I = "basket_id", "item_id"


# Scores are sums of doubles; the order uses them rounded to 9 places so that
# mathematically equal scores tie (and fall back to item id) on every engine.
SCORE_ORDER_DIGITS = 9


def _rank(scored: DataFrame, n: int) -> DataFrame:
    return top_n_per_group(scored, [B], [F.desc(F.round("score", SCORE_ORDER_DIGITS)), F.asc(I)], n,
                           salt_cols=[I])


def known_items(baskets: DataFrame, catalog: DataFrame) -> DataFrame:
    """Distinct basket items that occur in the catalog (``item_id`` column)."""
    return (baskets.select(B, I).where(F.col(I).isNotNull()).distinct()
            .join(catalog.select(I).distinct(), I, "left_semi"))


def _edge_scores(known: DataFrame, edges: DataFrame, divide: bool = True) -> DataFrame:
    n_known = known.groupBy(B).agg(F.count(F.lit(1)).alias("__k"))
    hits = (known.join(edges, known[I] == edges["item1"])
            .select(B, F.col("item2").alias(I), "weight"))
    owned = known.select(B, I)
    s = (hits.join(owned, [B, I], "left_anti")
         .groupBy(B, I).agg(F.sum("weight").alias("score")))
    if divide:
        s = s.join(n_known, B).withColumn("score", F.col("score") / F.col("__k")).drop("__k")
    return s


def by_edges(baskets: DataFrame, edges: DataFrame, catalog: DataFrame, n: int = 5) -> DataFrame:
    """Sum of edge weights from the known basket items, divided by their number."""
    known = known_items(baskets, catalog)
    return _rank(_edge_scores(known, edges), n)


def rule_tables(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rule_id, item_id)`` of the antecedents, ``(rule_id, consequent, confidence, ante_size)``."""
    # a name that a recomputed row keeps: the rule itself
    r = rules.withColumn("rule_id", F.concat_ws("\u0002", F.array_join("antecedent", "\u0001"), F.array_join("consequent", "\u0001")))
    return (r.select("rule_id", F.explode("antecedent").alias(I)),
            r.select("rule_id", "consequent", "confidence", F.size("antecedent").alias("ante_size")))


def by_rules(baskets: DataFrame, rules: DataFrame, catalog: DataFrame, n: int = 5) -> DataFrame:
    """Rules whose antecedent overlaps the basket vote for their consequent items
    with ``confidence * overlap / |antecedent|``; owned items are excluded."""
    return by_rule_tables(known_items(baskets, catalog), *rule_tables(rules), n)


def by_rule_tables(known: DataFrame, ante: DataFrame, rules: DataFrame, n: int = 5) -> DataFrame:
    """``by_rules`` over the tables that ``rule_tables`` makes, for items known to be in the catalog."""
    overlap = (known.join(ante, I).groupBy(B, "rule_id")
               .agg(F.count(F.lit(1)).alias("overlap")))
    votes = (overlap.join(rules, "rule_id")
             .select(B, F.explode("consequent").alias(I),
                     (F.col("confidence") * F.col("overlap") / F.col("ante_size")).alias("w")))
    s = (votes.join(known.select(B, I), [B, I], "left_anti")
         .groupBy(B, I).agg(F.sum("w").alias("score")))
    return _rank(s, n)


def fold_collections(members: DataFrame, collection_col: str = "collection_id") -> DataFrame:
    """``collection_id, item_id, times``: equal collections once, with the number of them."""
    m = members.select(F.col(collection_col).alias(B), I).where(F.col(B).isNotNull() & F.col(I).isNotNull()).distinct()
    kinds = basket_signatures(m).groupBy("sig").agg(F.min(B).alias(B), F.count(F.lit(1)).alias("times"))
    return m.join(kinds.select(B, "times"), B).withColumnRenamed(B, "collection_id")


def by_popular_same_collections(baskets: DataFrame, members: DataFrame, n: int = 5,
                                collection_col: str = "collection_id") -> DataFrame:
    """Items of the collections that hold any basket item, counted, owned excluded.

    For baskets of one or two items {a, b} the count of x is N(a, x) + N(b, x) -
    N(a, b, x), N the number of collections that hold them all: sums over pair
    edges of the folded collections, and the collections that hold both.  No
    (basket, collection, item) rows are made for them.  Larger baskets look
    their collections up.
    """
    items = baskets.select(B, I).where(F.col(I).isNotNull()).distinct()
    m = fold_collections(members, collection_col)
    sizes = items.groupBy(B).agg(F.count(F.lit(1)).alias("k"), F.min(I).alias("a"), F.max(I).alias("b"))
    small = items.join(sizes.where("k <= 2").select(B), B, "left_semi")
    large = items.join(sizes.where("k > 2").select(B), B, "left_semi")

    pairs = basket_pairs(m, "collection_id", I, assume_distinct=True).join(m.select("collection_id", "times").distinct(), "collection_id")
    edges = pairs.groupBy("item1", "item2").agg(F.sum("times").alias("n"))
    either = small.join(edges, small[I] == edges["item1"]).select(B, F.col("item2").alias(I), "n")
    twos = sizes.where("k = 2").select(B, "a", "b")
    wanted = twos.select("a", "b").distinct()
    both = pairs.join(wanted, (F.col("item1") == F.col("a")) & (F.col("item2") == F.col("b"))).select("a", "b", "collection_id", "times")
    both = both.join(m.select("collection_id", I), "collection_id").groupBy("a", "b", I).agg((-F.sum("times")).alias("n"))
    both = twos.join(both, ["a", "b"]).select(B, I, "n")
    shared = large.join(m, I).select(B, "collection_id", "times").distinct()
    looked_up = shared.join(m.drop("times"), "collection_id").select(B, I, F.col("times").alias("n"))

    votes = either.unionByName(both).unionByName(looked_up)
    s = (votes.join(items, [B, I], "left_anti").groupBy(B, I).agg(F.sum("n").cast("double").alias("score")))
    return _rank(s.where("score > 0"), n)


def shared_collections(baskets: DataFrame, members: DataFrame, pairs: DataFrame) -> DataFrame:
    """``basket_id, n_shared, first_shared, last_shared``: the collections that hold any item of the basket.

    ``members``: distinct ``collection_id, item_id``; ``pairs``: their unnormalised
    ``similarity_edges``.  For baskets of one or two items {a, b} the number is
    N(a) + N(b) - N(a, b), so no (basket, collection) rows are made; larger
    baskets look their collections up.
    """
    items = baskets.select(B, I).where(F.col(I).isNotNull()).distinct()
    m = members.select("collection_id", I)
    sizes = items.groupBy(B).agg(F.count(F.lit(1)).alias("k"), F.min(I).alias("a"), F.max(I).alias("b"))
    small = items.join(sizes.where("k <= 2").select(B), B, "left_semi")
    large = items.join(sizes.where("k > 2").select(B), B, "left_semi")
    first, last = F.min("first_shared").alias("first_shared"), F.max("last_shared").alias("last_shared")
    ends = F.min("collection_id").alias("first_shared"), F.max("collection_id").alias("last_shared")

    each = m.groupBy(I).agg(F.count(F.lit(1)).alias("n"), *ends)
    both = sizes.where("k = 2").join(pairs, (F.col("item1") == F.col("a")) & (F.col("item2") == F.col("b")))
    counted = small.join(each, I).select(B, "n", "first_shared", "last_shared").unionByName(
        both.select(B, (-F.col("weight").cast("long")).alias("n")), allowMissingColumns=True)
    counted = counted.groupBy(B).agg(F.sum("n").alias("n_shared"), first, last)
    looked_up = large.join(m, I).select(B, "collection_id").distinct().groupBy(B).agg(F.count(F.lit(1)).alias("n_shared"), *ends)
    return counted.unionByName(looked_up)


def by_popularity(baskets: DataFrame, ranked_pop: DataFrame, catalog: DataFrame, n: int = 5) -> DataFrame:
    """Globally popular items not owned.  No cross join: each basket asks for the
    ranks ``0 .. n + c - 1`` (``c`` = its items among the popular list), drops the
    owned ranks, keeps the first ``n`` and looks the ranks up with an equi-join."""
    known = known_items(baskets, catalog)
    owned = known.join(ranked_pop.select(F.col("item").alias(I), "pop_rank"), I)
    c = owned.groupBy(B).agg(F.count(F.lit(1)).alias("c"))
    allb = known.select(B).distinct().join(c, B, "left").fillna(0, ["c"])
    want = allb.select(B, F.explode(F.sequence(F.lit(0), F.lit(n) + F.col("c") - 1)).alias("pop_rank"))
    free = want.join(owned.select(B, "pop_rank"), [B, "pop_rank"], "left_anti")
    cap = F.lit(n) + known.groupBy(B).count().select(F.max("count")).scalar()
    top = ranked_pop.where(F.col("pop_rank") < cap)
    s = free.join(top, "pop_rank").select(B, F.col("item").alias(I), F.col("popularity").alias("score"), "pop_rank")
    return (top_n_per_group(s, [B], [F.asc("pop_rank")], n, salt_cols=[I]).drop("pop_rank"))


def basket_signatures(baskets: DataFrame) -> DataFrame:
    """(basket_id, sig): an order-free fingerprint of each basket's distinct item set.

    Built by aggregation (count and two independent 64-bit hash sums, summed
    as decimals so they never overflow), so no basket is ever collected.
    """
    items = baskets.select(B, I).where(F.col(I).isNotNull()).distinct()
    h1 = F.xxhash64(I).cast("decimal(20,0)")
    h2 = F.xxhash64(F.concat(F.lit("#"), F.col(I).cast("string"))).cast("decimal(20,0)")
    return items.groupBy(B).agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.sum(h1).cast("string"),
                                            F.sum(h2).cast("string")).alias("sig"))


def per_distinct_basket(strategy, baskets: DataFrame, *args, **kwargs) -> DataFrame:
    """Run ``strategy`` once per distinct item set and fan the result out to
    every basket holding that set (all strategies depend on the set only)."""
    sig = basket_signatures(baskets)
    reps = sig.groupBy("sig").agg(F.min(B).alias(B))
    rep_items = baskets.join(reps.select(B), B, "left_semi")
    res = strategy(rep_items, *args, **kwargs)
    fan = reps.withColumnRenamed(B, "__rep").join(sig, "sig").select("__rep", B)
    return res.withColumnRenamed(B, "__rep").join(fan, "__rep").drop("__rep")


@dataclass(frozen=True)
class Strategy:
    name: str
    weight: float
    frame: DataFrame


def cascade(strategies: list[Strategy], n: int = 10) -> DataFrame:
    """Merge per-strategy top-n lists into one list of at most ``n`` per basket.

    Output: basket_id, item_id, recommendation_score, recommendation_method, rank.
    """
    parts = None
    for prio, st in enumerate(strategies):
        f = st.frame.select(B, I, (F.col("score") * F.lit(st.weight)).alias("recommendation_score"),
                            F.lit(st.name).alias("recommendation_method"),
                            F.lit(prio).alias("__prio"), F.col("rank").alias("__r"))
        parts = f if parts is None else parts.unionByName(f)
    order = [F.asc("__prio"), F.asc("__r")]
    first = top_n_per_group(parts, [B, I], order, 1, rank_col="__d").drop("__d")
    kept = top_n_per_group(first, [B], order, n, rank_col="__k", salt_cols=[I])
    return top_n_per_group(kept, [B], [F.desc(F.round("recommendation_score", SCORE_ORDER_DIGITS)),
                                       F.asc("__prio"), F.asc("__r")],
                           n, rank_col="rank").drop("__prio", "__r", "__k")


def enrich(recs: DataFrame, products: DataFrame, images: DataFrame | None = None,
           key_col: str = "title", order_col: str = "parent_asin",
           image_key: str = "asin", image_url: str = "hi_res_url") -> DataFrame:
    """Attach price, title, description, category and image of the first
    product row per item key (one left join per side, both de-duplicated)."""
    from .topn import first_per_key
    pcols = products.columns
    prod = first_per_key(products.where(F.col(key_col).isNotNull()), [key_col], [order_col])
    cat1 = F.col("cat_1")
    meta = prod.select(
        F.col(key_col).alias(I),
        F.col("price").cast("double").alias("price"),
        (F.col("description_clean") if "description_clean" in pcols else F.lit(None).cast("string")).alias("description"),
        F.col("title").alias("title"),
        F.when(cat1.isNotNull() & (cat1 != ""),
               F.concat(cat1, F.lit(" > "), F.coalesce(F.col("cat_2"), F.lit("")))).alias("category"),
        (F.col("image_url") if "image_url" in pcols else F.lit(None).cast("string")).alias("image_url"),
    )
    out = recs.join(meta, I, "left")
    if images is not None:
        img = first_per_key(images.where(F.col(image_key).isNotNull()), [image_key], [image_url])
        out = (out.join(img.select(F.col(image_key).alias(I), F.col(image_url).alias("__img")), I, "left")
               .withColumn("image_url", F.coalesce("__img", "image_url")).drop("__img"))
    return out
