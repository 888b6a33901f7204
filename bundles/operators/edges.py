"""Item-item edge tables: collection similarity, pattern co-occurrence, popularity.

Edges are long tables ``(item1, item2, weight)``; nothing is a driver-side
dict.  Pair generation inside a basket is blocked: a basket larger than
``block_size`` items is cut into hash blocks and the self-join runs on
(basket, block_a, block_b), so one hot basket is spread over many tasks
instead of one.  Every pair is then aggregated right away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .select import global_index


def basket_pairs(members: DataFrame, basket_col: str = "collection_id", item_col: str = "item_id",
                 block_size: int = 256, assume_distinct: bool = False) -> DataFrame:
    """Ordered pairs (item1, item2), item1 != item2, of distinct items sharing a basket.

    Baskets of at most ``block_size`` items take a plain self-join on the
    basket key.  Larger baskets are cut into hash blocks and joined on
    (basket, block_a, block_b), so a hot basket is spread over many tasks.
    A size check (one aggregate) decides whether the blocked branch is
    needed at all; the table of large baskets is usually tiny (AQE
    broadcasts it after measuring it).  Output: ``basket_col, item1, item2``.
    """
    m = members.select(basket_col, item_col).where(F.col(item_col).isNotNull())
    if not assume_distinct:
        m = m.distinct()
    sizes = m.groupBy(basket_col).agg(F.count(F.lit(1)).alias("__n"))
    large = sizes.where(F.col("__n") > block_size).select(
        basket_col, F.ceil(F.col("__n") / F.lit(block_size)).cast("int").alias("__nb"))

    def self_join(x):
        return (x.select(basket_col, F.col(item_col).alias("item1"))
                .join(x.select(basket_col, F.col(item_col).alias("item2")), basket_col)
                .where(F.col("item1") != F.col("item2")))

    if large.isEmpty():
        return self_join(m)
    plain = self_join(m.join(large, basket_col, "left_anti"))
    blk = (m.join(large, basket_col)
           .withColumn("__b", F.pmod(F.xxhash64(item_col), F.col("__nb")).cast("int")))
    left = blk.select(basket_col, F.col(item_col).alias("item1"), F.col("__b").alias("__b1"),
                      F.explode(F.sequence(F.lit(0), F.col("__nb") - 1)).alias("__b2"))
    right = blk.select(basket_col, F.col(item_col).alias("item2"), F.col("__b").alias("__b2"),
                       F.explode(F.sequence(F.lit(0), F.col("__nb") - 1)).alias("__b1"))
    blocked = (left.join(right, [basket_col, "__b1", "__b2"])
               .where(F.col("item1") != F.col("item2"))
               .select(basket_col, "item1", "item2"))
    return plain.unionByName(blocked)


def row_normalize(edges: DataFrame, weight_col: str = "weight", src_col: str = "item1") -> DataFrame:
    """Divide each edge weight by the sum of its source row."""
    sums = edges.groupBy(src_col).agg(F.sum(weight_col).alias("__rowsum"))
    return (edges.join(sums, src_col)
            .withColumn(weight_col, F.col(weight_col) / F.col("__rowsum")).drop("__rowsum"))


def similarity_edges(members: DataFrame, basket_col: str = "collection_id", item_col: str = "item_id",
                     normalize: bool = True, block_size: int = 256, assume_distinct: bool = False) -> DataFrame:
    """Collection co-occurrence: #baskets holding both items; optionally row-normalised."""
    e = (basket_pairs(members, basket_col, item_col, block_size, assume_distinct)
         .groupBy("item1", "item2").agg(F.count(F.lit(1)).cast("double").alias("weight")))
    return row_normalize(e) if normalize else e


def cooccurrence_edges(patterns: DataFrame, normalize: bool = False) -> DataFrame:
    """Sum of pattern support over patterns of size >= 2 holding both items."""
    p = patterns.where(F.size("items") >= 2)
    pairs = (p.select("freq", F.posexplode("items").alias("i", "item1"), "items")
             .select("freq", "i", "item1", F.posexplode("items").alias("j", "item2"))
             .where(F.col("i") != F.col("j")))
    e = pairs.groupBy("item1", "item2").agg(F.sum("freq").cast("double").alias("weight"))
    return row_normalize(e) if normalize else e


def popularity(patterns: DataFrame) -> DataFrame:
    """Sum of support of the patterns holding the item, divided by the maximum."""
    s = (patterns.select(F.explode("items").alias("item"), "freq")
         .groupBy("item").agg(F.sum("freq").cast("double").alias("support_sum")))
    mx = s.select(F.max("support_sum")).scalar()  # scalar subquery, one value
    return s.select("item", (F.col("support_sum") / mx).alias("popularity"))


def rank_popularity(pop: DataFrame) -> DataFrame:
    """Adds a 0-based ``pop_rank`` (popularity desc, item asc), by a range-partitioned sort."""
    ranked = global_index(pop.select("item", "popularity"), [F.desc("popularity"), F.asc("item")], "pop_rank")
    return ranked.select("item", "popularity", F.col("pop_rank").cast("bigint").alias("pop_rank"))
