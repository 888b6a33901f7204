"""Row selection: cumulative top-K cut, exact reproducible sampling, global row index.

No operator here uses a ``Window`` without ``partitionBy`` on row-level data.
Global positions come from a range-partitioned sort plus per-partition
offsets (a table with one row per partition); selections by rank use
histograms so that only one small bucket ever needs ordering.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_POS_BITS = 33  # monotonically_increasing_id = partition << 33 | position


def global_index(df: DataFrame, order_cols: Sequence[Column | str], index_col: str = "idx") -> DataFrame:
    """0-based position of every row under a total order, fully distributed.

    The sorted frame is checkpointed to the shared checkpoint folder so both
    passes see the same partitioning.
    """
    from ..session import checkpoint_root
    checkpoint_root(df.sparkSession)
    srt = (df.orderBy(*order_cols).withColumn("__mid", F.monotonically_increasing_id())
           .checkpoint(eager=True))
    part = F.shiftright("__mid", _POS_BITS)
    sizes = srt.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: a proven-small table
    offs = sizes.select("__p", (F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).alias("__off"))
    return (srt.withColumn("__p", part).join(F.broadcast(offs), "__p")
            .withColumn(index_col, F.col("__off") + F.col("__mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
            .drop("__mid", "__p", "__off"))


def value_counts(df: DataFrame, key: str, count_col: str = "count") -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(count_col))


def cumulative_cut(df: DataFrame, key: str, target: int) -> DataFrame:
    """Smallest K such that the K most frequent keys reach ``target`` rows.

    Output: key, review_count, cumulative_reviews (the crossing key is
    included; ties by key ascending; all keys stay if the total is smaller).
    """
    counts = value_counts(df, key, "review_count")
    hist = counts.groupBy("review_count").agg(F.count(F.lit(1)).alias("__np"),
                                              F.sum("review_count").alias("__tot"))
    # few rows (distinct count values): cumulative totals of the buckets above
    w = Window.orderBy(F.desc("review_count")).rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.select("review_count", F.coalesce(F.sum("__tot").over(w), F.lit(0)).alias("__before"),
                       F.coalesce(F.sum("__np").over(w), F.lit(0)).alias("__pbefore"), "__np")
    live = hist.where(F.col("__before") < target)
    # one row per distinct count value (at most sqrt(2 * rows)); AQE decides the join side
    cand = counts.join(live, "review_count")
    # rank inside the count bucket: global index over the surviving keys
    idx = global_index(cand, [F.desc("review_count"), F.asc(key)])
    j = F.col("idx") - F.col("__pbefore")
    cum = F.col("__before") + (j + 1) * F.col("review_count")
    return (idx.withColumn("cumulative_reviews", cum)
            .where(F.col("cumulative_reviews") - F.col("review_count") < target)
            .select(key, "review_count", "cumulative_reviews"))


def cut_stats(cut: DataFrame, all_counts: DataFrame, target: int) -> DataFrame:
    """K, share of products, mean reviews per kept product, efficiency vs target."""
    n_all = all_counts.select(F.count(F.lit(1))).scalar()
    return cut.agg(F.count(F.lit(1)).alias("top_k"), F.sum("review_count").alias("actual_reviews")).select(
        "top_k", "actual_reviews",
        F.round(F.col("top_k") * 100.0 / n_all, 6).alias("pct_products"),
        F.round(F.col("actual_reviews") / F.col("top_k"), 6).alias("mean_reviews"),
        F.round(F.col("actual_reviews") * 100.0 / F.lit(target), 6).alias("efficiency_pct"))


def hash_order(seed: int, cols: Sequence[str]) -> Column:
    """md5 of ``seed|c1|c2...``: reproducible, engine-independent row order."""
    parts = [F.lit(str(seed))]
    for c in cols:
        parts += [F.lit("|"), F.coalesce(F.col(c).cast("string"), F.lit(""))]
    return F.md5(F.concat(*parts))


def exact_sample(df: DataFrame, n: int, key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all rows when fewer), the ``n`` smallest by ``hash_order``.

    Two phases: row counts per 16-bit hash prefix (65,536 buckets, a small
    table) locate the crossing bucket; rows of earlier buckets pass by a
    filter, only the crossing bucket is ranked.
    """
    h = df.withColumn("__h", hash_order(seed, key_cols))
    h = h.withColumn("__b", F.conv(F.substring("__h", 1, 4), 16, 10).cast("int"))
    hist = h.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.select("__b", "__n", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__before"))
    live = hist.where(F.col("__before") < n)
    cand = h.join(F.broadcast(live), "__b")  # at most 65,536 rows
    whole = cand.where(F.col("__before") + F.col("__n") <= n)
    cross = cand.where(F.col("__before") + F.col("__n") > n)  # at most one bucket
    wb = Window.partitionBy("__b").orderBy("__h", *key_cols)
    part = (cross.withColumn("__r", F.row_number().over(wb))
            .where(F.col("__before") + F.col("__r") <= n).drop("__r"))
    return whole.unionByName(part).drop("__h", "__b", "__n", "__before")
