"""Collection (basket) preparation: cleaning, transactions, item codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .topn import first_per_key


def clean_collections(df: DataFrame, collection_col: str = "collection_id", item_col: str = "item_id",
                      rating_col: str = "rating", order_col: str | None = "order_key",
                      min_size: int = 2) -> DataFrame:
    """De-duplicate (collection, item) keeping the first row, drop null ids,
    add ``binary_rating`` and keep collections of at least ``min_size`` rows.

    Order of steps is the reference's: dedupe, dropna, binarise, size filter.
    """
    keys = [collection_col, item_col]
    order = [(order_col, "asc", True)] if order_col else []
    order += [(rating_col, "desc", True)]
    dedup = first_per_key(df, keys, order)
    kept = dedup.dropna(subset=keys).withColumn(
        "binary_rating", F.coalesce((F.col(rating_col) > 0).cast("int"), F.lit(0)))
    if min_size <= 1:  # every collection has a row
        return kept
    sizes = kept.groupBy(collection_col).count().where(F.col("count") >= min_size).select(collection_col)
    return kept.join(sizes, collection_col, "left_semi")


def transactions(clean: DataFrame, collection_col: str = "collection_id", item_col: str = "item_id",
                 min_size: int = 2) -> DataFrame:
    """One row per collection with its sorted distinct items (``items``)."""
    return (clean.groupBy(collection_col)
            .agg(F.array_sort(F.collect_set(item_col)).alias("items"))
            .where(F.size("items") >= min_size))


def transaction_stats(txn: DataFrame) -> DataFrame:
    n = F.size("items")
    return txn.agg(F.count(F.lit(1)).alias("n_transactions"),
                   F.round(F.avg(n), 6).alias("avg_len"),
                   F.max(n).cast("bigint").alias("max_len"),
                   F.min(n).cast("bigint").alias("min_len"))


def item_codes(clean: DataFrame, item_col: str = "item_id") -> DataFrame:
    """Dense 0-based integer codes for items (sorted order, no global window).

    The distributed global index numbers a range-partitioned sort in the JVM.
    """
    from .select import global_index
    items = clean.select(F.col(item_col).cast("string").alias(item_col)).distinct()
    return global_index(items, [item_col], "item_code").select(item_col, F.col("item_code").cast("bigint").alias("item_code"))
