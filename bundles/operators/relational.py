"""Filters and joins of the inventory, as DataFrame operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values that must equal the reference's -------------------------
# Column families of the origin-prefix rename (review side / item side).
REVIEW_COLUMNS = ["rating", "text", "asin", "parent_asin", "user_id", "timestamp", "helpful_vote",
                  "verified_purchase"]
ITEM_COLUMNS = ["main_category", "average_rating", "rating_number", "features", "description", "price",
                "videos", "store", "categories", "details", "bought_together"]


SUFFIX_PREFIX = {"_review": "users_", "_meta": "item_"}


def prefix_plan(columns: Sequence[str], by_suffix: dict[str, str], by_name: dict[str, str]) -> dict[str, str]:
    """Renames ``{old: new}``: a column with a listed suffix swaps it for the prefix
    (the suffix text goes wherever it occurs), else a listed name gets its prefix."""
    plan = {c: by_name[c] + c for c in columns if c in by_name}
    for suffix, prefix in by_suffix.items():
        # fixed behaviour: the suffix is removed wherever it occurs, as the reference does
        plan.update((c, prefix + c.replace(suffix, "")) for c in columns if c.endswith(suffix))
    return plan


def rename_origin(df: DataFrame) -> DataFrame:
    """Columns named after the side they come from: by suffix, else by the fixed column lists."""
    by_name = dict.fromkeys(ITEM_COLUMNS, "item_") | dict.fromkeys(REVIEW_COLUMNS, "users_")
    return df.withColumnsRenamed(prefix_plan(df.columns, SUFFIX_PREFIX, by_name))


def suffixed(left: DataFrame, right: DataFrame, on: Sequence[str], suffixes=("_review", "_meta")) -> tuple[DataFrame, DataFrame]:
    """Both sides with the suffixes on their clashing non-key columns."""
    clash = (set(left.columns) & set(right.columns)) - set(on)
    return tuple(df.select(*[F.col(c).alias(c + suffix) if c in clash else F.col(c) for c in df.columns])
                 for df, suffix in zip((left, right), suffixes))


def join_with_suffixes(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                       suffixes=("_review", "_meta"), dedupe_right: bool = False) -> DataFrame:
    """pandas ``merge``: clashing non-key columns get the suffixes; null keys never match."""
    on = list(on)
    lf, rt = suffixed(left, right, on, suffixes)
    if dedupe_right:
        rt = rt.dropDuplicates(on)
    return lf.join(rt, on, how)


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys left / right / common in one row; the caller asserts ``common_keys > 0``."""
    lk = left.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__l", F.lit(1))
    rk = right.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__r", F.lit(1))
    flagged = lk.join(rk, key, "full_outer")
    return flagged.agg(F.count("__l").alias("left_keys"), F.count("__r").alias("right_keys"),
                       F.count(F.when(F.col("__l").isNotNull() & F.col("__r").isNotNull(), 1))
                       .alias("common_keys"))


def semi(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Membership in a computed key set, never collected to the driver."""
    return df.join(keys, on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return df.join(keys, on, "left_anti")


def min_group_size(df: DataFrame, key: str, min_size: int = 2) -> DataFrame:
    sizes = df.groupBy(key).count().where(F.col("count") >= min_size).select(key)
    return df.join(sizes, key, "left_semi")


def top_n_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` most frequent non-null keys (ties: key ascending), as a small table."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).count()
            .orderBy(F.desc("count"), F.asc(key)).limit(n))


def category_match(recs: DataFrame, interacted: DataFrame, user_col: str = "user_id",
                   cat2: str = "cat_2", cat4: str = "cat_4") -> DataFrame:
    """Label each recommendation: ``same_cat4`` -> ``same_cat2_diff_cat4`` -> ``diff_cat2``.

    Null categories never match.  Two left joins to the user's distinct
    category sets replace the per-row lookup.
    """
    c4 = (interacted.select(F.col(user_col).alias("__u4"), F.col(cat4).alias("__c4"))
          .where(F.col("__c4").isNotNull()).distinct().withColumn("__m4", F.lit(True)))
    c2 = (interacted.select(F.col(user_col).alias("__u2"), F.col(cat2).alias("__c2"))
          .where(F.col("__c2").isNotNull()).distinct().withColumn("__m2", F.lit(True)))
    out = recs.join(c4, (F.col(user_col) == F.col("__u4")) & (F.col(cat4) == F.col("__c4")), "left")
    out = out.join(c2, (F.col(user_col) == F.col("__u2")) & (F.col(cat2) == F.col("__c2")), "left")
    label = (F.when(F.col("__m4"), "same_cat4").when(F.col("__m2"), "same_cat2_diff_cat4")
             .otherwise("diff_cat2"))
    return out.withColumn("match", label).drop("__m4", "__m2", "__u4", "__u2", "__c4", "__c2")
