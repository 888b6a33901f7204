"""Reproducible train/test split by hashing, and unknown-id exclusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_fraction(seed: int, *cols: str) -> Column:
    """A number in [0, 1) from md5 of ``seed|c1|c2``: the same in any engine."""
    parts = [F.lit(str(seed))]
    for c in cols:
        parts += [F.lit("|"), F.col(c).cast("string")]
    h = F.md5(F.concat(*parts))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def dedupe_pairs(trip: DataFrame) -> DataFrame:
    """One row per (user, item); repeated interactions keep the largest value."""
    return trip.groupBy("user_id", "item_id").agg(F.max("value").alias("value"))


def ratio_split(trip: DataFrame, test_size: float = 0.2, seed: int = 42,
                exclude_unknowns: bool = True) -> DataFrame:
    """Adds ``split`` in {train, test}; with ``exclude_unknowns`` test rows whose
    user or item never occurs in train are dropped."""
    d = dedupe_pairs(trip).withColumn(
        "split", F.when(hash_fraction(seed, "user_id", "item_id") < test_size, "test").otherwise("train"))
    if not exclude_unknowns:
        return d
    train = d.where(F.col("split") == "train")
    test = exclude_unknown(d.where(F.col("split") == "test"), train)
    return train.unionByName(test)


def exclude_unknown(test: DataFrame, train: DataFrame) -> DataFrame:
    """Test rows whose user and item both occur in train (two semi joins)."""
    return (test.join(train.select("user_id").distinct(), "user_id", "left_semi")
            .join(train.select("item_id").distinct(), "item_id", "left_semi"))
