"""Interaction triplets and labels for the collaborative-filtering baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X

MODELS = ("mf", "bpr", "ease", "wmf")


def triplets(df: DataFrame, model: str, user_col: str = "user_id", item_col: str = "parent_asin",
             rating_col: str = "rating", verified_col: str = "verified_purchase",
             helpful_col: str = "helpful_vote") -> DataFrame:
    """(user_id, item_id, value) for one model family.

    mf: explicit rating; bpr / ease: verified or voted; wmf: vote count as confidence.
    """
    if model not in MODELS:
        raise ValueError(f"unknown model {model!r}; expected one of {MODELS}")
    if model == "mf":
        if rating_col not in df.columns:
            raise ValueError("mf needs a rating column")
        value = F.col(rating_col).cast("float")
        df = df.where(F.col(rating_col).isNotNull())
    elif model in ("bpr", "ease"):
        value = X.interaction_label(verified_col, helpful_col)
    else:
        value = X.confidence(helpful_col)
    return df.select(F.col(user_col).cast("string").alias("user_id"),
                     F.col(item_col).cast("string").alias("item_id"), value.alias("value"))
