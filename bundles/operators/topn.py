"""Per-group top-n and deterministic ordering helpers.

A hot group (one basket / user holding a large share of the rows) must not
land in one window task, so ``top_n_per_group`` ranks in two levels: first
inside (group, salt) slices, then over the at most ``salt * n`` survivors of
each group.  Both levels use the same total order, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def top_n_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str],
                    n: int, rank_col: str = "rank", salt_cols: Sequence[str] | None = None,
                    salt_buckets: int = 16) -> DataFrame:
    """Keep the first ``n`` rows of every group by ``order_cols`` (a total order).

    ``salt_cols`` names the columns hashed for the first-level split (usually
    the candidate item).  ``rank_col`` receives the 1-based rank.
    """
    order = _cols(order_cols)
    if salt_cols and salt_buckets > 1:
        salt = F.pmod(F.xxhash64(*salt_cols), F.lit(salt_buckets))
        w1 = Window.partitionBy(*group_cols, salt).orderBy(*order)
        df = df.withColumn("__r1", F.row_number().over(w1)).where(F.col("__r1") <= n).drop("__r1")
    w2 = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= n)


def top_n(df: DataFrame, order_cols: Sequence[Column | str], n: int) -> DataFrame:
    """Global top n (``TakeOrderedAndProject``: each task keeps n, the driver merges)."""
    return df.orderBy(*_cols(order_cols)).limit(n)


def _order_fields(spec):
    """Encode one order item as struct fields whose ascending order is the wanted order.

    ``spec``: a column name (ascending, nulls first, as Spark), or a tuple
    ``(name_or_column, "asc" | "desc", nulls_last: bool | None)``.  Descending
    order needs a numeric column (it is negated).
    """
    if isinstance(spec, (str, Column)):
        spec = (spec, "asc", None)
    col, direction, nulls_last = (tuple(spec) + (None,))[:3]
    c = F.col(col) if isinstance(col, str) else col
    desc = direction == "desc"
    if nulls_last is None:
        nulls_last = desc  # Spark's defaults: ASC NULLS FIRST, DESC NULLS LAST
    value = -c if desc else c
    flag = c.isNull() if nulls_last else c.isNotNull()
    return [flag, value]


def first_per_key(df: DataFrame, key_cols: Sequence[str], order_specs: Sequence) -> DataFrame:
    """First row per key under an explicit order (``drop_duplicates(keep='first')``).

    An aggregate, not a window: ``min_by(row, order)`` is combined map-side,
    so a key holding a large share of the rows (copies) is reduced before
    the shuffle.  Ties on the whole order are broken by the row itself.
    """
    others = [c for c in df.columns if c not in key_cols]
    fields = []
    for spec in order_specs:
        fields += _order_fields(spec)
    order = F.struct(*[f.alias(f"o{i}") for i, f in enumerate(fields)],
                     F.struct(*others).alias("__row_tie")) if others else \
        F.struct(*[f.alias(f"o{i}") for i, f in enumerate(fields)])
    row = F.struct(*others) if others else F.lit(0)
    out = df.groupBy(*key_cols).agg(F.min_by(row, order).alias("__first"))
    return out.select(*key_cols, *([F.col(f"__first.{c}").alias(c) for c in others]))
