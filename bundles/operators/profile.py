"""Profiling aggregates: one pass per report (a few for exact quartiles), results as small DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quantiles import quantiles

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def describe(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """count, mean, std (sample), min, quartiles (interpolated), max per column.

    One pass for all but the quartiles.  Exact quartiles come from a few
    histogram passes (``quantiles.py``; not-a-number and infinite values take no
    part in them); ``exact=False`` takes ``percentile_approx`` in the one pass.
    """
    cols = list(cols or numeric_columns(df))
    shares = [0.25, 0.5, 0.75]
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    aggs = []
    for c in cols:
        v = F.col(c)
        finite = F.when(F.abs(v) < float("inf"), v)
        aggs.append(F.struct(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
                             F.count(finite).alias("n"), F.min(finite).alias("low"), F.max(finite).alias("high"),
                             (F.array(*[F.lit(None).cast("double")] * 3) if exact else F.percentile_approx(v, shares, 10000)).alias("q")).alias(c))
    one = x.agg(*aggs).first()
    q = quantiles(x, {c: (one[c]["n"], one[c]["low"], one[c]["high"]) for c in cols}, shares) if exact else {c: one[c]["q"] for c in cols}
    rows = [(c, one[c]["count"], one[c]["mean"], one[c]["std"], one[c]["min"], *(q[c] or [None] * 3), one[c]["max"]) for c in cols]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, count long, mean double, std double, min double, q25 double, q50 double, q75 double, max double")


def null_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, only columns with nulls, most first."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    long = one.unpivot([], cols, "column_name", "n_null")
    return long.where(F.col("n_null") > 0)


def usable_report(df: DataFrame, cols: Sequence[str], empty_markers=("[]", "none", "")) -> DataFrame:
    """Per listed column: nulls (incl. empty-list markers), total, usable percent.
    Columns absent from the frame are reported with ``present = false``."""
    present = [c for c in cols if c in df.columns]
    total = F.count(F.lit(1))
    aggs = [total.alias("__total")]
    for c in present:
        x = F.col(c)
        dt = df.schema[c].dataType
        if isinstance(dt, T.ArrayType):
            empty = x.isNull() | (F.size(x) == 0)
        else:
            empty = x.isNull() | F.lower(F.trim(x.cast("string"))).isin(*empty_markers)
        aggs.append(F.count(F.when(empty, 1)).alias(c))
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(c in present).alias("present"),
                     (F.col(c) if c in present else F.lit(None).cast("bigint")).alias("n_null"),
                     F.col("__total").alias("total")) for c in cols]
    out = one.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
    return out.withColumn("usable_pct", F.round((F.col("total") - F.col("n_null")) * 100.0 / F.col("total"), 6))


def cat_summary(df: DataFrame, cols: Sequence[str], top: int = 5) -> DataFrame:
    """Per text column: number of distinct values and the top ``top`` as 'value (count)'."""
    from .topn import top_n_per_group
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column_name", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    nuniq = counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_unique"))
    best = top_n_per_group(counts, ["column_name"], [F.desc("n"), F.asc("value")], top, rank_col="r")
    wide = (best.withColumn("txt", F.concat("value", F.lit(" ("), F.col("n").cast("string"), F.lit(")")))
            .groupBy("column_name").pivot("r", list(range(1, top + 1))).agg(F.first("txt")))
    out = nuniq.join(wide, "column_name", "left")
    return out.select("column_name", "n_unique",
                      *[F.coalesce(F.col(str(i)), F.lit("")).alias(f"top_{i}") for i in range(1, top + 1)])


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Equal-width bins over [lo, hi] with the top edge closed; empty bins are present."""
    x = F.col(col).cast("double")
    b = F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    counts = (df.where(x.isNotNull() & (x >= lo) & (x <= hi)).groupBy(b.alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    spark = df.sparkSession
    allb = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (allb.join(counts, "bin", "left")
            .select("bin", F.round(F.lit(lo) + F.col("bin") * ((hi - lo) / bins), 6).alias("lo"),
                    F.round(F.lit(lo) + (F.col("bin") + 1) * ((hi - lo) / bins), 6).alias("hi"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def crosstab(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """pd.crosstab with the column values given (no extra job to discover them)."""
    out = df.groupBy(row).pivot(col, list(values)).count().na.fill(0)
    return out.select(row, *[F.col(str(v)).cast("bigint").alias(f"{col}_{v}") for v in values])


def sparsity(df: DataFrame, user: str, item: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(user).alias("n_users"),
                  F.countDistinct(item).alias("n_items")).withColumn(
        "sparsity", F.round(1 - F.col("n") / (F.col("n_users").cast("double") * F.col("n_items")), 9))


def schema_report(df: DataFrame) -> DataFrame:
    """Column names and types with the row and column counts (one count job)."""
    spark = df.sparkSession
    fields = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    meta = spark.createDataFrame(fields, "ordinal int, column_name string, type string")
    n = df.select(F.count(F.lit(1))).scalar()
    return meta.select("ordinal", "column_name", "type", n.alias("n_rows"),
                       F.lit(len(fields)).cast("bigint").alias("n_cols"))
