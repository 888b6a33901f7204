"""Sources: JSON lines with rejects, parquet chunks, CSV, latest file, prefixes.

JSON lines are read as text and parsed once.  A line is a row if Python's
``json.loads`` takes it and it holds one object (repeated keys: the last one
stands; NaN and infinities are numbers); every other line is rejected, blank
lines and lines that hold a list, a number or two objects among them.  Values
are read as text and cast to the declared type afterwards, so a wrong type in
one field nulls that field instead of the whole row; a decimal number without a
fraction is a whole number.
A ``.gz`` file is one task; ``repartition`` right after the read spreads
the parsing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expr as X

REVIEW_SCHEMA = T.StructType([
    T.StructField("rating", T.DoubleType()), T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("images", T.StringType()),
    T.StructField("asin", T.StringType()), T.StructField("parent_asin", T.StringType()),
    T.StructField("user_id", T.StringType()), T.StructField("timestamp", T.LongType()),
    T.StructField("helpful_vote", T.LongType()), T.StructField("verified_purchase", T.BooleanType()),
])

META_SCHEMA = T.StructType([
    T.StructField("main_category", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("average_rating", T.DoubleType()), T.StructField("rating_number", T.LongType()),
    T.StructField("features", T.StringType()), T.StructField("description", T.StringType()),
    T.StructField("price", T.StringType()), T.StructField("images", T.StringType()),
    T.StructField("videos", T.StringType()), T.StructField("store", T.StringType()),
    T.StructField("categories", T.StringType()), T.StructField("details", T.StringType()),
    T.StructField("parent_asin", T.StringType()), T.StructField("bought_together", T.StringType()),
    T.StructField("subtitle", T.StringType()), T.StructField("author", T.StringType()),
])


def _as_text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


JSON_OPTIONS = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowNonNumericNumbers": "true"}


def parsed_lines(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """``value, file_path, j`` of lines ``value, file_path``: the object's fields as text, ``j`` null for a rejected line.

    The line stands inside a list with a mark behind it, so that whatever comes
    after its object is an error or keeps the mark from being read.  The
    generator keeps the parsed column apart, so it is computed once.
    """
    around = T.StructType([T.StructField("line", T.ArrayType(_as_text_schema(schema))), T.StructField("after it", T.StringType())])
    parsed = raw.withColumn("p", F.from_json(F.concat(F.lit('{"line": ['), "value", F.lit('], "after it": "end"}')), around, JSON_OPTIONS))
    whole = (F.col("p.`after it`") == "end") & (F.size("p.line") == 1)
    return parsed.select("value", "file_path", F.explode_outer(F.when(whole, F.col("p.line"))).alias("j"))


def _parsed_lines(spark: SparkSession, path: str, schema: T.StructType, partitions: int | None):
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file_path"))
    return parsed_lines(raw.repartition(partitions) if partitions else raw, schema)


def _typed(c, kind: T.DataType):
    """Text of a JSON value as ``kind``, null if it is none; the parser quotes NaN and infinities."""
    number = F.when(c.isin('"NaN"', '"Infinity"', '"-Infinity"'), F.btrim(c, F.lit('"'))).otherwise(c)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return X.to_double(number).cast(kind)
    if isinstance(kind, T.IntegralType):
        as_double = X.to_double(number)
        return F.coalesce(c.try_cast(kind), F.when(as_double == F.floor(as_double), number.try_cast("decimal(38,6)").try_cast(kind)))
    return c.try_cast(kind)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, partitions: int | None = None,
               clean_price_col: str | None = "price", keep_file: bool = False) -> DataFrame:
    """Rows of JSON-lines files (gz or plain) with the declared ``schema``."""
    s = _parsed_lines(spark, path, schema, partitions).where(F.col("j").isNotNull())
    return s.select(*typed_columns(schema, clean_price_col), *(["file_path"] if keep_file else []))


def typed_columns(schema: T.StructType, clean_price_col: str | None = None) -> list:
    """The declared columns from the text fields of ``j``."""
    cols = []
    for f in schema.fields:
        c = F.col(f"j.{f.name}")
        if f.name == clean_price_col:
            cols.append(X.clean_price(c).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            cols.append(c.alias(f.name))
        else:
            cols.append(_typed(c, f.dataType).alias(f.name))
    return cols


#: For readers that only ask whether a line is an object.
ANY_OBJECT = T.StructType([T.StructField("_", T.StringType())])


def read_rejects(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Rejected lines (blank lines included), with their file."""
    return _parsed_lines(spark, path, ANY_OBJECT, partitions).where(F.col("j").isNull()).select("file_path", "value")


def reject_counts(spark: SparkSession, path: str) -> DataFrame:
    lines = _parsed_lines(spark, path, ANY_OBJECT, None)
    return lines.groupBy("file_path").agg(F.count(F.lit(1)).alias("n_lines"),
                                          F.count(F.when(F.col("j").isNull(), 1)).alias("n_rejected"))


#: Up to so many rows a prefix is taken from the first rows of every task.
PREFIX_ROWS = 100_000


def first_rows(df: DataFrame, n: int, order_cols: Sequence) -> DataFrame:
    """Exact prefix of ``n`` rows under a declared order: short ones from the first rows of
    every task, long ones by the distributed global index."""
    if n <= PREFIX_ROWS:
        return df.orderBy(*order_cols).limit(n)
    from ..operators.select import global_index
    return global_index(df, order_cols, "__idx").where(F.col("__idx") < n).drop("__idx")


def read_chunks(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """All parquet chunks of a folder as one table; errors on a missing folder or no chunk."""
    from .writers import list_data_files
    files = list_data_files(spark, folder)
    if not files:
        raise FileNotFoundError(f"no parquet chunks under {folder}")
    return spark.read.parquet(f"{folder.rstrip('/')}/{pattern}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, optional: bool = False) -> DataFrame | None:
    """CSV with header and a declared schema; ``optional`` returns None when the path is absent."""
    from .writers import _fs
    fs, p, _ = _fs(spark, path)
    if optional and not fs.exists(p):
        return None
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_latest(spark: SparkSession, glob: str, fmt: str = "parquet") -> DataFrame:
    """The most recently modified file matching ``glob`` (checkpoint pick-up); no file is read to find it."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(glob)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at) or []
    files = [(f.getModificationTime(), f.getPath().toString()) for f in found if f.isFile()]
    if not files:
        raise FileNotFoundError(f"nothing matches {glob}")
    return spark.read.format(fmt).load(max(files)[1])


def row_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Row count per table from a column-pruned scan (parquet answers from footers)."""
    out = None
    for name, path in paths.items():
        c = spark.read.parquet(path).select(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        c = c.groupBy("table_name").agg(F.sum("n_rows").alias("n_rows"))
        out = c if out is None else out.unionByName(c)
    return out
