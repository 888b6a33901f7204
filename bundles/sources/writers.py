"""Sinks: parquet / CSV writes, chunked files, compaction, schema sidecar, positional split, run log."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", max_records: int | None = None,
                  compression: str = "snappy") -> str:
    w = df.write.mode(mode).option("compression", compression)
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def list_data_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> list[str]:
    """Data files under ``path`` (Hadoop FS API, works on any shared store)."""
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().toString() for s in fs.listStatus(p)
            if s.isFile() and s.getPath().getName().endswith(suffix) and not s.getPath().getName().startswith(("_", "."))]


def write_chunked(df: DataFrame, path: str, chunk_rows: int = 500_000) -> str:
    """One write with at most ``chunk_rows`` rows per file (no slicing and re-merging)."""
    return write_parquet(df, path, max_records=chunk_rows)


def compact(spark: SparkSession, input_glob: str, output_path: str, files: int = 10,
            delete_inputs: bool = False) -> dict:
    """Merge many parquet chunks into ``files`` snappy files.

    Writes to ``output_path + '_temp'``, re-reads and compares counts (raises
    on mismatch, temp output removed), then renames into place through the
    Hadoop FS API.  Inputs are deleted only when asked.
    """
    t0 = time.time()
    src = spark.read.parquet(input_glob)
    n_in = src.count()
    tmp = output_path.rstrip("/") + "_temp"
    fs, tmp_p, jvm = _fs(spark, tmp)
    try:
        src.coalesce(files).write.mode("overwrite").option("compression", "snappy").parquet(tmp)
        n_out = spark.read.parquet(tmp).count()
        if n_out != n_in:
            raise RuntimeError(f"row count mismatch after compaction: {n_in} in, {n_out} out")
    except Exception:
        if fs.exists(tmp_p):
            fs.delete(tmp_p, True)
        raise
    out_p = jvm.org.apache.hadoop.fs.Path(output_path)
    old_p = jvm.org.apache.hadoop.fs.Path(output_path.rstrip("/") + "_replaced")
    had_old = fs.exists(out_p)
    if had_old and not fs.rename(out_p, old_p):
        raise RuntimeError(f"cannot set {output_path} aside; the new data stays in {tmp}")
    if not fs.rename(tmp_p, out_p):
        if had_old:
            fs.rename(old_p, out_p)
        raise RuntimeError(f"cannot rename {tmp} to {output_path}")
    if had_old:
        fs.delete(old_p, True)
    if delete_inputs:
        for f in spark.read.parquet(input_glob).inputFiles():
            fs.delete(jvm.org.apache.hadoop.fs.Path(f), False)
    n_files = len(list_data_files(spark, output_path))
    return {"input_rows": n_in, "output_rows": n_out, "output_files": n_files, "output_path": output_path,
            "seconds": round(time.time() - t0, 3), "status": "ok"}


def schema_sidecar(df: DataFrame, path: str, name: str) -> DataFrame:
    """Schema report (name, #cols, #rows, columns, tree) as one row, also written as JSON text."""
    spark = df.sparkSession
    n = df.count()
    rec = {"name": name, "n_cols": len(df.columns), "n_rows": n, "columns": ",".join(df.columns),
           "schema_json": df.schema.json(), "tree": df.schema.treeString()}
    one = spark.createDataFrame([rec])
    one.coalesce(1).write.mode("overwrite").json(path)
    return spark.read.json(path).select("name", F.col("n_cols").cast("bigint"), F.col("n_rows").cast("bigint"),
                                        "columns", "tree")


def split_positional(df: DataFrame, path: str, order_cols, part_rows: int = 500_000) -> DataFrame:
    """Files of ``part_rows`` consecutive rows (by ``order_cols``) under ``part_id=…``.

    All rows are kept.  Positions come from the
    distributed global index, not a global window.
    """
    from ..operators.select import global_index
    idx = global_index(df, order_cols, "__idx").withColumn("part_id", F.floor(F.col("__idx") / part_rows).cast("int"))
    idx.drop("__idx").write.mode("overwrite").partitionBy("part_id").parquet(path)
    return df.sparkSession.read.parquet(path)


class RunLog:
    """Stage metrics appended as parquet rows: stage, rows_in, rows_out, seconds."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def append(self, stage: str, rows_in: int, rows_out: int, seconds: float, note: str = ""):
        row = [(stage, int(rows_in), int(rows_out), float(seconds), note, time.time())]
        self.spark.createDataFrame(row, "stage string, rows_in bigint, rows_out bigint, seconds double, note string, "
                                        "logged_at double").write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)
