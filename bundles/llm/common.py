"""Small shared helpers: typed input columns, Arrow batch operators, scratch tables, connected components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bundles.session import checkpoint_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What a worker process keeps from task to task, for one operator at a time.
_kept: dict = {}


def kept(operator: str, key, make: Callable):
    """``make()``, kept by this worker process until another operator (or another ``key`` of it) asks.

    Workers are reused by later operators of a job chain; this way only one
    operator's tables take up memory at a time.
    """
    if (operator, key) not in _kept:
        release()
        _kept[operator, key] = make()
    return _kept[operator, key]


def release() -> None:
    """Hand back what this worker keeps; for steps that need none of it."""
    _kept.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # freed memory goes back to the system, where the C library can
    if trim:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` as a task that hands back at its end what it kept, so that idle workers hold nothing while other steps run."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return task


def append_columns(df: DataFrame, inputs: list[str], fields: list[T.StructField],
                   fn: Callable[..., list[pa.Array]], names: list[str] | None = None) -> DataFrame:
    """``df`` with columns computed per Arrow batch; its other columns, or those of ``names``, pass through untouched.

    ``fn`` gets one Arrow array per input and returns one per field.  Columns
    of ``df`` that bear a new field's name are replaced.
    """
    base = df.select(*[f"`{c}`" for c in df.columns if c not in {f.name for f in fields} - set(inputs)])
    keep = [c for c in base.columns if c not in {f.name for f in fields} and (names is None or c in names)]
    schema = T.StructType([base.schema[c] for c in keep] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b for whole in batches for b in slices(whole)):
            made = fn(*[b.column(b.schema.get_field_index(c)) for c in inputs])
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(c)) for c in keep] + made, names=schema.names)

    return base.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batch in parts of so many rows, so that only a part at a time becomes Python objects."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


class Scratch:
    """Tables written to the shared folder; ``drop()`` removes those no result reads any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.made = 0

    def path(self, name: str) -> str:
        self.made += 1
        return f"{self.root}/{self.made:03d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as written and reread: cuts the lineage, survives lost executors."""
        where = self.path(name)
        df.write.parquet(where)
        out = self.spark.read.schema(df.schema).parquet(where)
        out.scratch_path = where
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for t in tables:
            where = jvm.org.apache.hadoop.fs.Path(t.scratch_path)
            where.getFileSystem(conf).delete(where, True)


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows ``(node, component)``, component = smallest node.

    Labels start at the smallest neighbour and take, round by round, the
    smallest label among the neighbours and then their label's label (pointer
    jumping), until no label changes.  Only joins and map-side combined
    minima; every round is a written table, so a hub of any degree is reduced
    before the shuffle and a lost executor costs one round at most.
    """
    both = scratch.write(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                         .where("a <> b").distinct(), "edges")
    label = scratch.write(both.groupBy(F.col("a").alias("node"))
                          .agg(F.min("b").alias("m"))
                          .select("node", F.least("node", "m").alias("component")), "label")
    while True:
        heard = (both.join(label, both.b == label.node).groupBy(F.col("a").alias("node"))
                 .agg(F.min("component").alias("heard")))
        step = scratch.write(label.join(heard, "node", "left")
                             .select("node", F.least("component", "heard").alias("component"), F.col("component").alias("was")), "step")
        far = step.select(F.col("node").alias("at"), F.col("component").alias("far"))
        new = scratch.write(step.join(far, step.component == far.at, "left")
                            .select("node", F.least("component", "far").alias("component"), "was"), "label")
        scratch.drop(label, step)
        label = new
        if not label.where("component < was").limit(1).count():
            scratch.drop(both)
            return label.select("node", "component")
