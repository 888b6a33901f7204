"""Greedy packing of items into fixed-size, diverse collections.

Within each group (``cat_1``), rows are walked in a declared order; a row
joins the open collection when its ``cat_2`` and its ``cat_3`` each occur
fewer than ``max_repeat`` times there; at ``size`` items the collection is
emitted and a new one opened.  Rejected rows and the unfinished tail are not
part of any collection (the reference's semantics).

The walk of a group of any size runs in many tasks.  Rows are sorted by (group,
order) and cut into chunks of bounded size; a chunk may begin inside a group.
Every chunk is walked from a guessed state, an empty open collection.  Chunks
hand their end states on (at most ``size - 1`` rows of labels); a chunk whose
true start differs from the one it was walked from is walked again, until all
agree.  Walks meet again as soon as both begin a collection at the same row, so
few rounds are needed; in the worst case a round settles one more chunk.
Placements are written with each walk, and the last walk of a chunk counts.
Numbers of collections are prefix sums over (group, chunk) counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

#: Rows of a chunk, on average; changes no result.
CHUNK_ROWS = 250_000


class _Walk:
    """The open collection of one group inside one chunk."""

    def __init__(self, key, start, size: int, max_repeat: int):
        self.key, self.size, self.max_repeat = key, size, max_repeat
        self.seq, self.members = 0, [] if start is None else [(m["c2"], m["c3"]) for m in start]

    def place(self, own: tuple) -> tuple[int, int] | None:
        """(collection number in this chunk, position), None if the row is turned away."""
        if any(sum(m[i] == own[i] for m in self.members) >= self.max_repeat for i in range(len(own))):
            return None
        at = self.seq, len(self.members)
        self.members.append(own)
        if len(self.members) == self.size:
            self.seq, self.members = self.seq + 1, []
        return at


def _walker(size: int, max_repeat: int):
    """Rows sorted by chunk, group and order -> placed rows (``__pos`` from 0), and per chunk and group one row
    with ``__pos`` null: the collections emitted and the labels left open at its end."""
    def run(batches):
        import pandas as pd

        walk, columns = None, []
        for pdf in batches:
            columns, kept, placed, ended = list(pdf.columns.drop("__start")), [], [], []
            labels = zip(pdf["__c2"].tolist(), pdf["__c3"].tolist())
            for i, (key, start, own) in enumerate(zip(zip(pdf["__chunk"].tolist(), pdf["__g"].tolist()), pdf["__start"], labels)):
                if walk is None or key != walk.key:
                    if walk is not None:
                        ended.append(walk)
                    walk = _Walk(key, start, size, max_repeat)  # start: null but for a group that goes on from the chunk before
                at = walk.place(own)
                if at is not None:
                    kept.append(i)
                    placed.append(at)
            rows = pdf.iloc[kept][columns].assign(__seq=[p[0] for p in placed], __pos=[p[1] for p in placed], __open=None)
            yield rows.astype({"__seq": "int64", "__pos": "int32"})
            if ended:
                yield _summaries(ended, columns)
        if walk is not None:
            yield _summaries([walk], columns)
    return run


def _summaries(walks: list[_Walk], columns: list[str]):
    import pandas as pd
    out = pd.DataFrame({c: [None] * len(walks) for c in columns})
    out["__chunk"], out["__g"] = [w.key[0] for w in walks], [w.key[1] for w in walks]
    out["__seq"], out["__pos"] = [w.seq for w in walks], None
    out["__open"] = [[{"c2": a, "c3": b} for a, b in w.members] for w in walks]
    return out


def pack_collections(df: DataFrame, group_col: str = "cat_1", c2_col: str = "cat_2", c3_col: str = "cat_3",
                     order_col: str = "parent_asin", item_col: str = "parent_asin", rating_col: str = "rating",
                     size: int = 5, max_repeat: int = 2, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Output: collection_id (1-based, groups in ascending key order), item_id, rating, group, position.

    Exact for any ``chunk_rows``; memory is constant, a group's walk is dealt to as many tasks as it has chunks.
    """
    spark = df.sparkSession
    src = (df.where(F.col(group_col).isNotNull())
           .select(F.col(group_col).alias("__g"), F.col(c2_col).alias("__c2"), F.col(c3_col).alias("__c3"),
                   F.col(order_col).alias("__o"), F.col(item_col).alias("item_id"),
                   F.col(rating_col).alias("rating")))
    n = max(1, -(-src.count() // chunk_rows))
    rows = materialize(src.repartitionByRange(n, "__g", "__o").withColumn("__chunk", F.spark_partition_id()), spark, "pack-rows")
    # one row per chunk: its first and last group, and its number among the chunks
    ends = rows.groupBy("__chunk").agg(F.min("__g").alias("first_g"), F.max("__g").alias("last_g"))
    chunks = materialize(ends.withColumn("n", F.row_number().over(Window.orderBy("__chunk"))), spark, "pack-chunks")
    label = f"array<struct<c2:{src.schema['__c2'].dataType.simpleString()},c3:{src.schema['__c3'].dataType.simpleString()}>>"
    nothing = F.array().cast(label)
    schema = T.StructType(rows.schema.fields + [T.StructField("__seq", T.LongType()), T.StructField("__pos", T.IntegerType()),
                                                T.StructField("__open", T._parse_datatype_string(label))])

    def walk(starts: DataFrame, name: str) -> DataFrame:
        """Placements and summaries of the chunks in ``starts(__chunk, first_g, start)``."""
        own = rows.join(starts, "__chunk").withColumn("__start", F.when(F.col("__g") == F.col("first_g"), F.col("start")))
        own = own.select(*rows.columns, "__start").repartition(F.col("__chunk")).sortWithinPartitions("__chunk", "__g", "__o")
        return materialize(own.mapInPandas(_walker(size, max_repeat), schema), spark, name)

    starts = chunks.select("__chunk", "first_g", nothing.alias("start"))
    walks, state = [], None
    while True:
        done = walk(starts, f"pack-walk-{len(walks)}")
        walks.append(done)
        left = done.where("__pos is null").select("__chunk", F.col("__g").alias("last_g"), F.col("__open").alias("left"))
        new = starts.join(chunks.select("__chunk", "last_g", "n"), "__chunk").join(left, ["__chunk", "last_g"]).select(
            "__chunk", "n", "first_g", "last_g", "start", "left", F.lit(len(walks) - 1).alias("walk"))
        if state is not None:
            new = state.join(new.select("__chunk"), "__chunk", "left_anti").select(*new.columns).unionByName(new)
        state = materialize(new, spark, f"pack-state-{len(walks)}")
        before = state.select((F.col("n") + 1).alias("n"), F.col("last_g").alias("first_g"), F.col("left").alias("handed"))
        want = state.join(before, ["n", "first_g"], "left").withColumn("handed", F.coalesce("handed", nothing))
        starts = want.where(~F.col("start").eqNullSafe(F.col("handed"))).select("__chunk", "first_g", F.col("handed").alias("start"))
        if starts.isEmpty():
            break
        starts = materialize(starts, spark, f"pack-starts-{len(walks)}")

    final = state.select("__chunk", "walk")
    held = reduce(DataFrame.unionByName, [w.withColumn("walk", F.lit(i)) for i, w in enumerate(walks)]).join(final, ["__chunk", "walk"])
    # one row per group and chunk: the collections before it, of its group and of all groups
    counts = held.where("__pos is null").select("__g", "__chunk", "__seq")
    per_group = counts.groupBy("__g").agg(F.sum("__seq").alias("whole"))
    offs = per_group.select("__g", "whole", (F.sum("whole").over(Window.orderBy("__g")) - F.col("whole")).alias("off"))
    earlier = F.sum("__seq").over(Window.partitionBy("__g").orderBy("__chunk")) - F.col("__seq")
    base = counts.select("__g", "__chunk", earlier.alias("earlier")).join(offs, "__g")
    placed = held.where("__pos is not null").join(base, ["__g", "__chunk"]).withColumn("seq", F.col("earlier") + F.col("__seq"))
    return placed.where("seq < whole").select(
        (F.col("off") + F.col("seq") + 1).alias("collection_id"), "item_id", "rating", F.col("__g").alias("group"),
        F.col("__pos").alias("position"))
