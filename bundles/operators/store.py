"""A kept recommender: mined once, written as versioned tables, served by joins.

``fit`` mines the collections and writes every table that the item cascade reads
(rules by antecedent item, normalised similarity and co-occurrence edges,
popularity ranks, the catalog and item metadata) below ``<path>/v<number>``.
Tables that are joined on an item are bucketed by it, so that serving shuffles
the asked baskets and not the tables.  A version counts once its manifest is
written, which comes last; a fit that dies leaves nothing that ``load`` sees.
``load`` only reads; ``recommend`` runs no mining.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collections as col
from . import edges as ed
from . import mining as mn
from . import recommend as rec

#: Buckets of a table that is joined on an item.
BUCKETS = 16
#: Table -> the column that it is bucketed by (none: not bucketed).
TABLES = {"antecedents": "item_id", "rules": "rule_id", "similarity": "item1", "cooccurrence": "item1", "popularity": "pop_rank",
          "catalog": "item_id", "metadata": "item_id"}
STRATEGIES = (("association_rules", 1.0), ("item_similarity", 0.8), ("co_occurrence", 0.6), ("popularity", 0.4))
RESULT = ("basket_id", "item_id", "rank", "recommendation_score", "recommendation_method", "price", "title", "description", "category", "image_url")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at, jvm


def versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions, oldest first."""
    fs, at, jvm = _fs(spark, f"{path}/manifest")
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n) for n in names if n.isdigit())


def fit(spark: SparkSession, members: DataFrame, products: DataFrame, path: str, images: DataFrame | None = None) -> int:
    """Mine ``members`` (collection_id, item_id) and write the next version; returns its number."""
    members = members.select("collection_id", "item_id").cache()
    txn = col.transactions(members).cache()
    n = txn.count()
    choice = mn.adaptive_support(txn)
    patterns = choice.itemsets if choice.itemsets is not None else spark.createDataFrame([], "items array<string>, freq bigint")
    every = mn.association_rules(patterns, min(mn.CONFIDENCE_STEPS), n)
    least = mn.pick_confidence(every)
    ante, rules = rec.rule_tables(mn.one_per_antecedent(every.where(F.col("confidence") >= (2.0 if least is None else least))))
    catalog = members.select("item_id").distinct()
    frames = {"antecedents": ante, "rules": rules, "similarity": ed.similarity_edges(members, normalize=True, assume_distinct=True),
              "cooccurrence": ed.cooccurrence_edges(patterns, normalize=True), "popularity": ed.rank_popularity(ed.popularity(patterns)),
              "catalog": catalog, "metadata": rec.enrich(catalog, products, images)}
    version = max(versions(spark, path), default=0) + 1
    name = uuid.uuid4().hex[:12]  # of this attempt, so that a lost one is never mixed in
    tables = {}
    for table, frame in frames.items():
        where, key = f"{path}/v{version}-{name}/{table}", TABLES[table]
        made = f"kept_{name}_{table}"
        frame.repartition(BUCKETS, key).write.bucketBy(BUCKETS, key).sortBy(key).option("path", where).format("parquet").saveAsTable(made)
        tables[table] = {"path": where, "schema": frame.schema.simpleString()[7:-1], "rows": spark.table(made).count()}
        spark.sql(f"drop table {made}")  # the files stay
    members.unpersist()
    txn.unpersist()
    manifest = {"version": version, "support": choice.support, "status": choice.status, "confidence": least, "transactions": n, "tables": tables}
    fs, at, jvm = _fs(spark, f"{path}/manifest/{version}")
    out = fs.create(at, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    return version


class Kept:
    """One version, read from its tables."""

    def __init__(self, spark: SparkSession, path: str, version: int | None = None):
        have = versions(spark, path)
        if not have or (version is not None and version not in have):
            raise FileNotFoundError(f"no version {version or ''} below {path}")
        self.spark, self.path, self.version = spark, path, version or have[-1]
        lines = spark.read.text(f"{path}/manifest/{self.version}").collect()
        self.manifest = json.loads("".join(r.value for r in lines))

    def table(self, name: str) -> DataFrame:
        """A table with its buckets known to the planner."""
        told = self.manifest["tables"][name]
        own = "kept_" + told["path"].rstrip("/").split("/")[-2].replace("-", "_") + "_" + name
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(told["path"]).schema.fields)
        self.spark.sql(f"create table if not exists {own} ({fields}) using parquet clustered by ({TABLES[name]}) "
                       f"sorted by ({TABLES[name]}) into {BUCKETS} buckets location '{told['path']}'")
        return self.spark.table(own)

    def recommend(self, baskets: DataFrame, n: int = 5) -> DataFrame:
        """At most ``n`` rows per basket of ``baskets(basket_id, item_id)`` with score, method and item metadata.

        Empty if no rules were found, as the reference answers; baskets without
        a known item get no rows.
        """
        if not self.manifest["tables"]["rules"]["rows"]:
            kind = baskets.schema["basket_id"].dataType.simpleString()
            return self.spark.createDataFrame([], f"basket_id {kind}, item_id string, rank int, recommendation_score double, "
                                                  "recommendation_method string, price double, title string, description string, category string, image_url string")
        found = rec.per_distinct_basket(self._cascade, baskets, n)
        whole = found.join(self.table("metadata"), "item_id", "left")
        return whole.select(*[F.col(c).cast("int") if c == "rank" else c for c in RESULT])

    def _cascade(self, baskets: DataFrame, n: int) -> DataFrame:
        catalog = self.table("catalog")
        known = rec.known_items(baskets, catalog)
        frames = (rec.by_rule_tables(known, self.table("antecedents"), self.table("rules"), n),
                  rec.by_edges(known, self.table("similarity"), catalog, n), rec.by_edges(known, self.table("cooccurrence"), catalog, n),
                  rec.by_popularity(known, self.table("popularity"), catalog, n))
        return rec.cascade([rec.Strategy(name, weight, frame) for (name, weight), frame in zip(STRATEGIES, frames)], n)
