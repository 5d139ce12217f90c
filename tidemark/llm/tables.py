"""Tables, scratch tables and connected components that several operators need."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.storage import delete, work_folder

#: Rows and bytes of text of a side that may be broadcast; beyond either the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def training_row(doc_id: str = "doc_id"):
    """Whether labels of this row may be learned from: crc32 of the id as text, modulo 4, is not 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 != 2, F.lit(False))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def small_batches(spark: SparkSession, records: int = 2000, size: int = 4 << 20) -> None:
    """Let Arrow batches to Python workers hold no more than this, so that long texts don't add up in memory.

    Larger limits of the session are lowered to these and stay so: they are read when a result is computed.
    """
    for key, most in (("maxRecordsPerBatch", records), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(str(spark.conf.get(key)))
        if not 0 < now <= most:
            spark.conf.set(key, str(most))


def bounded(small: DataFrame, limit: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``small``, broadcast if its rows, and the bytes of its texts, are counted to be no more than these."""
    texts = [f.name for f in small.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    held = sum((F.coalesce(F.octet_length(c).cast("long"), F.lit(0)) for c in texts), F.lit(0).cast("long"))
    found = small.agg(F.count("*").alias("n"), F.coalesce(F.sum(held), F.lit(0)).alias("bytes")).first()
    return F.broadcast(small) if found["n"] <= limit and found["bytes"] <= size else small


class Scratch:
    """Tables of one run below the shared working folder; :meth:`drop` removes the ones no longer read."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.folder, self.n = spark, work_folder(spark, purpose), 0

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` by way of a table: later readers don't repeat its work, and lost executors don't lose it."""
        self.n += 1
        path = f"{self.folder}/{self.n}"
        df.write.option("compression", "zstd").parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept._scratch = path
        return kept

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            if getattr(df, "_scratch", None):
                delete(self.spark, df._scratch)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of undirected ``edges`` (a, b): the smallest node it can reach.

    Union-find as joins: each round every node takes the smallest node among its neighbours as parent, parents
    are followed twice, and the edges are drawn between the parents. A round leaves at most half of the nodes
    that still have edges; nothing but edge counts reaches the driver.
    """
    live = scratch.keep(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rounds = []
    while live.count():
        both = live.union(live.select("b", "a")).toDF("node", "other")
        parent = both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("parent"))
        parent = scratch.keep(_followed(scratch.keep(parent)))
        rounds.append(parent)
        a, b = parent.toDF("a", "pa"), parent.toDF("b", "pb")
        drawn = live.join(a, "a").join(b, "b").where("pa <> pb")
        after = scratch.keep(drawn.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
        scratch.drop(live)
        live = after
    if not rounds:
        return live.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = rounds[0].toDF("node", "component")
    for parent in rounds[1:]:
        up = parent.toDF("component", "up")
        found = found.join(up, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
    return scratch.keep(found)


def _followed(parent: DataFrame, times: int = 2) -> DataFrame:
    for _ in range(times):
        up = parent.toDF("parent", "up")
        parent = parent.join(up, "parent", "left").select("node", F.coalesce("up", "parent").alias("parent"))
    return parent


def labelled_sample(docs: DataFrame, label: str, text: str, per_label: int, chars: int, max_labels: int = 200) -> dict[str, list[str]]:
    """For each of the ``max_labels`` labels with most rows, the first ``chars`` characters of the ``per_label`` distinct
    texts with the smallest hashes; of labels with equally many rows the alphabetically first count.

    At most ``max_labels * per_label * chars`` characters reach the driver. The rows chosen depend on the texts alone,
    not on their order or partitions. Null labels and empty texts don't count.
    """
    rows = docs.where(F.col(label).isNotNull() & (F.length(text) > 0))
    rows = rows.select(F.col(label).cast("string").alias("label"), F.xxhash64(text).alias("h"), F.substring(text, 1, chars).alias("head"))
    most = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(max_labels).select("label")
    rows = rows.join(F.broadcast(most), "label", "left_semi")
    chosen = rows.select("label", "h").distinct()
    for keys in (["label", F.pmod("h", F.lit(64))], ["label"]):  # a label of most rows is first ranked in 64 shares
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("h"))
        chosen = chosen.withColumn("rank", rank).where(F.col("rank") <= per_label).drop("rank")
    limits = chosen.groupBy("label").agg(F.max("h").alias("up_to")).collect()
    if not limits:
        return {}
    bound = rows.sparkSession.createDataFrame([(r["label"], r["up_to"]) for r in limits], "label string, up_to long")
    kept = rows.join(F.broadcast(bound), "label").where("h <= up_to").groupBy("label", "h").agg(F.min("head").alias("head"))
    out: dict[str, list[str]] = {r["label"]: [] for r in limits}
    for r in sorted(kept.collect(), key=lambda r: (r["label"], r["h"])):
        out[r["label"]].append(r["head"])
    return out
