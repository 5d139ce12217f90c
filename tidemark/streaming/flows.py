"""Streaming flows: append, split into clean and quarantined rows, keep keyed state.

Every flow processes what is there and stops; its checkpoint remembers the rest. Writes inside a
micro-batch go to a folder named after the batch, so a replay replaces its own output.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.contracts.evolution import check_evolution
from tidemark.contracts.model import INGESTED_AT, Contract
from tidemark.functions.rules import all_pass, any_fails
from tidemark.functions.scalars import instant
from tidemark.operators.conform import conform, conform_with_new
from tidemark.operators.quality import failure_counts
from tidemark.operators.sketches import distinct_sketches, united
from tidemark.sources.files import write_clustered
from tidemark.sources.storage import child_names, delete, make_folder, matching, move
from tidemark.streaming.buckets import KeyedState, ValueIndex

CLEAN, QUARANTINE = "clean", "quarantine"
METRICS = "table_name string, batch bigint, rule string, on_failure string, passed bigint, failed bigint"


def append_stream(df: DataFrame, path: str, checkpoint: str, compression: str = "zstd") -> StreamingQuery:
    """Append a stream to a Parquet table, exactly once, until it has caught up."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("compression", compression)
        .trigger(availableNow=True)
        .start(path)
    )


def _for_each_batch(df: DataFrame, checkpoint: str, handle) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query of a checkpoint; a new checkpoint numbers its batches from 0 under another."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def batch_name(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    return f"{query_id(spark, checkpoint)}-{batch_id}"


def batch_clock(spark: SparkSession, folder: str, name: str, as_of=None):
    """The moment that all jobs of a batch, and its replays, take for now: the given one, or the time of the first
    attempt, which is kept as an empty folder ``clock/<batch>=<microseconds>``."""
    if as_of is not None:
        return as_of
    kept = matching(spark, f"{folder}/clock/{name}=*")
    if not kept:
        make_folder(spark, f"{folder}/clock/{name}={time.time_ns() // 1000}")
        kept = matching(spark, f"{folder}/clock/{name}=*")
    moment = datetime.fromtimestamp(int(kept[0].rsplit("=", 1)[1]) / 1e6, timezone.utc)
    return f"{moment:%Y-%m-%d %H:%M:%S.%f} UTC"


def _write_metrics(counts, contract: Contract, scope: str, batch_id: int, folder: str, spark: SparkSession) -> None:
    """One small table of rule counts per batch: as many rows as the scope has rules."""
    rows = [
        F.struct(
            F.lit(contract.name).alias("table_name"),
            F.lit(batch_id).cast("bigint").alias("batch"),
            F.lit(r.name).alias("rule"),
            F.lit(r.on_failure).alias("on_failure"),
            F.lit(counts["rows"] - counts[r.name]).cast("bigint").alias("passed"),
            F.lit(counts[r.name]).cast("bigint").alias("failed"),
        )
        for r in contract.rules_for(scope)
    ]
    if rows:
        table = spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))
        table.write.mode("overwrite").parquet(folder)


def bronze_stream(
    df: DataFrame,
    contract: Contract,
    path: str,
    counts: str,
    checkpoint: str,
    as_of=None,
    frames: Callable[[DataFrame], Sequence[DataFrame]] | None = None,
) -> StreamingQuery:
    """Ingest a stream into a bronze table, a folder per batch, and count all its bronze rules in the same pass.

    The counts, kept in the folder ``counts``, are those of all arriving rows: the failures of a reject rule are the
    rows it drops. ``frames`` opens a batch as frames of any schema, which are held against the contract's policy:
    a forbidden change stops the query with ContractError before anything of the batch is written, a changed type is
    cast, and a new column is kept as text under its name. Without ``frames`` the batch has the decoder's columns.
    """

    def typed(frame: DataFrame) -> DataFrame:
        if frames is None:
            return conform(frame, contract)
        new = [name for name, kind, _ in check_evolution(contract, frame.schema) if kind == "new_fields"]
        for name in new:
            make_folder(frame.sparkSession, f"{counts}/columns/{quote(name, safe='')}")
        return conform_with_new(frame, contract, new)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, seen = batch.sparkSession, Observation()
        name = batch_name(spark, checkpoint, batch_id)
        now = batch_clock(spark, counts, name, as_of)
        parts = [typed(frame) for frame in (frames(batch) if frames else [batch])]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        arrived = rows.withColumn(INGESTED_AT, instant(now))
        arrived = arrived.observe(seen, *failure_counts(contract.rules_for("bronze"), contract, now))
        kept = arrived.filter(all_pass(contract.rules_for("bronze", "reject"), now, contract))
        kept.write.mode("overwrite").option("compression", contract.compression).parquet(f"{path}/batch={name}")
        _write_metrics(seen.get, contract, "bronze", batch_id, f"{counts}/metrics/batch={name}", spark)

    return _for_each_batch(df, checkpoint, handle)


def arrived_type(spark: SparkSession, contract: Contract, counts: str) -> T.StructType:
    """The stored columns of a contract, then, as text, those that its files have brought beyond it."""
    new = [unquote(name) for name in child_names(spark, f"{counts}/columns")]
    return T.StructType([*contract.record_type.fields, *[T.StructField(name, T.StringType()) for name in new]])


def read_bronze(spark: SparkSession, contract: Contract, path: str, counts: str, settled: str | None = None) -> DataFrame:
    """All batches of a bronze table: the contract's columns, then the new ones that any batch brought.

    ``settled``: the folder of the batches that :func:`settle_bronze` has rewritten.
    """
    schema = arrived_type(spark, contract, counts)
    patterns = [f"{path}/batch=*/_SUCCESS"]
    if settled:
        runs = [p.removesuffix("/_SUCCESS").rsplit("/", 1)[1] for p in matching(spark, f"{settled}/run=*/_SUCCESS")]
        waiting = [n for n in child_names(spark, f"{settled}/waiting") if n not in runs]
        patterns += [f"{settled}/{n}/_SUCCESS" for n in runs] + [f"{settled}/waiting/{n}/batch=*/_SUCCESS" for n in waiting]
    done = [p.removesuffix("/_SUCCESS") for pattern in patterns for p in matching(spark, pattern)]
    return spark.read.schema(schema).parquet(*done) if done else spark.createDataFrame([], schema)


def settle_bronze(spark: SparkSession, contract: Contract, path: str, counts: str, settled: str) -> None:
    """Rewrite the batches that a bronze table has gathered as one run of large files, laid out by ranges of its key.

    For a time when no stream writes to the table and those reading it have caught up. Batches first move aside, where they
    are still read, then count no more once their run is complete; what a run that died left aside is taken up
    first. So files follow bytes and runs instead of batches, and a filter on the key opens a minority of a run's.
    """
    runs = {p.removesuffix("/_SUCCESS").rsplit("/", 1)[1] for p in matching(spark, f"{settled}/run=*/_SUCCESS")}
    left = child_names(spark, f"{settled}/waiting")
    batches = [p.removesuffix("/_SUCCESS") for p in matching(spark, f"{path}/batch=*/_SUCCESS")]
    if batches:
        number = max([int(n.rsplit("=", 1)[1]) for n in (*runs, *left)], default=-1) + 1
        left.append(f"run={number:09d}")
        for batch in batches:
            move(spark, batch, f"{settled}/waiting/{left[-1]}/{batch.rsplit('/', 1)[1]}")
    for run in left:
        aside = f"{settled}/waiting/{run}"
        if run not in runs:
            done = [p.removesuffix("/_SUCCESS") for p in matching(spark, f"{aside}/batch=*/_SUCCESS")]
            rows = spark.read.schema(arrived_type(spark, contract, counts)).parquet(*done)
            write_clustered(rows, f"{settled}/{run}", contract.cluster_by or contract.keys, contract.compression)
        delete(spark, aside)


def _routed(batch: DataFrame, contract: Contract, scope: str, folder: str, checkpoint: str, batch_id: int, as_of) -> tuple[str, dict]:
    """Write a batch by route and count every rule, in one pass over it; returns the batch's name and the counts."""
    spark, seen = batch.sparkSession, Observation()
    rules = contract.rules_for(scope)
    name = batch_name(spark, checkpoint, batch_id)
    now = batch_clock(spark, folder, name, as_of)
    failed = any_fails([r for r in rules if r.on_failure == "quarantine" and r.check != "unique"], now, contract)
    counted = batch.observe(seen, *failure_counts(rules, contract, now))
    routed = counted.withColumn("_route", F.when(failed, QUARANTINE).otherwise(CLEAN))
    writer = routed.write.mode("overwrite").partitionBy("_route").option("compression", contract.compression)
    writer.parquet(f"{folder}/rows/batch={name}")
    return name, dict(seen.get)


def route_stream(
    df: DataFrame, contract: Contract, folder: str, checkpoint: str, scope: str = "silver", as_of=None
) -> StreamingQuery:
    """Split a stream into clean and quarantined rows and count every rule, in one pass.

    Both parts and the counts come out of a single write per batch, so the source is read once
    and nothing has to be cached.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        name, counts = _routed(batch, contract, scope, folder, checkpoint, batch_id, as_of)
        _write_metrics(counts, contract, scope, batch_id, f"{folder}/metrics/batch={name}", batch.sparkSession)

    return _for_each_batch(df, checkpoint, handle)


def read_route(spark: SparkSession, folder: str, schema: T.StructType, route: str) -> DataFrame:
    """One part of a routed stream, all batches; the other part's files are not opened."""
    base = f"{folder}/rows"
    done = {p.removesuffix("/_SUCCESS") for p in matching(spark, f"{base}/batch=*/_SUCCESS")}
    parts = [p for p in matching(spark, f"{base}/batch=*/_route={route}") if p.rsplit("/", 1)[0] in done]
    return spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)


def rule_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Rule counts of all batches of a routed stream, a replayed batch counted once."""
    done = [p.removesuffix("/_SUCCESS") for p in matching(spark, f"{folder}/metrics/batch=*/_SUCCESS")]
    return spark.read.schema(METRICS).parquet(*done) if done else spark.createDataFrame([], METRICS)


def scd1_stream(df: DataFrame, state: KeyedState, checkpoint: str) -> StreamingQuery:
    """Keep the latest row per key of a change stream; out-of-order arrival does not matter."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        state.apply(batch, batch_name(batch.sparkSession, checkpoint, batch_id))

    return _for_each_batch(df, checkpoint, handle)


def sketch_stream(df: DataFrame, by: Sequence[str], column: str, folder: str, checkpoint: str) -> StreamingQuery:
    """Keep a sketch of the distinct values of a column for every group and batch; see :func:`read_sketches`.

    A batch is reduced to one row per group, so memory does not follow the values; a replay replaces its own.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(batch.sparkSession, checkpoint, batch_id)
        distinct_sketches(batch, by, column).write.mode("overwrite").parquet(f"{folder}/batch={name}")

    return _for_each_batch(df, checkpoint, handle)


def read_sketches(spark: SparkSession, schema: T.StructType, by: Sequence[str], folder: str) -> DataFrame:
    """Rows and distinct values of every group over all batches; ``schema`` is that of the stream."""
    kind = T.StructType([*(schema[c] for c in by), T.StructField("rows", T.LongType()), T.StructField("sketch", T.BinaryType())])
    done = [p.removesuffix("/_SUCCESS") for p in matching(spark, f"{folder}/batch=*/_SUCCESS")]
    return united(spark.read.schema(kind).parquet(*done) if done else spark.createDataFrame([], kind), by)


def silver_stream(
    df: DataFrame,
    contract: Contract,
    state: KeyedState,
    quarantine: str,
    checkpoint: str,
    as_of=None,
    indexes: Mapping[str, ValueIndex] | None = None,
) -> StreamingQuery:
    """Bronze rows to silver state and quarantine, with the rule counts, under one checkpoint.

    A batch is read from bronze once: one write routes its rows and counts the rules. The clean part is
    merged into the state from there and then goes. A replay routes and merges the same rows again.

    ``indexes``, by the name of a ``unique`` rule, are brought up to date with the clean rows; the rule's failures are the
    rows of the batch whose value clashes with any row so far. They pass all the same.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name, counts = _routed(batch, contract, "silver", quarantine, checkpoint, batch_id, as_of)
        folder = f"{quarantine}/rows/batch={name}/_route={CLEAN}"
        if matching(spark, folder):
            clean = spark.read.schema(batch.schema).parquet(folder)
            for rule, index in (indexes or {}).items():
                index.apply(clean, name)
                counts[rule] = clean.join(index.clashing(clean), list(index.keys), "left_semi").count()
            state.apply(clean, name)
            delete(spark, folder)
        _write_metrics(counts, contract, "silver", batch_id, f"{quarantine}/metrics/batch={name}", spark)

    return _for_each_batch(df, checkpoint, handle)
