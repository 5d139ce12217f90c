"""Keyed state as a bucketed Parquet table: SCD type 1 over micro-batches.

The table is partitioned by a hash of the key. A micro-batch merges its latest rows with the buckets that its keys
fall into and replaces those partitions; all others stay as they are. Reading is a plain scan, every key is there
once. Tombstones stay in the table, so a late change cannot revive a deleted key.

The merged buckets are first written beside the table, in full, and then their folders are put in place. A run that dies
in the middle leaves them there for the next one to put in place before anything else; one that dies earlier leaves
nothing that counts. Merging a batch again gives the same rows, so a replayed batch changes nothing. A state has one writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts.model import OP, SEQUENCE
from tidemark.functions.scalars import row_hash
from tidemark.operators.keyed import change_feed, change_order, latest_per_key, without_deletes
from tidemark.sources.storage import child_names, delete, exists, matching, move, written

TIE = "_tie"
CHANGE_TYPE = "_change_type"


@dataclass(frozen=True)
class KeyedState:
    """The current state of a change stream in the folder ``path``.

    ``buckets``: how many parts the keys are hashed into; a table keeps the number it began with. A bucket is merged by
    one task, so take as many as bring a bucket to some hundred megabytes.
    ``tombstone_retention``: deletes whose sequence lies further than this behind the newest of a batch are forgotten
    when their bucket is next rewritten; None keeps them all.
    ``feed``: keep what each batch changed, for :meth:`changes`.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    sequence_by: str = SEQUENCE
    apply_as_deletes: str = f"{OP} = 'd'"
    tie_break: tuple[str, ...] | None = None
    buckets: int = 8
    tombstone_retention: int | None = None
    feed: bool = False
    compression: str = "zstd"

    @property
    def bucket(self) -> str:
        """The partition column. Its name holds the number of buckets, so a table with another number is noticed."""
        return f"bucket_of_{self.buckets}"

    @property
    def _stored(self) -> T.StructType:
        """The rows' columns and, unless a tie-break is named, their hash, taken once on arrival."""
        tie = [] if self.tie_break else [T.StructField(TIE, T.LongType())]
        return T.StructType([*self.schema.fields, *tie, T.StructField(self.bucket, T.IntegerType())])

    def _rows(self, path: str | None = None) -> DataFrame:
        path = path or self.path
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], self._stored)
        others = [n for n in child_names(self.spark, path) if "=" in n and not n.startswith(f"{self.bucket}=")]
        if others:
            raise ValueError(f"{path} has partitions like {others[0]}, not {self.bucket}")
        return self.spark.read.schema(self._stored).parquet(path)

    def _bucket_of(self, keys: Sequence[Column]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def _arriving(self, batch: DataFrame) -> DataFrame:
        rows = batch.select(*self.schema.names)
        rows = rows if self.tie_break else rows.withColumn(TIE, row_hash(self.schema.names))
        return rows.withColumn(self.bucket, self._bucket_of([F.col(f"`{k}`") for k in self.keys]))

    def _latest(self, rows: DataFrame) -> DataFrame:
        order = change_order(rows, self.sequence_by, self.tie_break or (TIE,))
        return latest_per_key(rows, [self.bucket, *self.keys], order)

    def read(self) -> DataFrame:
        """The live rows, without a shuffle."""
        return without_deletes(self._rows(), self.apply_as_deletes).select(*self.schema.names)

    def find(self, *key) -> DataFrame:
        """The live row of one key, from its bucket alone; the rows of a bucket are sorted by key."""
        given = [F.lit(v).cast(self.schema[k].dataType) for k, v in zip(self.keys, key, strict=True)]
        same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(v) for k, v in zip(self.keys, given)])
        number = self.spark.range(1).select(self._bucket_of(given)).first()[0]
        rows = self._rows().where((F.col(self.bucket) == number) & same)
        return without_deletes(rows, self.apply_as_deletes).select(*self.schema.names)

    @property
    def _pending(self) -> str:
        return f"{self.path}.pending"

    def apply(self, batch: DataFrame, name: str = "batch") -> None:
        """Merge one micro-batch. ``name`` tells it from others; a replay has the name of the first attempt."""
        self.recover()
        if self.feed and exists(self.spark, f"{self._changes(name)}/_SUCCESS"):
            return
        work = f"{self._pending}/{name}"
        rows = self._arriving(batch)
        if self.feed:  # the keys of the batch are asked for again
            rows = written(self._latest(rows), f"{work}/fresh")
        touched = [r[0] for r in rows.select(self.bucket).distinct().collect()]
        if touched:
            fresh = rows if self.feed else self._latest(rows)
            merged = self._rows().where(F.col(self.bucket).isin(touched)).unionByName(fresh).repartition(self.bucket)
            merged = self._latest(merged)
            if self.tombstone_retention is not None:
                merged = merged.filter(~self._expired(rows))
            self._write(merged, f"{work}/merged")
        self.recover()

    def _write(self, rows: DataFrame, path: str) -> None:
        writer = rows.sortWithinPartitions(self.bucket, *self.keys).write.mode("overwrite").partitionBy(self.bucket)
        writer.option("compression", self.compression).parquet(path)

    def _put_in_place(self, merged: str) -> None:
        """Replace the partitions of the table by those written beside it; doing so again does no harm."""
        for name in child_names(self.spark, merged):
            if name.startswith(f"{self.bucket}="):
                delete(self.spark, f"{self.path}/{name}")
                move(self.spark, f"{merged}/{name}", f"{self.path}/{name}")

    def recover(self) -> None:
        """Put merged buckets in place that a run left beside the table; what it left unfinished goes."""
        for name in child_names(self.spark, self._pending):
            work = f"{self._pending}/{name}"
            if exists(self.spark, f"{work}/merged/_SUCCESS"):
                if self.feed and not exists(self.spark, f"{self._changes(name)}/_SUCCESS"):
                    self._write_changes(self._rows(f"{work}/merged"), f"{work}/fresh", name)
                self._put_in_place(f"{work}/merged")
            delete(self.spark, work)

    def _expired(self, arrived: DataFrame) -> Column:
        newest = arrived.agg(F.max(self.sequence_by)).first()[0]
        if newest is None:
            return F.lit(False)
        old = F.coalesce(F.col(self.sequence_by) < F.lit(newest - self.tombstone_retention), F.lit(True))
        return F.coalesce(F.expr(self.apply_as_deletes), F.lit(False)) & old

    def _changes(self, name: str) -> str:
        return f"{self.path}.changes/batch={name}"

    def _write_changes(self, merged: DataFrame, fresh: str, name: str) -> None:
        """What a batch changed, from the rows of its own keys before and after, in the buckets it touched."""
        touched = [int(n.rsplit("=", 1)[1]) for n in child_names(self.spark, f"{self._pending}/{name}/merged") if "=" in n]
        on = [self.bucket, *self.keys]
        own = self.spark.read.schema(self._stored).parquet(fresh).select(*on)
        own = own.toDF(*[f"_own_{i}" for i in range(len(on))])
        same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"_own_{i}")) for i, c in enumerate(on)])
        sides = (self._rows().where(F.col(self.bucket).isin(touched)), merged)
        live = [without_deletes(rows.join(own, same, "left_semi"), self.apply_as_deletes).select(*self.schema.names) for rows in sides]
        images = change_feed(*live, list(self.keys))
        images.write.mode("overwrite").option("compression", self.compression).parquet(self._changes(name))

    def changes(self, name: str | None = None) -> DataFrame:
        """What one batch changed, or all: rows with ``_change_type``, images of updates before and after."""
        done = matching(self.spark, f"{self._changes(name or '*')}/_SUCCESS")
        schema = T.StructType([*self.schema.fields, T.StructField(CHANGE_TYPE, T.StringType())])
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[p.removesuffix("/_SUCCESS") for p in done])


class ValueIndex(KeyedState):
    """For every value of a column the least and the greatest key that has carried it, over all batches so far.

    A value clashes once they differ: rows with different keys carry it, several versions of one key do not. A batch
    reads and rewrites the buckets of its own values only, in any order of arrival to the same index. Null values
    never clash, and a key of one column that is null names no row.
    """

    @classmethod
    def over(cls, spark: SparkSession, path: str, rows: T.StructType, field: str, keys: Sequence[str], **options) -> ValueIndex:
        key = T.StructType([T.StructField(k, rows[k].dataType) for k in keys])
        schema = T.StructType([T.StructField(field, rows[field].dataType), T.StructField("least", key), T.StructField("greatest", key)])
        return cls(spark, path, schema, (field,), apply_as_deletes="false", tie_break=("least",), **options)

    def _arriving(self, batch: DataFrame) -> DataFrame:
        field, keys = self.keys[0], self.schema["least"].dataType.names
        own = F.struct(*[F.col(f"`{k}`") for k in keys])
        rows = batch.where(F.col(f"`{field}`").isNotNull())
        rows = rows.where(F.col(f"`{keys[0]}`").isNotNull()) if len(keys) == 1 else rows
        return super()._arriving(rows.select(field, own.alias("least"), own.alias("greatest")))

    def _latest(self, rows: DataFrame) -> DataFrame:
        ends = rows.groupBy(self.bucket, *self.keys).agg(F.min("least").alias("least"), F.max("greatest").alias("greatest"))
        return ends.select(*rows.columns)

    def clashing(self, batch: DataFrame | None = None) -> DataFrame:
        """The values that more than one key has carried; with a batch, only its buckets are read for them."""
        rows = self._rows()
        if batch is not None:
            touched = [r[0] for r in self._arriving(batch).select(self.bucket).distinct().collect()]
            rows = rows.where(F.col(self.bucket).isin(touched))
        return rows.where("least <> greatest").select(*self.keys)

    def flagged(self, batch: DataFrame, flag: str = "_clashes") -> DataFrame:
        """The batch, each row told whether its value clashes with any row so far."""
        told = self.clashing(batch).withColumn("_found", F.lit(True))
        return batch.join(told, list(self.keys), "left").select(*batch.columns, F.col("_found").isNotNull().alias(flag))


def totals_of_changes(changes: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """``by, rows, sums``: what changes add to an aggregate, rows before them subtracted.

    Added up over all changes of a table it is the aggregate of the table; groups that have lost all rows have zero.
    """
    sign = F.when(F.col(CHANGE_TYPE).isin("insert", "update_postimage"), F.lit(1)).otherwise(F.lit(-1))
    totals = [F.sum(sign * F.col(c)).alias(c) for c in sums]
    return changes.groupBy(*by).agg(F.sum(sign).alias("rows"), *totals)
