"""Parquet snapshots and tables."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.contracts.model import Contract
from tidemark.functions.scalars import row_hash
from tidemark.operators.conform import conform
from tidemark.sources.storage import exists


# Files that one micro-batch of :func:`file_stream` names, and footers read at a time.
FILES_PER_BATCH = 1000
FOOTERS_AT_ONCE = 16


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a given shape, what a source that is not there yet amounts to."""
    return spark.createDataFrame([], schema)


def parquet_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None, nested: bool = False,
    bytes_per_trigger: str | int | None = None,
) -> DataFrame:
    """Stream the Parquet files newly arrived in a folder, each exactly once per checkpoint.

    ``nested``: also those in folders below, whose names add no columns. A micro-batch is bounded by a number of files,
    or by their bytes, which one file alone may pass.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", nested)
    return _limited(reader, files_per_trigger, bytes_per_trigger).parquet(path)


def _limited(reader, files: int | None, size: str | int | None):
    """At most so many files, or about so many bytes of files, in a micro-batch; Spark takes one of the two."""
    if files and size:
        raise ValueError("limit a micro-batch by files or by bytes, not by both")
    if size:
        return reader.option("maxBytesPerTrigger", size)
    return reader.option("maxFilesPerTrigger", files) if files else reader


def file_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None, bytes_per_trigger: str | int | None = None) -> DataFrame:
    """Stream the ``path`` of the Parquet files newly arrived in a folder, whatever their columns.

    Their content is not read; :func:`frames_by_schema` opens the files of a micro-batch.
    """
    reader = spark.readStream.format("binaryFile").option("pathGlobFilter", "*.parquet")
    reader = reader.schema("path string, modificationTime timestamp, length bigint, content binary")
    files = files_per_trigger if files_per_trigger or bytes_per_trigger else FILES_PER_BATCH
    return _limited(reader, files, bytes_per_trigger).load(path).select("path")


def _store_of(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it, for the stores that executors reach by URI."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3an?://", "s3://", re.sub(r"^file:/+", "/", path)))


def _reachable(path: str) -> bool:
    try:
        _store_of(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):  # a store that only Spark knows
        return False
    return True


def _footer_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path of each file and a digest of the schema in its footer; nothing else of the file is read."""
    for batch in batches:
        prints = []
        for path in batch.column("path").to_pylist():
            store, place = _store_of(path)
            with store.open_input_file(place) as file:
                footer = pq.read_metadata(file)
            told = str(footer.schema).split("\n", 1)[1].encode()  # the first line names the object in memory
            own = (footer.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
            prints.append(hashlib.sha256(told + b"\0" + own).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(prints, pa.string())], names=["path", "print"])


def frames_by_schema(batch: DataFrame) -> list[DataFrame]:
    """The files that a micro-batch of :func:`file_stream` names, one frame per schema found in their footers.

    Executors read the footers, in one job for all files; Spark then infers the schema of one file of each kind. Where
    executors cannot reach the store by themselves, Spark infers every file's. The driver holds the names of one
    micro-batch, as the file stream itself does.
    """
    spark = batch.sparkSession
    first = batch.select("path").first()
    if first is None:
        return []
    if not _reachable(first.path):
        return _frames_one_by_one(spark, [r.path for r in batch.select("path").collect()])
    tasks = max(1, spark.sparkContext.defaultParallelism)
    prints = batch.select("path").repartition(tasks).mapInArrow(_footer_prints, "path string, print string")
    groups: dict[str, list[str]] = {}
    for row in sorted(prints.collect()):
        groups.setdefault(row["print"], []).append(row.path)
    return [spark.read.schema(spark.read.parquet(names[0]).schema).parquet(*names) for names in groups.values()]


def _frames_one_by_one(spark: SparkSession, names: list[str]) -> list[DataFrame]:
    names = sorted(names)
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        schemas = list(pool.map(lambda name: spark.read.parquet(name).schema, names))
    groups: dict[str, list[str]] = {}
    for name, schema in zip(names, schemas):
        groups.setdefault(schema.json(), []).append(name)
    known = {s.json(): s for s in schemas}
    return [spark.read.schema(known[key]).parquet(*group) for key, group in groups.items()]


def write_snapshot(df: DataFrame, base: str, contract: Contract) -> str:
    """Add typed records to a domain's folder, under file names no stream has seen before."""
    path = f"{base}/{contract.name}"
    names = [f.name for f in contract.payload_fields]
    df.select(*names).write.mode("append").option("compression", contract.compression).parquet(path)
    return path


def export(spark: SparkSession, records: DataFrame | None, base: str, contract: Contract) -> str:
    """Write a topic's decoded records as typed Parquet; None, a topic that is not there, as no rows."""
    typed = empty(spark, contract.payload_type) if records is None else conform(records, contract)
    return write_snapshot(typed, base, contract)


def read_snapshot(spark: SparkSession, base: str, contract: Contract) -> DataFrame:
    """A domain's records; none, in the contract's shape, when the domain has no folder yet."""
    path = f"{base}/{contract.name}"
    if not exists(spark, path):
        return empty(spark, contract.payload_type)
    return spark.read.schema(contract.payload_type).parquet(path)


def _hashable(kind: T.DataType) -> bool:
    return isinstance(kind, T.AtomicType) and not isinstance(kind, T.VariantType)


def write_clustered(
    df: DataFrame, path: str, cluster_by: Sequence[str], compression: str = "zstd"
) -> None:
    """Full refresh of a table laid out by key ranges, so that filters on the key skip files.

    A hash of the other columns ends the range key: many rows with one key, or with none, spread
    over several files instead of filling one.
    """
    simple = [f.name for f in df.schema if _hashable(f.dataType) and f.name not in cluster_by]
    spread = [row_hash(simple)] if simple else []
    laid_out = df.repartitionByRange(*cluster_by, *spread).sortWithinPartitions(*cluster_by) if cluster_by else df
    laid_out.write.mode("overwrite").option("compression", compression).parquet(path)
