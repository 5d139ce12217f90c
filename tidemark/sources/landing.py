"""JSON-lines landing files, routed to a domain by their name."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts.domains import CONTRACTS
from tidemark.contracts.model import OP, SEQUENCE, Contract
from tidemark.functions.scalars import DRIVERS, driver_key
from tidemark.operators.conform import conformed_columns
from tidemark.operators.keyed import latest_per_key
from tidemark.operators import ranks
from tidemark.sources.storage import child_names

# Columns that arrive as nested JSON and are kept as its text, and the columns a
# record cannot do without, per domain.
JSON_COLUMNS = {"payment_events": ("event",), "order_status": ("status",)}
REQUIRED = {
    "orders": ("order_id",),
    "payment_events": ("event_id", "payment_id", "event", "dt_current_timestamp"),
    "order_status": ("status_id", "status"),
}
# Fixed value: the landing key of a domain where it is not the merge key.
LANDING_KEYS = {"ratings": ("rating_id",)}

CORRUPT = "_corrupt_record"
SOURCES = {c.source: c.name for c in CONTRACTS.values()}


def domain_of(filename: str, sources: Iterable[str] = SOURCES) -> str | None:
    """The source prefix, the first two words of a file name; None for a file of no known source."""
    prefix = "_".join(filename.split("_")[:2])
    return prefix if prefix in sources else None


def with_domain(df: DataFrame, filename: Column, column: str = "domain", sources: Iterable[str] = SOURCES) -> DataFrame:
    """Rows with the source prefix of the file they came from, null for an unknown one."""
    prefix = F.regexp_extract(filename, r"^([^_]*_[^_]*)", 1)
    return df.withColumn(column, F.when(prefix.isin(*sources), prefix))


def landing_files(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in child_names(spark, folder) if n.lower().endswith(".json")]


def select_files(filenames: Iterable[str], batch: str = "all", domain: str | None = None, share: float = 0.8) -> list[str]:
    """File names of one load: the first ``share`` in name order, the rest, or all.

    Unknown files never load; ``domain`` narrows to one source before the split.
    """
    if batch not in ("initial", "incremental", "all"):
        raise ValueError(f"unknown batch: {batch!r}")
    known = sorted(n for n in filenames if domain_of(n) is not None)
    if domain:
        known = [n for n in known if domain_of(n) == domain]
    cut = int(len(known) * share)
    return {"initial": known[:cut], "incremental": known[cut:], "all": known}[batch]


def split_files(
    names: DataFrame, filename: str = "file", domain: str | None = None, share: float = 0.8, column: str = "batch"
) -> DataFrame:
    """The known files of a table of names, each told its load: ``initial`` for the first ``share``, else ``incremental``.

    As :func:`select_files`, for names that no single machine should hold: they are ordered in ranges.
    """
    known = with_domain(names, F.col(filename), "_domain").where(F.col("_domain").isNotNull())
    known = known.where(F.col("_domain") == domain) if domain else known
    placed = ranks.ranked(known.drop("_domain"), [filename])
    total = placed.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    load = F.when(F.col("_rank") < int(total * share), "initial").otherwise("incremental")
    return placed.select(*names.columns, load.alias(column))


def _text_schema(contract: Contract) -> T.StructType:
    """Every payload column as text, typed later by the contract; nested JSON stays JSON."""
    json_columns = JSON_COLUMNS.get(contract.name, ())
    columns = [
        T.StructField(f.name, T.VariantType() if f.name in json_columns else T.StringType())
        for f in contract.payload_fields
    ]
    return T.StructType([*columns, T.StructField(CORRUPT, T.StringType())])


def parse_landing(lines: DataFrame, contract: Contract, drivers: int = DRIVERS) -> DataFrame:
    """JSON lines in a column ``value`` to the contract's payload columns, other columns kept.

    Blank lines vanish and unknown fields are dropped. A line that is no JSON object, or lacks a
    column its domain cannot do without, has ``_corrupt_record`` set. Values of a wrong type
    become null, see ``conform``.
    """
    others = [c for c in lines.columns if c != "value"]
    json = F.from_json("value", _text_schema(contract), {"columnNameOfCorruptRecord": CORRUPT})
    flat = lines.filter(F.trim("value") != "").withColumn("_json", json).select(*others, "value", "_json.*")
    if contract.name == "orders":
        flat = flat.withColumn("driver_key", driver_key(F.col("driver_key"), drivers))
    required = [F.col(c).isNull() for c in REQUIRED.get(contract.name, ())]
    incomplete = reduce(lambda a, b: a | b, required, F.lit(False))
    return flat.select(
        *others,
        *conformed_columns(flat, contract),
        F.when(incomplete, F.col("value")).otherwise(F.col(CORRUPT)).alias(CORRUPT),
    )


def _lines(reader, folder: str, contract: Contract, files: Sequence[str] | None) -> DataFrame:
    """The text lines of a domain's files with their position: file name, block, line."""
    names = f"{folder}/{contract.source}_*.[jJ][sS][oO][nN]"
    paths = [f"{folder}/{n}" for n in files] if files is not None else names
    return reader.text(paths).select(
        "value",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def numbered(lines: DataFrame) -> DataFrame:
    """Lines with a ``_line`` that orders those of a block: one task reads a block in order, so a growing id does.

    For a frame that was not shuffled since it was read: a batch, or a micro-batch of :func:`landing_stream`, as a
    stream itself cannot number its rows.
    """
    return lines.withColumn("_line", F.monotonically_increasing_id())


def read_landing(
    spark: SparkSession, folder: str, contract: Contract, files: Sequence[str] | None = None
) -> DataFrame:
    """A domain's landing records, with ``_file``, ``_block`` and ``_line`` giving their order.

    Only files carrying the domain's prefix are opened; ``files`` narrows them to one load.
    """
    if files is not None and not files:
        schema = T.StructType().add("value", "string").add("_file", "string").add("_block", "long").add("_line", "long")
        return parse_landing(spark.createDataFrame([], schema), contract)
    lines = _lines(spark.read, folder, contract, files)
    return parse_landing(numbered(lines), contract)


def landing_stream(
    spark: SparkSession, folder: str, contract: Contract, files_per_trigger: int | None = None
) -> DataFrame:
    """The same records as a stream of newly arriving files; :func:`numbered` orders the lines of a micro-batch."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return parse_landing(_lines(reader, folder, contract, None), contract)


def landing_changes(
    spark: SparkSession, folder: str, contract: Contract, files: Sequence[str], op: str, loaded_at_ms: int
) -> DataFrame:
    """One load as change records: the last line per key, with its operation and commit time.

    ``files`` are the names of the load, see :func:`select_files`; those of other domains are
    passed over. An initial load has the operation ``r``, a later one ``c``. Corrupt lines are
    left out.
    """
    own = [n for n in files if domain_of(n) == contract.source]
    records = read_landing(spark, folder, contract, own)
    keys = LANDING_KEYS.get(contract.name, contract.keys)
    good = records.filter(F.col(CORRUPT).isNull())
    last = latest_per_key(good, keys, ["_file", "_block", "_line"])
    return last.withColumns({OP: F.lit(op), SEQUENCE: F.lit(loaded_at_ms).cast("bigint")}).select(
        *[f.name for f in contract.payload_fields]
    )


def load_summary(lines: DataFrame, filename: Column, failed: Column) -> DataFrame:
    """Files, records and errors per source, most records first; unknown files are one null source."""
    routed = with_domain(lines.withColumn("_name", filename).withColumn("_failed", failed), F.col("_name"))
    return (
        routed.groupBy("domain")
        .agg(
            F.count_distinct("_name").alias("files"),
            F.count_if(~F.col("_failed")).alias("records"),
            F.count_if("_failed").alias("errors"),
        )
        .orderBy(F.desc("records"), F.asc_nulls_last("domain"))
    )
