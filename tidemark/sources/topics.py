"""Message topics: bounded and streaming reads, wire format, and the choice of source."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from urllib.request import urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts.model import Contract
from tidemark.functions.scalars import strip_wire_header
from tidemark.operators.envelope import skip_tombstones
from tidemark.sources.files import parquet_stream

REGISTRY_TIMEOUT_SECONDS = 30


@dataclass(frozen=True)
class RateLimits:
    """Most records per micro-batch, by domain."""

    # The default and the one domain with a limit of its own.
    default: int = 1000
    overrides: Mapping[str, int] = field(default_factory=lambda: {"order_items": 5000}, hash=False)

    def of(self, contract: Contract) -> int:
        return self.overrides.get(contract.name, self.default)


def _options(contract: Contract, servers: str, starting: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": contract.topic, "startingOffsets": starting}


def topic_stream(
    spark: SparkSession, contract: Contract, servers: str, starting: str = "earliest", limits: RateLimits | None = None
) -> DataFrame:
    """Raw messages of a domain's topic as a stream, tombstones skipped; batches are as large as what is there,
    unless ``limits`` bound them."""
    reader = spark.readStream.format("kafka").options(**_options(contract, servers, starting))
    if limits is not None:
        reader = reader.option("maxOffsetsPerTrigger", limits.of(contract))
    return skip_tombstones(reader.load())


def topic_batch(spark: SparkSession, contract: Contract, servers: str, starting: str = "earliest") -> DataFrame:
    """All messages up to the newest offset at the time of the call, all partitions in parallel."""
    reader = spark.read.format("kafka").options(**_options(contract, servers, starting))
    return skip_tombstones(reader.option("endingOffsets", "latest").load())


def registry_schema(url: str, topic: str, open_url: Callable = urlopen) -> str:
    """The newest registered Avro schema of a topic's values."""
    address = f"{url.rstrip('/')}/subjects/{topic}-value/versions/latest"
    with open_url(address, timeout=REGISTRY_TIMEOUT_SECONDS) as response:
        return json.loads(response.read())["schema"]


def decode_avro(messages: DataFrame, schema: str) -> DataFrame:
    """Registry-framed Avro messages to their columns; needs the spark-avro package."""
    from pyspark.sql.avro.functions import from_avro

    return messages.select(from_avro(strip_wire_header(F.col("value")), schema).alias("d")).select("d.*")


def decode_json(messages: DataFrame, contract: Contract, framed: bool = True) -> DataFrame:
    """JSON messages, registry-framed or bare, to the contract's payload columns."""
    body = strip_wire_header(F.col("value")) if framed else F.col("value")
    return messages.select(F.from_json(body.cast("string"), contract.payload_type).alias("d")).select("d.*")


def source_stream(spark: SparkSession, contract: Contract, mode: str, conf: Mapping[str, str]) -> DataFrame:
    """A domain's change records as a stream, from its topic or from exported Parquet files.

    What follows is the same either way. For mode ``kafka``, ``conf`` names ``bootstrap`` and
    ``registry`` and may set ``starting`` and ``max_offsets`` per micro-batch, for all domains. For mode ``volume`` it names ``base`` and may set
    ``files_per_trigger``.
    """
    if mode == "kafka":
        schema = registry_schema(conf["registry"], contract.topic)
        limits = RateLimits(int(conf["max_offsets"]), {}) if "max_offsets" in conf else None
        messages = topic_stream(spark, contract, conf["bootstrap"], conf.get("starting", "earliest"), limits)
        return decode_avro(messages, schema)
    if mode == "volume":
        files = int(conf["files_per_trigger"]) if "files_per_trigger" in conf else None
        return parquet_stream(spark, f"{conf['base']}/{contract.name}", contract.payload_type, files)
    raise ValueError(f"unknown source mode: {mode!r}")
