"""Change-record envelopes: before/after images to flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts.model import OP, SEQUENCE


def skip_tombstones(df: DataFrame, value: str = "value") -> DataFrame:
    """Without the empty messages that follow a delete."""
    return df.filter(F.col(value).isNotNull())


def flatten_envelope(df: DataFrame) -> DataFrame:
    """``{before, after, op, source.ts_ms}`` -> the row's columns, operation and commit time.

    A delete carries its before-image, every other operation its after-image. An envelope with
    neither is a tombstone and yields no row.
    """
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.coalesce("after", "before"))
    return (
        df.select(image.alias("row"), F.col("op").alias(OP), F.col("source.ts_ms").alias(SEQUENCE))
        .filter(F.col("row").isNotNull())
        .select("row.*", OP, SEQUENCE)
    )


def snapshot_plus_changes(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """The initial load as operation ``r``, followed by the changes since."""
    initial = snapshot.withColumn(OP, F.lit("r"))
    return initial.unionByName(changes, allowMissingColumns=True)
