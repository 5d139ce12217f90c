"""The generic layers: typed append-only bronze, and silver with its quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tidemark.contracts.model import INGESTED_AT, OP, SEQUENCE, Contract
from tidemark.functions.scalars import instant
from tidemark.operators.conform import conform
from tidemark.operators.keyed import scd1
from tidemark.operators.quality import apply_reject, split_quarantine


def stamp(df: DataFrame, column: str, as_of=None) -> DataFrame:
    """Add an audit column holding the build time, or ``as_of`` for a repeatable run."""
    return df.withColumn(column, instant(as_of))


def bronze(source: DataFrame, contract: Contract, as_of=None) -> DataFrame:
    """Typed records with their arrival time, rows breaking a reject rule dropped.

    Works on batch and streaming frames alike.
    """
    typed = stamp(conform(source, contract), INGESTED_AT, as_of)
    return apply_reject(typed, contract, "bronze", as_of)


def silver(
    bronze_df: DataFrame, contract: Contract, as_of=None, tie_break: Sequence[str | Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(state, quarantined)`` of a batch of bronze rows: split first, then latest row per key."""
    clean, quarantined = split_quarantine(bronze_df, contract, "silver", as_of)
    return scd1(clean, contract.keys, SEQUENCE, f"{OP} = 'd'", tie_break), quarantined
