"""Fuse one entity from two sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fuse(
    left: DataFrame,
    right: DataFrame,
    on: str,
    coalesced: Sequence[str] = (),
    left_only: Mapping[str, str] | None = None,
    right_only: Mapping[str, str] | None = None,
) -> DataFrame:
    """Full outer join on ``on``; shared columns take the left value first.

    ``left_only`` and ``right_only`` map a source column to its name in the result. Null keys
    match nothing; callers take them out beforehand. Both sides hold one row per key, so no key
    can multiply rows.
    """
    a, b = left.alias("a"), right.alias("b")
    columns = [F.coalesce(f"a.{on}", f"b.{on}").alias(on)]
    columns += [F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in coalesced]
    columns += [F.col(f"a.{c}").alias(name) for c, name in (left_only or {}).items()]
    columns += [F.col(f"b.{c}").alias(name) for c, name in (right_only or {}).items()]
    return a.join(b, F.col(f"a.{on}") == F.col(f"b.{on}"), "full_outer").select(*columns)


def quarantine_shape(
    df: DataFrame, shape: T.StructType, mapping: Mapping[str, str | Column], reason: str
) -> DataFrame:
    """Rows in a fixed shape with the reason they were set aside; unmapped columns are null."""

    def column(field: T.StructField) -> Column:
        source = mapping.get(field.name)
        if source is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        return (F.col(source) if isinstance(source, str) else source).cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in shape], F.lit(reason).alias("_quarantine_reason"))
