"""Distinct counts that can be added up: a sketch per group and batch, united when they are asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Binary logarithm of a sketch's slots: 4,096 slots are off by 1.6 % in two of three cases, by under 5 % in 499 of 500.
PRECISION = 12


def distinct_sketches(df: DataFrame, by: Sequence[str], column: str, precision: int = PRECISION) -> DataFrame:
    """``by, rows, sketch``: rows of each group, and what is needed to count the distinct values of ``column`` in them.

    Null values don't count. A sketch has a fixed size, whatever the group holds.
    """
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(column, F.lit(precision)).alias("sketch"))


def united(sketches: DataFrame, by: Sequence[str], count: str = "distinct_count") -> DataFrame:
    """``by, rows, count`` over all batches: a value that several batches hold counts once."""
    whole = sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), F.hll_union_agg("sketch").alias("_whole"))
    return whole.select(*by, "rows", F.hll_sketch_estimate("_whole").alias(count))
