"""Uniqueness of a column that is not the merge key.

A value clashes when rows with different keys carry it; several versions of one key do not. The
check needs only the smallest and the largest value of every key column, so it is one hash
aggregation that reduces on the map side, never a distinct count.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import HEAVY_ROWS, balanced_left_join


def _several(keys: Sequence[str]) -> Column:
    """Whether a group holds more than one key: some column differs within it. A key column that is null in
    some rows of a composite key differs too; a key of one column that is null names no row."""
    differs = []
    for column in (F.col(f"`{k}`") for k in keys):
        differs.append(F.coalesce(F.min(column) != F.max(column), F.lit(False)))
        if len(keys) > 1:
            differs.append((F.count(column) > 0) & (F.count(column) < F.count(F.lit(1))))
    return reduce(lambda a, b: a | b, differs)


def _values(df: DataFrame, field: str, keys: Sequence[str], counted: Column) -> DataFrame:
    """``field, _n, _clash`` of every value that is not null."""
    return (
        df.filter(F.col(f"`{field}`").isNotNull())
        .groupBy(field)
        .agg(F.count_if(counted).alias("_n"), _several(keys).alias("_clash"))
    )


def clashing_values(df: DataFrame, field: str, keys: Sequence[str]) -> DataFrame:
    """The values of ``field`` that more than one key carries. Null never clashes."""
    return _values(df, field, keys, F.lit(True)).filter("_clash").select(field)


def _flag(df: DataFrame, values: DataFrame, field: str, keys: Sequence[str], flag: str, heavy_rows: int) -> DataFrame:
    joined = balanced_left_join(df, values, field, "_clash", F.col("_clash"), list(keys), heavy_rows)
    return joined.select(*df.columns, F.coalesce("_clash", F.lit(False)).alias(flag))


def flag_clashing(
    df: DataFrame, field: str, keys: Sequence[str], flag: str = "_clashes", heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """All rows, each told whether its value clashes within ``df``."""
    return _flag(df, _values(df, field, keys, F.lit(True)), field, keys, flag, heavy_rows)


def unique_against_target(
    batch: DataFrame,
    target: DataFrame,
    field: str,
    keys: Sequence[str],
    flag: str = "_clashes",
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """The batch, each row told whether its value clashes within the batch or with the target.

    A target row never clashes with a newer version of itself. The target is read for the value
    and key columns only, and of those rows only the ones sharing a value with the batch stay.
    """
    columns = [field, *keys]
    values = batch.select(field).filter(F.col(f"`{field}`").isNotNull()).distinct()
    touched = target.select(*columns).join(values, field, "left_semi")
    replaced = batch.select(*keys).distinct()
    standing = touched.join(replaced, list(keys), "left_anti").select(*columns, F.lit(False).alias("_new"))
    owners = batch.select(*columns, F.lit(True).alias("_new")).unionByName(standing)
    return _flag(batch, _values(owners, field, keys, F.col("_new")), field, keys, flag, heavy_rows)
