"""Keyed state: latest row per key, SCD type 1, upsert, snapshot comparison.

The latest row is ``row_number() = 1`` over a total order. Spark turns that into a group limit on
both sides of the shuffle: every map task keeps one row per key, so a key holding a third of all
rows reaches its reducer as one row per map task. Columns nobody reads afterwards are pruned from
the scan, which an aggregate over whole-row structs would prevent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contracts.model import OP, SEQUENCE
from tidemark.functions.scalars import op_rank, row_hash

Deletes = Column | str | None


def _column(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def _condition(c: Column | str) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def change_order(
    df: DataFrame, sequence_by: str | Column = SEQUENCE, tie_break: Sequence[str | Column] | None = None
) -> list[Column]:
    """Total order of change records: sequence, then operation, then a tie-break.

    Nulls come first. Without a given tie-break a hash of the whole row decides, which any order
    of arrival answers alike; naming a tie-break spares reading the other columns for it.
    """
    op = [op_rank(F.col(OP))] if OP in df.columns else []
    last = [_column(c) for c in tie_break] if tie_break else [row_hash(df.columns)]
    return [_column(sequence_by), *op, *last]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], apply_as_deletes: Deletes = None
) -> DataFrame:
    """The row ranked highest per key, then without the keys whose latest row is a delete.

    The delete test comes second on purpose: testing first would bring the row before the
    delete back to life.
    """
    ranking = Window.partitionBy(*[_column(k) for k in keys]).orderBy(*[_column(c).desc_nulls_last() for c in order])
    latest = df.withColumn("_place", F.row_number().over(ranking)).filter(F.col("_place") == 1).drop("_place")
    return without_deletes(latest, apply_as_deletes)


def without_deletes(df: DataFrame, apply_as_deletes: Deletes) -> DataFrame:
    if apply_as_deletes is None:
        return df
    return df.filter(~F.coalesce(_condition(apply_as_deletes), F.lit(False)))


def scd1(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Column = SEQUENCE,
    apply_as_deletes: Deletes = f"{OP} = 'd'",
    tie_break: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Current state of a change stream: last change per key wins, deletes remove the key.

    A change without an operation counts as an update.
    """
    return latest_per_key(df, keys, change_order(df, sequence_by, tie_break), apply_as_deletes)


def upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], sequence_by: Sequence[str | Column]
) -> DataFrame:
    """Write a batch over a target: the batch's last row per key replaces the whole target row.

    ``sequence_by`` orders rows within the batch, for instance file name, block and line.
    """
    ranks = [f"_order{i}" for i in range(len(sequence_by))]
    fresh = batch.select(
        *target.columns, F.lit(1).alias("_fresh"), *[_column(c).alias(r) for c, r in zip(sequence_by, ranks)]
    )
    kept = target.withColumn("_fresh", F.lit(0))
    both = kept.unionByName(fresh, allowMissingColumns=True)
    return latest_per_key(both, keys, ["_fresh", *ranks]).drop("_fresh", *ranks)


def one_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Guard for a dimension joined on something other than its merge key."""
    return latest_per_key(df.dropna(subset=list(keys)), keys, order)


def _single_rows(df: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """The keys and the other columns as a struct; a key occurring twice fails the job that reads the result."""
    rest = [c for c in df.columns if c not in set(keys)]
    named = F.concat_ws(", ", *[_column(k).cast("string") for k in keys])
    message = F.concat(F.lit(f"{side} snapshot holds several rows for key "), named)
    repeated = F.count(F.lit(1)).over(Window.partitionBy(*[_column(k) for k in keys])) > 1
    row = F.struct(*[_column(c) for c in rest])
    return df.select(*[_column(k) for k in keys], F.when(repeated, F.raise_error(message)).otherwise(row).alias(side))


def snapshot_diff(previous: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, change, before, after`` for every key that two full snapshots hold differently.

    Rows are sorted by key once a side: repeated keys are looked for in the order that the join needs anyway.
    """
    same_columns = [c for c in previous.columns if c in current.columns]
    before = _single_rows(previous.select(*same_columns), keys, "before").withColumn("_had", F.lit(True))
    after = _single_rows(current.select(*same_columns), keys, "after").withColumn("_has", F.lit(True))
    change = (
        F.when(F.col("_had").isNull(), "insert")
        .when(F.col("_has").isNull(), "delete")
        .when(~F.col("before").eqNullSafe(F.col("after")), "update")
    )
    return (
        before.join(after, list(keys), "full_outer")
        .withColumn("change", change)
        .filter(F.col("change").isNotNull())
        .select(*keys, "change", "before", "after")
    )


def change_feed(previous: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The difference as rows: ``_change_type`` is insert, update_preimage, update_postimage or delete."""
    diff = snapshot_diff(previous, current, keys)
    image = lambda kind, side: F.struct(F.lit(kind).alias("_change_type"), F.col(side).alias("_row"))
    images = (
        F.when(F.col("change") == "insert", F.array(image("insert", "after")))
        .when(F.col("change") == "delete", F.array(image("delete", "before")))
        .otherwise(F.array(image("update_preimage", "before"), image("update_postimage", "after")))
    )
    return diff.select(*keys, F.inline(images)).select(*keys, "_row.*", "_change_type")
