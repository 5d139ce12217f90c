"""A join that stays balanced when one key, or null, holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys with at least this many rows count as heavy; the heaviest of them, up to this number, are
# broadcast. Any other key has fewer rows than that or less than one in HEAVY_KEYS of all.
HEAVY_ROWS = 100_000
HEAVY_KEYS = 10_000
SPREAD = 4096


def balanced_left_join(
    rows: DataFrame,
    groups: DataFrame,
    on: str,
    payload: str,
    wanted: Column,
    spread_by: list[str],
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """``rows`` with the ``payload`` of their group, null where the group is not ``wanted``.

    ``groups`` holds one row per non-null key of ``rows``: the key, its row count ``_n`` and the
    payload. Heavy keys meet their group in a broadcast of bounded length. Their rows, and rows
    without a key, then pass the shuffle join spread over many keys that match nothing there.
    """
    heavy = (
        groups.filter(F.col("_n") >= heavy_rows)
        .orderBy(F.desc("_n"), on)
        .limit(HEAVY_KEYS)
        .select(on, F.lit(True).alias("_heavy"), F.when(wanted, F.col(payload)).alias("_heavy_payload"))
    )
    # Zero by way of the count: a literal would leave the join key and with it the partitioning,
    # and asking for the count here as well lets both branches share one aggregation.
    zero = F.least(F.col("_n"), F.lit(0))
    light = groups.filter(wanted & (F.col("_n") > 0)).select(
        on, zero.alias("_spread"), F.col(payload).alias("_light_payload")
    )
    aside = F.col("_heavy").isNotNull() | F.col(f"`{on}`").isNull()
    spread = 1 + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in spread_by]), F.lit(SPREAD))
    return (
        rows.join(F.broadcast(heavy), on, "left")
        .withColumn("_spread", F.when(aside, spread).otherwise(F.lit(0).cast("bigint")))
        .join(light, [on, "_spread"], "left")
        .select(*rows.columns, F.coalesce("_heavy_payload", "_light_payload").alias(payload))
    )
