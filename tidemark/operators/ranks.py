"""The place of every row in one order over a whole table, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.storage import work_folder, written


def ranked(df: DataFrame, order: Sequence[str | Column], rank: str = "_rank") -> DataFrame:
    """``df`` with each row's place, from 0, in the given order; rows that tie get places next to each other.

    Rows are sorted in ranges, which are kept as a table. A place is the row's place in its range and the
    rows of the ranges before it; only one count per range is ever ordered by a single task.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # the id numbers the rows of a range from its number shifted by 33 bits
    told = ranged.withColumn("_part", F.spark_partition_id().cast("bigint")).withColumn("_at", F.monotonically_increasing_id())
    kept = written(told, f"{work_folder(df.sparkSession, 'ranks')}/rows")
    counts = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_at") - F.shiftleft("_part", 33)
    return kept.join(F.broadcast(starts), "_part").select(*df.columns, place.alias(rank))
