"""Time series operators that never hold a whole series in one task.

Samples are first laid out as a table in ranges of series and time. A series' part in one range is
a chunk: as long as a range is, however many samples fall into one second. Work inside a chunk runs
per ``(series, chunk)``; what a chunk needs from the past comes from one summary row per earlier
chunk, and only those summaries are ever ordered per series.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.scalars import row_hash
from tidemark.sources.storage import work_folder, written

SERIES, CHUNK = _BY_CHUNK = ("_series", "_chunk")


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def in_chunks(
    samples: DataFrame, series: Sequence[str], ts: str, tie_break: Sequence[str] = (), seconds: float | None = None
) -> DataFrame:
    """``samples`` with ``_series``, their labels, and ``_chunk``, which grows with time within a series.

    A chunk is a range partition over labels, time and tie-break (without one, a hash of the row), kept as a table so
    that all readers see the same bounds; ``spark.sql.shuffle.partitions`` says how many ranges there are at most.
    ``seconds`` cuts by time alone instead, for samples known to be evenly spread.
    """
    # one column for all labels: a label may be null, and joins tell nulls apart within a struct
    labelled = samples.withColumn(SERIES, F.struct(*series) if series else F.struct(F.lit(0)))
    if seconds:
        return labelled.withColumn(CHUNK, F.floor(_micros(ts) / F.lit(max(1, round(seconds * 1e6)))))
    ends = [F.col(c) for c in tie_break] or [row_hash(samples.columns)]
    ranged = labelled.repartitionByRange(*series, ts, *ends).withColumn(CHUNK, F.spark_partition_id().cast("bigint"))
    return written(ranged, f"{work_folder(samples.sparkSession, 'chunks')}/samples")


def _inside(ts: str, tie_break: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(SERIES, CHUNK).orderBy(ts, *tie_break)


def with_previous(
    df: DataFrame,
    series: Sequence[str],
    ts: str,
    columns: Mapping[str, str],
    tie_break: Sequence[str] = (),
    chunk_seconds: float | None = None,
) -> DataFrame:
    """Each sample with columns of the sample before it; ``columns`` maps them to their new names."""
    cut = in_chunks(df, series, ts, tie_break, chunk_seconds)
    inside = _inside(ts, tie_break)
    sample = F.struct(*[F.col(c).alias(n) for c, n in columns.items()])
    told = cut.withColumn("_previous", F.lag(sample).over(inside))
    ends = cut.withColumn("_next", F.lead(F.lit(True)).over(inside)).filter(F.col("_next").isNull())
    before = F.lag(sample).over(Window.partitionBy(SERIES).orderBy(CHUNK))
    carried = ends.select(SERIES, CHUNK, before.alias("_before"))
    previous = F.coalesce("_previous", "_before")
    return told.join(carried, list(_BY_CHUNK), "left").withColumn("_previous", previous).select(*df.columns, "_previous.*")


def rate(
    samples: DataFrame,
    series: Sequence[str],
    ts: str = "ts",
    value: str = "value",
    window_seconds: int = 300,
    step_seconds: int = 60,
    tie_break: Sequence[str] = (),
    chunk_seconds: float | None = None,
) -> DataFrame:
    """Per-second increase of a counter over sliding windows: ``series, window_end, increase, rate``.

    A value below the one before it is a counter reset and counts from zero. A window's increase
    runs from its first to its last sample; a window with a single sample has no rate. Samples
    are reduced to one row per step before they are repeated for the windows they fall into.
    """
    if window_seconds % step_seconds:
        raise ValueError("the window must be a multiple of the step")
    needed = samples.select(*dict.fromkeys([*series, ts, value, *tie_break]))
    told = with_previous(needed, series, ts, {value: "_last_value", ts: "_last_ts"}, tie_break, chunk_seconds)
    grown = F.when(F.col("_last_value").isNull(), F.lit(0.0)).when(
        F.col(value) < F.col("_last_value"), F.col(value)
    ).otherwise(F.col(value) - F.col("_last_value")).cast("double")
    step_of = lambda at: F.floor(F.unix_seconds(F.col(at).cast("timestamp")) / F.lit(step_seconds))
    first = ~F.coalesce(step_of("_last_ts") == F.col("_step"), F.lit(False))
    steps = (
        told.withColumn("_grown", grown)
        .withColumn("_step", step_of(ts))
        .groupBy(*series, "_step")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum("_grown").alias("_sum"),
            F.sum(F.when(first, F.col("_grown"))).alias("_into"),
            F.min(_micros(ts)).alias("_from"),
            F.max(_micros(ts)).alias("_to"),
        )
    )
    ends = F.sequence(F.col("_step") + 1, F.col("_step") + F.lit(window_seconds // step_seconds))
    windows = (
        steps.withColumn("_end", F.explode(ends))
        .groupBy(*series, "_end")
        .agg(
            F.sum("_n").alias("_n"),
            (F.sum("_sum") - F.min_by("_into", F.col("_step"))).alias("increase"),
            F.min("_from").alias("_from"),
            F.max("_to").alias("_to"),
        )
        .filter((F.col("_n") > 1) & (F.col("_to") > F.col("_from")))
    )
    seconds = (F.col("_to") - F.col("_from")) / F.lit(1e6)
    return windows.select(
        *series,
        F.timestamp_seconds(F.col("_end") * F.lit(step_seconds)).alias("window_end"),
        "increase",
        (F.col("increase") / seconds).alias("rate"),
    )


#: Evaluations in a chunk of :func:`on_grid`.
GRID_CHUNK = 4096


def on_grid(
    samples: DataFrame,
    series: Sequence[str],
    step_seconds: int,
    lookback_seconds: int = 300,
    ts: str = "ts",
    value: str = "value",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """``series, ts, value`` at every multiple of a step: what a series is worth to whoever looks at it then.

    That is its newest sample not after that time and less than a lookback older, so series sampled at different moments
    meet at the same times, and a null sample, a scrape that failed, is bridged. Without such a sample the series has no
    row there. Of samples within one step only the last is seen: rows are thinned to it by an aggregate before any
    is ordered, and what is then ordered together is a chunk of evaluations of one series.
    """
    step, reach = step_seconds * 1_000_000, -(-lookback_seconds // step_seconds)
    length = max(GRID_CHUNK, 4 * reach)
    at = _micros(ts)
    known = samples.where(F.col(value).isNotNull() & F.col(ts).isNotNull())
    newest = F.max(F.struct(at.alias("at"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(tie_break)], F.col(value).alias("value")))
    seen = known.groupBy(*series, F.ceil(at / F.lit(step)).alias("_slot")).agg(newest.alias("_newest"))
    last = F.floor((F.col("_newest.at") + F.lit(lookback_seconds * 1_000_000 - 1)) / F.lit(step))
    seen = seen.withColumn("_last", last).where("_last >= _slot")
    # the first slots of a chunk are shown to the chunk before it as well, whose last samples may end there
    chunk = F.floor(F.col("_slot") / F.lit(length))
    place = lambda c, own: F.struct(c.alias("chunk"), F.lit(own).alias("own"))
    places = F.when(F.pmod("_slot", F.lit(length)) <= reach, F.array(place(chunk, True), place(chunk - 1, False)))
    placed = seen.withColumn("_place", F.explode(F.coalesce(places, F.array(place(chunk, True)))))
    following = F.lead("_slot").over(Window.partitionBy(*series, "_place.chunk").orderBy("_slot"))
    until = F.least("_last", F.coalesce(following - 1, "_last"))
    spans = placed.withColumn("_until", until).where("_place.own")
    points = spans.withColumn("_at", F.explode(F.sequence("_slot", "_until")))
    return points.select(*series, F.timestamp_micros(F.col("_at") * F.lit(step)).alias(ts), F.col("_newest.value").alias(value))


def held_for(
    samples: DataFrame,
    series: Sequence[str],
    condition: Column,
    hold_seconds: int,
    ts: str = "ts",
    tie_break: Sequence[str] = (),
    chunk_seconds: float | None = None,
    gap_seconds: float | None = None,
) -> DataFrame:
    """Episodes in which a condition held for at least a period: an alert with a waiting time.

    ``series, active_since, firing_since, last_seen, samples``: when the condition became true,
    the first and the last sample at which it had held long enough, and how many there were.
    With ``gap_seconds``, samples further apart than that belong to different episodes.
    """

    def near(later: Column, earlier: Column) -> Column:
        return F.lit(True) if gap_seconds is None else later - earlier <= F.lit(round(gap_seconds * 1e6))

    holds = F.coalesce(condition, F.lit(False)).alias("_holds")
    cut = in_chunks(samples.select(*dict.fromkeys([*series, ts, *tie_break]), holds), series, ts, tie_break, chunk_seconds)
    inside = _inside(ts, tie_break)
    marked = (
        cut.withColumn("_held", F.lag("_holds").over(inside) & near(_micros(ts), F.lag(_micros(ts)).over(inside)))  # null at the start of a chunk
        .withColumn("_last", F.lead("_holds").over(inside).isNull())
        .withColumn("_begin", F.when(F.col("_holds") & ~F.col("_held"), F.col(ts)))
    )
    chunks = marked.groupBy(*_BY_CHUNK).agg(
        F.max("_begin").alias("_begin"),
        F.min(ts).alias("_from"),
        F.max(_micros(ts)).alias("_to"),
        F.bool_or(F.col("_holds") & F.col("_held").isNull()).alias("_starts"),
        F.bool_or(F.col("_holds") & F.col("_last")).alias("_ends"),
    )
    by_chunk = Window.partitionBy(SERIES).orderBy(CHUNK)
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.lag("_ends").over(by_chunk) & near(_micros("_from"), F.lag("_to").over(by_chunk))
    fresh = F.col("_starts") & ~F.coalesce(goes_on, F.lit(False))
    entered = (
        chunks.withColumn("_fresh", F.when(fresh, F.col("_from")))
        .withColumn("_newest", F.coalesce("_begin", "_fresh"))
        .select(SERIES, CHUNK, F.coalesce("_fresh", F.max("_newest").over(earlier)).alias("_entered"))
    )
    begun = F.max("_begin").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    told = marked.withColumn("_begun", begun).filter("_holds").join(entered, list(_BY_CHUNK), "left")
    held = _micros(ts) - _micros("active_since") >= F.lit(hold_seconds * 1_000_000)
    return (
        told.withColumn("active_since", F.coalesce("_begun", "_entered"))
        .filter(held)
        .groupBy(*series, "active_since")
        .agg(F.min(ts).alias("firing_since"), F.max(ts).alias("last_seen"), F.count(F.lit(1)).alias("samples"))
    )
