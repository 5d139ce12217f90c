"""Pipeline health over a table of metric samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keyed import latest_per_key
from tidemark.operators.series import GRID_CHUNK, held_for, on_grid, rate

# Topics starting like this are the broker's own; lag counts as high or critical
# above these, when it stays there for these seconds.
INTERNAL_TOPIC = "^__.*$"
LAG_HIGH, LAG_HIGH_SECONDS = 1000, 300
LAG_CRITICAL, LAG_CRITICAL_SECONDS = 10000, 600
TASK_SECONDS, BROKER_SECONDS, REPLICA_SECONDS = 120, 60, 120
# Seconds between two evaluations of the alerts, and after which a series without a sample is gone.
EVALUATION_SECONDS, LOOKBACK_SECONDS = 30, 300


def own_topics(samples: DataFrame) -> DataFrame:
    return samples.filter(~F.col("topic").rlike(INTERNAL_TOPIC))


# What tells the samples of one counter or gauge from another's: every label that the samples carry.
LABELS = ("cluster", "broker", "group", "topic", "partition", "connector", "task")


def series_of(samples: DataFrame) -> list[str]:
    return [c for c in LABELS if c in samples.columns]


def _known(samples: DataFrame) -> DataFrame:
    """Samples with a value; a null is a scrape that failed, not a zero."""
    return samples.where(F.col("value").isNotNull())


def current(samples: DataFrame, at=None, lookback_seconds: int | None = None) -> DataFrame:
    """Samples not after ``at`` and, with a lookback, not that much older; both reach the scan as a filter on ``ts``."""
    moment = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    if at is not None or lookback_seconds is not None:
        samples = samples.where(F.col("ts") <= moment)
    if lookback_seconds is not None:
        samples = samples.where(F.col("ts") > moment - F.make_dt_interval(secs=F.lit(lookback_seconds)))
    return samples


def _newest(samples: DataFrame, series: Sequence[str], tie_break: Sequence[str] = ()) -> DataFrame:
    return latest_per_key(_known(samples), series, ["ts", *tie_break])


def lag_by_topic(samples: DataFrame, tie_break: Sequence[str] = (), at=None, lookback_seconds: int | None = None) -> DataFrame:
    """Current lag per topic: the newest sample of each series added up, over groups and partitions."""
    own = current(own_topics(samples), at, lookback_seconds)
    return _newest(own, series_of(own), tie_break).groupBy("topic").agg(F.sum("value").alias("lag"))


def total_lag(samples: DataFrame, tie_break: Sequence[str] = (), at=None, lookback_seconds: int | None = None) -> DataFrame:
    own = current(own_topics(samples), at, lookback_seconds)
    return _newest(own, series_of(own), tie_break).agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("lag"))


def _summed_rate(samples: DataFrame, by: Sequence[str], tie_break: Sequence[str]) -> DataFrame:
    """The rate of every series, then their sum: a change of broker is not a reset of a counter."""
    series = series_of(samples)
    each = rate(_known(samples), series, tie_break=tie_break)
    if set(series) == set(by):
        return each
    return each.groupBy(*by, "window_end").agg(*(F.sum(c).alias(c) for c in each.columns if c not in (*series, "window_end")))


def message_rate(samples: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Five-minute rate of a message or byte counter, per topic."""
    return _summed_rate(own_topics(samples), ["topic"], tie_break)


def total_rate(samples: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Five-minute rate of a counter over all topics together, the broker's own included."""
    return _summed_rate(samples, [], tie_break).select("window_end", "rate")


def error_rate(samples: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Five-minute rate of an error counter, per task."""
    return _summed_rate(samples, ["connector", "task"], tie_break)


def running_tasks(samples: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Tasks running now: the newest count of each series added up."""
    return _newest(samples, series_of(samples), tie_break).agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("running"))


def failing_tasks(samples: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Tasks now running below full ratio, zero when there is none, and the lowest ratio."""
    newest = _newest(samples, series_of(samples), tie_break)
    return newest.agg(
        F.count_if(F.col("value") < 1).alias("failed_tasks"), F.min("value").alias("lowest_ratio")
    )


def alerts(
    samples: DataFrame,
    by: Sequence[str],
    condition: Column,
    hold_seconds: int,
    tie_break: Sequence[str] = (),
    step_seconds: int | None = EVALUATION_SECONDS,
    lookback_seconds: int = LOOKBACK_SECONDS,
) -> DataFrame:
    """Episodes of a condition on ``value`` held for a period, for every combination of the labels ``by``.

    The condition is looked at every ``step_seconds``: each series, told apart by all labels that the samples carry,
    counts with its newest known sample of the last ``lookback_seconds``, and series that share the labels ``by`` are
    added up. So consumer groups don't hide each other, partitions scraped at different moments add up, a failed scrape is
    bridged, and an episode ends when nothing was scraped for a lookback. ``step_seconds=None`` takes every known sample
    for a look of its own, without adding up.
    """
    if step_seconds is None:
        return held_for(_known(samples), by, condition, hold_seconds, tie_break=tie_break)
    series = series_of(samples)
    seen = on_grid(samples, series, step_seconds, lookback_seconds, tie_break=tie_break)
    if set(by) != set(series):
        seen = seen.groupBy(*by, "ts").agg(F.sum("value").alias("value"))
    return held_for(seen, by, condition, hold_seconds, chunk_seconds=GRID_CHUNK * step_seconds, gap_seconds=step_seconds)


def lag_alerts(samples: DataFrame, tie_break: Sequence[str] = (), **evaluation) -> DataFrame:
    """Episodes of high lag of each series: of a group on a partition of a topic. ``evaluation`` goes to :func:`alerts`."""
    own = own_topics(samples)
    return alerts(own, series_of(own), F.col("value") > LAG_HIGH, LAG_HIGH_SECONDS, tie_break, **evaluation)


def critical_lag_alerts(samples: DataFrame, tie_break: Sequence[str] = (), **evaluation) -> DataFrame:
    """Episodes of critical lag per topic, over the sum of its groups and partitions.

    With ``step_seconds=None`` only samples of one moment are added up.
    """
    own = own_topics(samples)
    if evaluation.get("step_seconds", 0) is None:
        own, tie_break = own.groupBy("topic", "ts").agg(F.sum("value").alias("value")), ()
    return alerts(own, ["topic"], F.col("value") > LAG_CRITICAL, LAG_CRITICAL_SECONDS, tie_break, **evaluation)


def task_alerts(samples: DataFrame, tie_break: Sequence[str] = (), **evaluation) -> DataFrame:
    return alerts(samples, series_of(samples), F.col("value") < 1, TASK_SECONDS, tie_break, **evaluation)


def broker_alerts(samples: DataFrame, tie_break: Sequence[str] = (), **evaluation) -> DataFrame:
    return alerts(samples, series_of(samples), F.col("value") < 1, BROKER_SECONDS, tie_break, **evaluation)


def replica_alerts(samples: DataFrame, tie_break: Sequence[str] = (), **evaluation) -> DataFrame:
    return alerts(samples, series_of(samples), F.col("value") > 0, REPLICA_SECONDS, tie_break, **evaluation)
