import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.series import held_for, in_chunks, on_grid, rate, with_previous
from tidemark.plans import monitoring

BASE = 1_704_067_200


def samples(seed, n=400, span=4000):
    rng = random.Random(seed)
    at = sorted(rng.sample(range(span), n))
    return [("hot" if rng.random() < 0.5 else f"t{rng.randrange(3)}", BASE + t, float(rng.randrange(50))) for t in at]


def frame(spark, rows):
    return spark.createDataFrame(rows, "topic string, at bigint, value double").withColumn("ts", F.timestamp_seconds("at")).repartition(4)


def by_topic(rows):
    out = {}
    for topic, at, value in sorted(rows, key=lambda r: r[1]):
        out.setdefault(topic, []).append((at, value))
    return out


@pytest.mark.parametrize("chunk", [None, 7, 100, 100_000])
def test_previous_sample_crosses_chunks(spark, chunk):
    rows = samples(1)
    got = with_previous(frame(spark, rows), ["topic"], "ts", {"value": "before"}, chunk_seconds=chunk).collect()
    expected = {(t, a): p for t, s in by_topic(rows).items() for (a, _), p in zip(s, [None] + [v for _, v in s])}
    assert {(r.topic, r.at): r.before for r in got} == expected


@pytest.mark.parametrize("chunk", [30, 100_000])
def test_rate_matches_brute_force(spark, chunk):
    rows = samples(2)
    got = {(r.topic, int(r.end)): (r.increase, r.rate) for r in rate(frame(spark, rows), ["topic"], chunk_seconds=chunk).withColumn("end", F.unix_seconds("window_end")).collect()}
    expected = {}
    for topic, s in by_topic(rows).items():
        for end in range(BASE + 60, BASE + 4400, 60):
            inside = [(a, v) for a, v in s if end - 300 <= a < end]
            if len(inside) > 1:
                up = sum(b if b < a else b - a for (_, a), (_, b) in zip(inside, inside[1:]))
                expected[topic, end] = (up, up / (inside[-1][0] - inside[0][0]))
    assert set(got) == set(expected)
    for key, (up, per_second) in expected.items():
        assert got[key] == (up, pytest.approx(per_second))


def test_window_must_be_a_multiple_of_the_step(spark):
    with pytest.raises(ValueError):
        rate(frame(spark, samples(1)), ["topic"], window_seconds=100, step_seconds=30)


@pytest.mark.parametrize("chunk", [11, 100_000])
def test_held_conditions_match_brute_force(spark, chunk):
    rows = samples(3)
    got = held_for(frame(spark, rows), ["topic"], F.col("value") > 10, 60, chunk_seconds=chunk).collect()
    expected = set()
    for topic, s in by_topic(rows).items():
        run = []
        for a, v in [*s, (None, -1)]:
            if v > 10:
                run.append(a)
                continue
            firing = [x for x in run if x - run[0] >= 60]
            if firing:
                expected.add((topic, run[0], firing[0], firing[-1], len(firing)))
            run = []
    seconds = lambda t: int(t.timestamp())
    assert {(r.topic, seconds(r.active_since), seconds(r.firing_since), seconds(r.last_seen), r.samples) for r in got} == expected
    assert expected


@pytest.fixture
def many_ranges(spark):
    """Ranges as large data has them: none is put together with its neighbour."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_burst_is_cut_and_answers_stay(spark, many_ranges):
    rows = [(label, BASE + at, i, float(i % 7)) for i, (label, at) in enumerate([("burst", 5)] * 400 + [(None, n) for n in range(300)] + [("burst", 9)] * 100)]
    df = spark.createDataFrame(rows, "topic string, at bigint, id int, value double").withColumn("ts", F.timestamp_seconds("at")).repartition(4)
    chunks = in_chunks(df, ["topic"], "ts", ["id"]).filter("topic = 'burst'").groupBy("_chunk").count().collect()
    assert len(chunks) > 2 and max(r["count"] for r in chunks) < 300
    got = {r.id: r.before for r in with_previous(df, ["topic"], "ts", {"id": "before"}, ["id"]).collect()}
    expected = {}
    for label in ("burst", None):
        ids = [r[2] for r in sorted((r for r in rows if r[0] == label), key=lambda r: (r[1], r[2]))]
        expected |= dict(zip(ids, [None, *ids]))
    assert got == expected
    held = held_for(df, ["topic"], F.col("value") >= 0, 4, tie_break=["id"]).orderBy("topic").collect()
    assert [(r.topic, r.samples) for r in held] == [(None, 296), ("burst", 100)]


def test_ranges_match_brute_force(spark, many_ranges):
    test_previous_sample_crosses_chunks(spark, None)
    test_rate_matches_brute_force(spark, None)
    test_held_conditions_match_brute_force(spark, None)


def test_health_queries(spark):
    df = spark.createDataFrame(
        [("a", 0, 1, 5.0), ("a", 0, 2, 7.0), ("a", 1, 1, 1.0), ("__internal", 0, 1, 99.0)], "topic string, partition int, at bigint, value double"
    ).withColumn("ts", F.timestamp_seconds("at"))
    assert [tuple(r) for r in monitoring.lag_by_topic(df).collect()] == [("a", 8.0)]
    assert monitoring.total_lag(df).first().lag == 8.0
    assert monitoring.total_lag(df.limit(0)).first().lag == 0.0
    tasks = df.select(F.col("topic").alias("connector"), F.col("partition").alias("task"), "ts", (F.col("value") / 7).alias("value"))
    assert tuple(monitoring.failing_tasks(tasks).first()) == (1, pytest.approx(1 / 7))
    assert tuple(monitoring.failing_tasks(tasks.limit(0)).first()) == (0, None)


def test_alert_rules(spark):
    rows = [("a", p, 60 * i, v) for p in (0, 1) for i, v in enumerate([9000.0] * 12)]
    df = spark.createDataFrame(rows, "topic string, partition int, at bigint, value double").withColumn("ts", F.timestamp_seconds("at"))
    assert monitoring.lag_alerts(df, step_seconds=None).count() == 2
    critical = monitoring.critical_lag_alerts(df, step_seconds=None).collect()
    assert [(r.topic, r.samples) for r in critical] == [("a", 2)]
    named = df.select("ts", "value", F.lit("x").alias("cluster"), F.lit("b").alias("broker"), F.lit("c").alias("connector"), F.lit(0).alias("task"))
    one = named.dropDuplicates(["ts"])
    assert monitoring.broker_alerts(one).count() == 0 and monitoring.replica_alerts(one).count() == 1
    assert monitoring.task_alerts(one.withColumn("value", F.lit(0.5))).count() == 1


def test_a_lookback_reaches_the_scan(spark, folder):
    rows = [("a", "g", 0, at, 1.0 * at) for at in (0, 400, 500)] + [("old", "g", 0, 10, 5.0)]
    df = spark.createDataFrame(rows, "topic string, consumergroup string, partition int, at bigint, value double")
    df.withColumn("ts", F.timestamp_seconds("at")).write.parquet(f"{folder}/samples")
    kept = spark.read.parquet(f"{folder}/samples")
    recent = monitoring.lag_by_topic(kept, at="1970-01-01 00:08:00", lookback_seconds=300)
    assert [tuple(r) for r in recent.collect()] == [("a", 400.0)]
    plan = recent._jdf.queryExecution().toString()
    assert "GreaterThan(ts" in plan and "LessThanOrEqual(ts" in plan


def _grid(rows, step, lookback):
    """Newest known sample of each series at every step, by looking at all of them."""
    out = {}
    for label in {r[0] for r in rows}:
        known = sorted((at, v) for x, at, v in rows if x == label and v is not None)
        for t in range(min(at for at, _ in known) // step * step, max(at for at, _ in known) + lookback + step, step):
            seen = [v for at, v in known if t - lookback < at <= t]
            if seen:
                out[label, t] = seen[-1]
    return out


@pytest.mark.parametrize("step,lookback,chunk", [(15, 300, 4096), (60, 300, 4096), (30, 45, 8), (50, 20, 8)])
def test_grid_matches_brute_force(spark, monkeypatch, step, lookback, chunk):
    monkeypatch.setattr("tidemark.operators.series.GRID_CHUNK", chunk)
    rows = [(label, at, None if i % 5 == 0 else v) for i, (label, at, v) in enumerate(samples(6))]
    got = on_grid(frame(spark, rows), ["topic"], step, lookback).collect()
    assert len(got) == len({(r.topic, r.ts) for r in got})
    assert {(r.topic, int(r.ts.timestamp())): r.value for r in got} == _grid(rows, step, lookback)


@pytest.mark.parametrize("chunk", [None, 40])
def test_a_gap_ends_an_episode(spark, chunk):
    rows = [("a", BASE + at, 1.0) for at in [*range(0, 100, 10), *range(130, 200, 10)]]
    got = held_for(frame(spark, rows), ["topic"], F.col("value") > 0, 30, chunk_seconds=chunk, gap_seconds=10).orderBy("active_since").collect()
    assert [(int(r.active_since.timestamp()) - BASE, r.samples) for r in got] == [(0, 7), (130, 4)]


def _lags(spark, rows):
    df = spark.createDataFrame(rows, "consumer string, topic string, partition int, at bigint, value double")
    return df.withColumn("ts", F.timestamp_seconds("at")).withColumnRenamed("consumer", "group")


def test_a_group_behind_is_not_hidden_by_another(spark):
    slow = [("slow", "t", 0, BASE + 30 * i, 2000.0) for i in range(30)]
    other = [("fast", "t", 0, BASE + 30 * i + 7, 0.0) for i in range(30)]
    alone, both = (monitoring.lag_alerts(_lags(spark, rows)).collect() for rows in (slow, slow + other))
    assert alone == both and [r["group"] for r in both] == ["slow"]


def test_partitions_scraped_at_different_moments_add_up(spark):
    rows = [("g", "t", p, BASE + 30 * i + p, 6000.0) for p in (0, 1) for i in range(40)]
    found = monitoring.critical_lag_alerts(_lags(spark, rows)).collect()
    assert [r.topic for r in found] == ["t"]
    assert monitoring.critical_lag_alerts(_lags(spark, [r for r in rows if r[2] == 0])).collect() == []


def test_failed_scrapes_are_bridged_and_silence_ends_an_episode(spark):
    rows = [("g", "t", 0, BASE + 30 * i, None if i in (5, 6) else 2000.0) for i in range(30)]
    later = [("g", "t", 0, BASE + 3600 + 30 * i, 2000.0) for i in range(30)]
    found = monitoring.lag_alerts(_lags(spark, rows + later)).orderBy("active_since").collect()
    since = [int(r.active_since.timestamp()) - BASE for r in found]
    assert since == [0, 3600] and int(found[0].last_seen.timestamp()) - BASE < 29 * 30 + 300
    raw = monitoring.lag_alerts(_lags(spark, rows), step_seconds=None).collect()
    assert len(raw) == 1
