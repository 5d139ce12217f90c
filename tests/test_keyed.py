import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import change_feed, clashing_values, flatten_envelope, latest_per_key, scd1, snapshot_diff, upsert

from tidemark.streaming import KeyedState, ValueIndex, buckets, totals_of_changes

SCHEMA = "k string, v int, __op string, __source_ts_ms bigint"
RANK = {"r": 0, "c": 1, "u": 2, None: 2, "d": 3}


def state_of(rows):
    """Plain-Python twin, for rows whose sequence and operation leave no tie."""
    latest = {}
    for r in rows:
        at = (r[3] if r[3] is not None else -1, RANK[r[2]])
        if r[0] not in latest or at >= latest[r[0]][0]:
            latest[r[0]] = (at, r)
    return {k: r[1] for k, (_, r) in latest.items() if r[2] != "d"}


def random_changes(seed, n=300):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(25)}"
        rows.append((key, i, rng.choice("rcuudd"), i))
    rng.shuffle(rows)
    return rows


def collected(df):
    return {r.k: r.v for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_scd1_matches_brute_force_in_any_order(spark, seed):
    rows = random_changes(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert collected(scd1(df, ["k"])) == state_of(rows)


def test_latest_comes_before_the_delete_test(spark):
    rows = [("a", 1, "c", 1), ("a", 2, "d", 2), ("b", 1, "d", 1), ("b", 2, "u", 2)]
    assert collected(scd1(spark.createDataFrame(rows, SCHEMA), ["k"])) == {"b": 2}


def test_missing_operation_is_an_update_and_null_sequence_is_oldest(spark):
    rows = [("a", 1, None, 5), ("a", 9, "u", None), ("b", 3, None, None)]
    assert collected(scd1(spark.createDataFrame(rows, SCHEMA), ["k"])) == {"a": 1, "b": 3}


def test_operations_break_ties_then_the_row_itself_does(spark):
    ties = [("a", 1, "r", 7), ("a", 2, "u", 7), ("a", 3, "c", 7), ("b", 1, "u", 7), ("b", 2, "d", 7), ("c", 1, "u", 7), ("c", 2, "u", 7)]
    answers = set()
    for seed in range(4):
        shuffled = random.Random(seed).sample(ties, len(ties))
        got = collected(scd1(spark.createDataFrame(shuffled, SCHEMA).repartition(3), ["k"]))
        assert got["a"] == 2 and "b" not in got
        answers.add(got["c"])
    assert len(answers) == 1


def test_composite_keys_and_unused_columns_are_pruned(spark, folder):
    spark.createDataFrame([("a", 1, "x", 1, "wide")], "k string, n int, v string, s int, w string").write.parquet(folder + "/t")
    df = latest_per_key(spark.read.parquet(folder + "/t"), ["k", "n"], ["s"]).select("k", "v")
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "w#" not in scan and "WindowGroupLimit" in scan


def test_upsert_replaces_whole_rows_and_the_last_line_wins(spark):
    target = spark.createDataFrame([("a", 1, "keep"), ("b", 2, "old")], "id string, n int, note string")
    batch = spark.createDataFrame([("b", 3, None, "f1", 1), ("b", 4, None, "f1", 2), ("c", 5, "new", "f0", 9)], "id string, n int, note string, file string, line int")
    got = sorted(tuple(r) for r in upsert(target, batch, ["id"], ["file", "line"]).collect())
    assert got == [("a", 1, "keep"), ("b", 4, None), ("c", 5, "new")]


def test_snapshot_diff_and_feed(spark):
    before = spark.createDataFrame([("a", 1), ("b", 2), ("c", None), ("e", None)], "k string, v int")
    after = spark.createDataFrame([("a", 1), ("b", 3), ("d", 4), ("c", None), ("f", None)], "k string, v int")
    assert sorted((r.k, r.change) for r in snapshot_diff(before, after, ["k"]).collect()) == [
        ("b", "update"), ("d", "insert"), ("e", "delete"), ("f", "insert"),
    ]
    assert sorted((r.k, r._change_type, r.v or 0) for r in change_feed(before, after, ["k"]).collect()) == [
        ("b", "update_postimage", 3), ("b", "update_preimage", 2), ("d", "insert", 4), ("e", "delete", 0), ("f", "insert", 0),
    ]


def test_snapshot_with_a_repeated_key_fails(spark):
    one = spark.createDataFrame([("a", 1)], "k string, v int")
    two = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(Exception, match="current|after snapshot holds several rows for key a"):
        snapshot_diff(one, two, ["k"]).collect()


def test_envelopes(spark):
    row = "struct<k:string,v:int>"
    schema = f"before {row}, after {row}, op string, ts_ms bigint, source struct<ts_ms:bigint>"
    rows = [
        (None, ("a", 1), "c", 9, (1,)), (("a", 1), ("a", 2), "u", 9, (2,)), (("a", 2), None, "d", 9, (3,)), (None, None, None, None, None),
    ]
    assert [tuple(r) for r in flatten_envelope(spark.createDataFrame(rows, schema)).collect()] == [
        ("a", 1, "c", 1), ("a", 2, "u", 2), ("a", 2, "d", 3),
    ]


# --- state over micro-batches -----------------------------------------------------------------


def keyed(spark, folder, **options):
    schema = spark.createDataFrame([], SCHEMA).schema
    return KeyedState(spark, folder + "/state", schema, ("k",), **options)


def batches(spark, rows, n):
    return [spark.createDataFrame(rows[i::n], SCHEMA) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"buckets": 1}, {"buckets": 3}, {"feed": True}, {"tie_break": ("v",)}])
def test_shuffled_micro_batches_give_the_same_state(spark, folder, options):
    rows = random_changes(11)
    state = keyed(spark, folder, **options)
    for i, batch in enumerate(batches(spark, rows, 6)):
        state.apply(batch, f"b{i}")
    assert collected(state.read()) == state_of(rows)


@pytest.mark.parametrize("feed", [False, True])
def test_replays_change_nothing(spark, folder, feed):
    rows = random_changes(3)
    state = keyed(spark, folder, feed=feed)
    parts = batches(spark, rows, 3)
    for i, batch in enumerate(parts):
        state.apply(batch, f"b{i}")
    before = sorted(map(tuple, state.changes().collect()))
    state.apply(parts[0], "b0")
    state.apply(parts[2], "b2")
    assert collected(state.read()) == state_of(rows)
    assert sorted(map(tuple, state.changes().collect())) == before and bool(before) == feed


class Died(Exception):
    pass


@pytest.mark.parametrize("feed", [False, True])
@pytest.mark.parametrize("at", range(6))
def test_a_run_that_dies_at_any_step_is_made_good(spark, folder, monkeypatch, at, feed):
    """Dying before and after the merged buckets are written beside the table, and between any two of its folders."""
    rows = random_changes(4)
    first, second = batches(spark, rows, 2)
    state = keyed(spark, folder, buckets=3, feed=feed)
    state.apply(first, "b0")
    steps, write, put = iter(range(99)), KeyedState._write, buckets.move

    def dying(act):
        def step(*args):
            if next(steps) == at:
                raise Died
            act(*args)
            if next(steps) == at:
                raise Died

        return step

    with monkeypatch.context() as patched:
        patched.setattr(KeyedState, "_write", dying(write))
        patched.setattr(buckets, "move", dying(put))
        with pytest.raises(Died):
            state.apply(second, "b1")
    state.apply(second, "b1")
    assert collected(state.read()) == state_of(rows)
    assert not list(Path(f"{state.path}.pending").glob("*"))
    if feed:
        assert _live(state.changes().collect()) == state_of(rows)


def _live(changes):
    """The rows left when images before are taken from images after."""
    left = Counter()
    for r in changes:
        left[r.k, r.v] += 1 if r._change_type in ("insert", "update_postimage") else -1
    assert set(left.values()) <= {0, 1}
    return {k: v for (k, v), n in left.items() if n}


def test_only_touched_buckets_are_rewritten(spark, folder):
    state = keyed(spark, folder, buckets=8)
    state.apply(spark.createDataFrame([(f"k{i}", i, "c", i) for i in range(200)], SCHEMA), "a")
    files = lambda: {str(p.relative_to(state.path)) for p in Path(state.path).glob("*/part-*")}
    before = files()
    state.apply(spark.createDataFrame([("k7", 700, "u", 900)], SCHEMA), "b")
    after = files()
    assert len(before) == len(after) == 8 and len(before - after) == 1
    assert collected(state.read())["k7"] == 700


def test_reading_takes_no_shuffle_and_finding_opens_one_bucket(spark, folder):
    state = keyed(spark, folder, buckets=8)
    for i in range(3):
        state.apply(spark.createDataFrame([(f"k{j}", 10 * i + j, "c", i) for j in range(100)], SCHEMA), f"b{i}")
    plan = state.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and state.read().count() == 100
    found = state.find("k42")
    assert [r.v for r in found.collect()] == [62] and "PartitionFilters: [isnotnull(bucket_of_8" in found._jdf.queryExecution().executedPlan().toString()
    assert state.find("none").collect() == [] and state.find(None).collect() == []


def test_the_number_of_buckets_stays(spark, folder):
    keyed(spark, folder, buckets=8).apply(spark.createDataFrame([("a", 1, "c", 1)], SCHEMA))
    with pytest.raises(ValueError, match="bucket_of_4"):
        keyed(spark, folder, buckets=4).read()


def test_tombstones_stop_late_changes_until_they_expire(spark, folder):
    def change(*row):
        return spark.createDataFrame([row], SCHEMA)

    state = keyed(spark, folder, buckets=1, tombstone_retention=100)
    state.apply(change("a", 1, "d", 50), "0")
    state.apply(change("a", 2, "u", 10), "1")
    assert collected(state.read()) == {}
    state.apply(change("b", 3, "c", 1000), "2")
    state.apply(change("c", 4, "c", 1001), "3")
    assert {r.k for r in state._rows().collect()} == {"b", "c"}


def test_changes_of_each_batch(spark, folder):
    state = keyed(spark, folder, feed=True)
    for i, row in enumerate([("a", 1, "c", 1), ("a", 2, "u", 2), ("a", 5, "u", 1), ("a", 2, "d", 3)]):
        state.apply(spark.createDataFrame([row, ("same", 0, "c", 0)], SCHEMA), f"b{i}")
    told = [sorted((r.k, r._change_type, r.v) for r in state.changes(f"b{i}").collect()) for i in range(4)]
    assert told == [
        [("a", "insert", 1), ("same", "insert", 0)], [("a", "update_postimage", 2), ("a", "update_preimage", 1)], [], [("a", "delete", 2)],
    ]


def test_totals_follow_the_changes(spark, folder):
    rows = random_changes(8)
    state = keyed(spark, folder, feed=True, buckets=4)
    added = Counter()
    for i, batch in enumerate(batches(spark, rows, 5)):
        state.apply(batch, f"b{i}")
        for r in totals_of_changes(state.changes(f"b{i}").withColumn("odd", F.col("v") % 2), ["odd"], ["v"]).collect():
            added[r.odd, "rows"] += r.rows
            added[r.odd, "v"] += r.v
    now = state.read().groupBy((F.col("v") % 2).alias("odd")).agg(F.count("*").alias("rows"), F.sum("v").alias("v")).collect()
    assert {k: n for k, n in added.items() if n} == {(r.odd, c): r[c] for r in now for c in ("rows", "v") if r[c]}


def test_ties_and_null_keys_do_not_depend_on_the_batches(spark, folder):
    state = keyed(spark, folder)
    parts = [[("a", 1, "u", 7), (None, 1, "u", 1)], [("a", 2, "u", 7), (None, 2, "u", 2)], [("a", 3, "c", 7), ("b", 1, "d", 1)]]
    for i, rows in enumerate(parts):
        state.apply(spark.createDataFrame(rows, SCHEMA), f"b{i}")
    whole = scd1(spark.createDataFrame([r for p in parts for r in p], SCHEMA), ["k"])
    assert collected(state.read()) == collected(whole)
    assert state.read().columns == ["k", "v", "__op", "__source_ts_ms"]


def test_reading_few_columns_of_the_state_reads_few_columns(spark, folder):
    schema = SCHEMA + ", wide string"
    state = KeyedState(spark, folder + "/s", spark.createDataFrame([], schema).schema, ("k",))
    for i in range(2):
        state.apply(spark.createDataFrame([("a", i, "u", i, "w")], schema), f"b{i}")
    df = state.read().select("k", "v")
    assert "wide" not in df._jdf.queryExecution().executedPlan().toString()
    assert collected(df) == {"a": 1}


def test_an_empty_batch_and_an_empty_state(spark, folder):
    state = keyed(spark, folder, feed=True)
    assert state.read().collect() == [] and state.changes().collect() == []
    state.apply(spark.createDataFrame([], SCHEMA), "none")
    assert state.read().collect() == [] and state.find("a").collect() == []


# --- unique values over micro-batches ----------------------------------------------------------

HOLDERS = "k string, n int, v string"


def holders(seed, n=200):
    rng = random.Random(seed)
    return [(rng.choice([None, *map(str, range(40))]), rng.choice([None, 1, 2]), rng.choice([None, *(f"v{i}" for i in range(60))])) for _ in range(n)]


@pytest.mark.parametrize("keys", [["k"], ["k", "n"]])
@pytest.mark.parametrize("seed", [1, 2])
def test_index_of_values_gives_the_batch_answer_in_any_order(spark, folder, keys, seed):
    rows = holders(seed)
    whole = spark.createDataFrame(rows, HOLDERS)
    index = ValueIndex.over(spark, f"{folder}/index", whole.schema, "v", keys, buckets=4)
    order = random.Random(seed).sample(range(5), 5)
    for i in (*order, order[0]):  # the first batch comes again at the end
        index.apply(spark.createDataFrame(rows[i::5], HOLDERS), f"b{i}")
    expected = {r.v for r in clashing_values(whole, "v", keys).collect()}
    assert {r.v for r in index.clashing().collect()} == expected and 0 < len(expected) < 60
    batch = whole.limit(20)
    flags = sorted((str(r.v), r._clashes) for r in index.flagged(batch).collect())
    assert flags == sorted((str(r.v), r.v in expected) for r in batch.collect())


def test_a_batch_opens_the_buckets_of_its_values(spark, folder):
    rows = [(f"k{i}", 1, f"v{i % 90}") for i in range(100)]
    whole = spark.createDataFrame(rows, HOLDERS)
    index = ValueIndex.over(spark, f"{folder}/index", whole.schema, "v", ["k"], buckets=32)
    index.apply(whole, "a")
    found = index.clashing(whole.where("v = 'v5'"))
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(bucket_of_32" in scan or "PartitionFilters: [isnotnull(bucket_of_32" in scan
    assert "v5" in {r.v for r in found.collect()}
