import io
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.contracts import contract
from tidemark.operators import latest_per_key
from tidemark.operators.ranks import ranked
from tidemark.sources import (
    RateLimits,
    decode_json,
    domain_of,
    landing_changes,
    landing_files,
    landing_stream,
    load_summary,
    numbered,
    parquet_stream,
    read_landing,
    read_snapshot,
    registry_schema,
    select_files,
    source_stream,
    split_files,
    topic_stream,
    with_domain,
    write_clustered,
    write_snapshot,
)
from tidemark.sources import files
from tidemark.sources.storage import work_folder
from tidemark.streaming import append_stream, read_sketches, sketch_stream


def put(folder, name, *records):
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))


ORDER = {"order_id": "o1", "user_key": "u", "restaurant_key": "r", "driver_key": "wr2179397", "total_amount": 5, "order_date": "2024-01-01 10:00:00.25", "x": 1}


def test_domain_of():
    assert domain_of("kafka_orders_01.json") == "kafka_orders"
    assert domain_of("mysql_menu_x_y.json") == "mysql_menu"
    assert domain_of("orders.json") is None and domain_of("kafka_orders2_1.json") is None and domain_of("kafka_orders.json") is None


def test_with_domain_agrees(spark):
    names = ["kafka_orders_01.json", "orders.json", "kafka_orders2_1.json", "mssql_users_7.json", "kafka_orders.json", ""]
    got = with_domain(spark.createDataFrame([(n,) for n in names], "f string"), F.col("f")).collect()
    assert [r.domain for r in got] == [domain_of(n) for n in names]


def test_select_files():
    names = [f"kafka_orders_{i}.json" for i in range(5)] + ["mysql_menu_0.json", "junk.json"]
    assert select_files(names, "initial", "kafka_orders") == names[:4]
    assert select_files(names, "incremental", "kafka_orders") == names[4:5]
    assert select_files(names) == names[:6]
    assert select_files(names, "initial") + select_files(names, "incremental") == select_files(names)
    with pytest.raises(ValueError):
        select_files(names, "some")


def test_read_landing(spark, folder):
    put(folder, "kafka_orders_1.JSON", ORDER, "", "   ", "{broken", {**ORDER, "order_id": "o2", "driver_key": ""})
    put(folder, "kafka_status_1.json", {"status_id": 1})
    rows = read_landing(spark, folder, contract("orders")).orderBy("_line").collect()
    assert [r.order_id for r in rows] == ["o1", None, "o2"]
    assert [r._corrupt_record for r in rows] == [None, "{broken", None]
    assert (rows[0].driver_key, rows[0].total_amount, rows[0].order_date.microsecond) == (str(2179397 % 354 + 1), 5.0, 250000)
    assert rows[2].driver_key is None and "x" not in rows[0].asDict()
    assert landing_files(spark, folder) == ["kafka_orders_1.JSON", "kafka_status_1.json"]


def test_nested_json_is_kept_as_text_and_required_fields_are_required(spark, folder):
    put(folder, "kafka_status_1.json", {"status_id": 1, "status": {"status_name": "new", "t": 1}}, {"status_id": 2, "status": "new"}, {"status_id": 3})
    rows = read_landing(spark, folder, contract("order_status")).orderBy("_line").collect()
    assert [r.status for r in rows] == ['{"status_name":"new","t":1}', '"new"', None]
    assert [r._corrupt_record is None for r in rows] == [True, True, False]


def test_landing_changes_keep_the_last_line_per_key(spark, folder):
    for i in range(5):
        put(folder, f"kafka_orders_{i}.json", {**ORDER, "total_amount": i}, {**ORDER, "order_id": f"n{i}"})
    put(folder, "mysql_menu_1.json", {"menu_section_id": "s"})
    names = landing_files(spark, folder)
    initial = select_files(names, "initial", "kafka_orders") + ["mysql_menu_1.json"]
    first = {r.order_id: r for r in landing_changes(spark, folder, contract("orders"), initial, "r", 1).collect()}
    assert first["o1"].total_amount == 3 and len(first) == 5
    assert {(r["__op"], r["__source_ts_ms"]) for r in first.values()} == {("r", 1)}
    rest = select_files(names, "incremental", "kafka_orders")
    later = landing_changes(spark, folder, contract("orders"), rest, "c", 2).collect()
    assert sorted(r.order_id for r in later) == ["n4", "o1"] and {r["__op"] for r in later} == {"c"}
    assert landing_changes(spark, folder, contract("routes"), names, "r", 1).count() == 0


def test_ratings_land_by_their_own_key(spark, folder):
    put(folder, "mysql_ratings_1.json", {"rating_id": 1, "uuid": "a", "rating": 4}, {"rating_id": 1, "uuid": "b", "rating": 5})
    names = landing_files(spark, folder)
    assert [r.uuid for r in landing_changes(spark, folder, contract("ratings"), names, "r", 1).collect()] == ["b"]


def test_lines_of_a_streamed_file_keep_their_order(spark, folder):
    c = contract("orders")
    put(folder, f"{c.source}_1.json", *[{**ORDER, "order_id": f"o{i % 2}", "total_amount": float(i)} for i in range(40)])
    seen = []

    def handle(batch, _):
        last = latest_per_key(numbered(batch), ["order_id"], ["_file", "_block", "_line"])
        seen.extend((r.order_id, r.total_amount) for r in last.collect())

    stream = landing_stream(spark, folder, c)
    stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start().awaitTermination()
    assert sorted(seen) == [("o0", 38.0), ("o1", 39.0)]


def test_landing_stream_sees_new_files_once(spark, folder):
    (landing := f"{folder}/in"), (out := f"{folder}/out")
    import os

    os.mkdir(landing)
    put(landing, "kafka_orders_1.json", ORDER)
    run = lambda: append_stream(landing_stream(spark, landing, contract("orders"), 1), out, f"{folder}/cp").awaitTermination()
    run()
    run()
    assert spark.read.parquet(out).count() == 1
    put(landing, "kafka_orders_2.json", {**ORDER, "order_id": "o2"})
    run()
    assert sorted(r.order_id for r in spark.read.parquet(out).collect()) == ["o1", "o2"]


def test_load_summary(spark):
    df = spark.createDataFrame([("kafka_orders_1", 0), ("kafka_orders_2", 0), ("kafka_orders_2", 1), ("other", 0)], "f string, bad int")
    got = [tuple(r) for r in load_summary(df, F.col("f"), F.col("bad") == 1).collect()]
    assert got == [("kafka_orders", 2, 2, 1), (None, 1, 1, 0)]


def test_snapshots_accumulate_and_missing_ones_are_empty(spark, folder):
    c = contract("orders")
    assert read_snapshot(spark, folder, c).count() == 0
    df = spark.createDataFrame([("a",)], c.payload_type.fieldNames()[0] + " string")
    from tidemark.operators import conform

    write_snapshot(conform(df, c), folder, c)
    write_snapshot(conform(df, c), folder, c)
    got = read_snapshot(spark, folder, c)
    assert got.count() == 2 and got.schema == c.payload_type


def test_clustered_files_hold_disjoint_key_ranges(spark, folder):
    write_clustered(spark.range(100_000).withColumn("v", F.col("id") % 7), folder + "/t", ["id"])
    ranges = spark.read.parquet(folder + "/t").groupBy(F.input_file_name()).agg(F.min("id"), F.max("id")).collect()
    bounds = sorted((r[1], r[2]) for r in ranges)
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))


def test_a_key_with_most_rows_fills_several_files(spark, folder):
    df = spark.range(200_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_clustered(df, folder + "/t", ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = spark.read.parquet(folder + "/t")
    sizes = [r[1] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert back.count() == 200_000 and max(sizes) < 100_000


def test_rate_limits():
    assert RateLimits().of(contract("order_items")) == 5000 and RateLimits().of(contract("orders")) == 1000


def test_registry_schema_asks_for_the_latest_value_schema():
    asked = []

    def answer(url, timeout):
        asked.append((url, timeout))
        return io.BytesIO(json.dumps({"schema": "{}"}).encode())

    assert registry_schema("http://registry/", "pg.public.orders", answer) == "{}"
    assert asked == [("http://registry/subjects/pg.public.orders-value/versions/latest", 30)]


def test_framed_json_messages(spark):
    body = spark.sql("""SELECT concat(unhex('0000000001'), encode('{"order_id":"1","total_amount":2.5,"__op":"c"}', 'utf-8')) AS value""")
    row = decode_json(body, contract("orders")).first()
    assert (row.order_id, row.total_amount, row["__op"], row.user_key) == ("1", 2.5, "c", None)


def test_unknown_source_mode(spark):
    with pytest.raises(ValueError, match="unknown source mode"):
        source_stream(spark, contract("orders"), "carrier pigeon", {})


def test_topics_need_their_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        topic_stream(spark, contract("orders"), "localhost:9092")


def test_work_folder_is_below_the_named_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark, "x").startswith(base) and work_folder(spark, "x") != work_folder(spark, "x")


def test_footers_are_read_together_and_schemas_inferred_once_each(spark, folder, monkeypatch):
    for i in range(12):
        spark.createDataFrame([(i,)], "a int" if i % 3 else "a bigint").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    spark.createDataFrame([(99, "x")], "a int, b string").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    paths = [f"file://{p}" for p in Path(f"{folder}/in").glob("*.parquet")]
    batch = spark.createDataFrame([(p,) for p in paths], "path string")
    monkeypatch.setattr(files, "_frames_one_by_one", None)
    frames = files.frames_by_schema(batch)
    assert sorted(f.schema.simpleString() for f in frames) == ["struct<a:bigint>", "struct<a:int,b:string>", "struct<a:int>"]
    assert sorted(r.a for f in frames for r in f.collect()) == [*range(12), 99]
    assert files.frames_by_schema(batch.limit(0)) == []


def test_stores_that_only_spark_knows_are_read_by_spark(spark, folder, monkeypatch):
    for schema in ("a int", "a bigint"):
        spark.createDataFrame([(1,)], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    monkeypatch.setattr(files, "_store_of", files.pafs.FileSystem.from_uri)
    assert not files._reachable("viewfs://store/in/a.parquet")
    monkeypatch.setattr(files, "_reachable", lambda path: False)
    batch = spark.createDataFrame([(str(p),) for p in Path(f"{folder}/in").glob("*.parquet")], "path string")
    assert sorted(f.schema.simpleString() for f in files.frames_by_schema(batch)) == ["struct<a:bigint>", "struct<a:int>"]


def test_micro_batches_bounded_by_bytes(spark, folder):
    for i in range(6):
        spark.range(20_000 * i, 20_000 * (i + 1), 1, 1).write.mode("append").parquet(f"{folder}/in")
    sizes = [p.stat().st_size for p in Path(f"{folder}/in").glob("*.parquet")]
    seen = []
    stream = parquet_stream(spark, f"{folder}/in", spark.range(0).schema, bytes_per_trigger=2 * max(sizes))
    query = stream.writeStream.foreachBatch(lambda df, i: seen.append(df.count())).option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sum(seen) == 120_000 and len(seen) == 3 and max(seen) == 40_000
    with pytest.raises(ValueError, match="not by both"):
        parquet_stream(spark, f"{folder}/in", spark.range(0).schema, 1, bytes_per_trigger=1)


@pytest.mark.parametrize("domain,share", [(None, 0.8), ("kafka_orders", 0.5), ("kafka_orders", 0.0), (None, 1.0)])
def test_split_over_a_table_is_that_of_the_list(spark, domain, share):
    names = [f"kafka_orders_{i}.json" for i in range(23)] + [f"mysql_menu_{i}.json" for i in range(8)] + ["junk.json", ""]
    table = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "file string, size int").repartition(5)
    found = split_files(table, domain=domain, share=share)
    got = {b: sorted(r.file for r in found.where(F.col("batch") == b).collect()) for b in ("initial", "incremental")}
    assert got == {b: select_files(names, b, domain, share) for b in got} and found.columns == ["file", "size", "batch"]


def test_places_in_an_order_of_all_rows(spark):
    rows = [(i % 7 if i % 11 else None, i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(6)
    got = {r.b: r.place for r in ranked(df, [F.col("a").desc_nulls_last(), "b"], "place").collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert got == {b: i for i, (_, b) in enumerate(order)}
    assert ranked(df.limit(0), ["b"]).collect() == []


def test_distinct_counts_from_sketches_of_batches(spark, folder):
    rows = [(i % 3 if i % 10 else None, i % 2000) for i in range(12_000)] + [(5, None)]
    df = spark.createDataFrame(rows, "g int, v int")
    for part in range(3):
        df.where(F.col("v").isNull() | (F.col("v") % 3 == part)).coalesce(2).write.mode("append").parquet(f"{folder}/in")
    stream = parquet_stream(spark, f"{folder}/in", df.schema, 2)
    for _ in range(2):
        sketch_stream(stream, ["g"], "v", f"{folder}/out", f"{folder}/cp").awaitTermination()
        last = max(Path(f"{folder}/cp/commits").glob("[0-9]*"), key=lambda p: int(p.name))
        last.unlink()  # the last batch runs again and counts once
        last.with_name(f".{last.name}.crc").unlink(missing_ok=True)
    counted = {r.g: (r.rows, r.distinct_count) for r in read_sketches(spark, df.schema, ["g"], f"{folder}/out").collect()}
    exact = {r.g: (r.rows, r.n) for r in df.groupBy("g").agg(F.count("*").alias("rows"), F.count_distinct("v").alias("n")).collect()}
    assert {g: n for g, (n, _) in counted.items() if g != 5} == {g: n for g, (n, _) in exact.items() if g != 5}
    assert all(abs(counted[g][1] - n) <= 0.05 * n for g, (_, n) in exact.items()) and counted[5][1] == 0
    assert read_sketches(spark, df.schema, ["g"], f"{folder}/none").collect() == []
