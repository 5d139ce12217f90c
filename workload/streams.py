"""Streaming flows: files arriving in several micro-batches, results read back from the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import CONTRACTS, load_contract
from tidemark.plans.warehouse import Warehouse
from tidemark.sources import export, file_stream, frames_by_schema, parquet_stream, source_stream, write_clustered
from tidemark.sources.storage import work_folder
from tidemark.streaming import (
    KeyedState,
    append_stream,
    read_route,
    read_sketches,
    route_stream,
    rule_metrics,
    scd1_stream,
    sketch_stream,
    totals_of_changes,
)
from workload.inputs import INPUTS
from workload.layers import AS_OF, rounded
from workload.operators import EVENTS_SQL, FEED_SQL, STATE_SQL, _failing, event_changes, latest_sql
from workload.registry import ORACLES, query

MICRO_BATCHES = 4


def _arrivals(df: DataFrame, purpose: str, key: str, batches: int = MICRO_BATCHES) -> tuple[DataFrame, str, str]:
    """``df`` as a stream of a few micro-batches, with a folder for results and checkpoints.

    Rows are spread over the arrivals by a hash of the key, so each holds records of all times; the
    number of files follows the data, and a micro-batch takes its share of them.
    """
    spark = df.sparkSession
    folder = work_folder(spark, purpose)
    part = F.pmod(F.xxhash64(key), F.lit(batches))
    df.withColumn("arrival", part).write.partitionBy("arrival").parquet(f"{folder}/in")
    files = len(spark.read.parquet(f"{folder}/in").inputFiles())
    stream = parquet_stream(spark, f"{folder}/in/arrival=*", df.schema, max(1, files // batches))
    return stream, folder, f"{folder}/checkpoint"


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    stream, folder, checkpoint = _arrivals(rows, "append", "event_id")
    append_stream(stream, f"{folder}/out", checkpoint).awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/out")


def _routed(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    bound = INPUTS["orders"]
    rows = bound.frame(spark, sf_dir)
    stream, folder, checkpoint = _arrivals(rows, "route", "order_id")
    route_stream(stream, bound.contract, f"{folder}/out", checkpoint, as_of=AS_OF).awaitTermination()
    return f"{folder}/out", rows


@query(f"""SELECT order_id, user_key, restaurant_key, total_amount,
    CASE WHEN user_key IS NULL OR restaurant_key IS NULL OR total_amount IS NULL THEN 'quarantine' ELSE 'clean' END
    AS route FROM ({INPUTS['orders'].sql}) AS r""")
def stream_fanout_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, rows = _routed(spark, sf_dir)
    parts = [
        read_route(spark, folder, rows.schema, route).withColumn("route", F.lit(route)) for route in ("clean", "quarantine")
    ]
    return parts[0].unionByName(parts[1]).select("order_id", "user_key", "restaurant_key", "total_amount", "route")


@query(f"SELECT rule, CAST(passed AS BIGINT) AS passed, CAST(failed AS BIGINT) AS failed FROM ({_failing('orders', 'silver')}) AS m")
def stream_rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = _routed(spark, sf_dir)
    return rule_metrics(spark, folder).groupBy("rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


def _event_state(spark: SparkSession, path: str, rows: DataFrame, **options) -> KeyedState:
    return KeyedState(spark, path, rows.schema, ("user_id",), "ts", tie_break=("event_id",), **options)


@query(STATE_SQL, name="scd1_stream")
def scd1_streaming(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_changes(spark, sf_dir)
    stream, folder, checkpoint = _arrivals(rows, "scd1", "event_id")
    state = _event_state(spark, f"{folder}/state", rows)
    scd1_stream(stream, state, checkpoint).awaitTermination()
    return state.read()


def _halves(rows: DataFrame, folder: str, key: str):
    """Two streams of files, each with half of the rows, and a checkpoint for each."""
    for part in (0, 1):
        half = F.pmod(F.xxhash64(key), F.lit(2)) == part
        rows.where(half).write.parquet(f"{folder}/in{part}")
        yield parquet_stream(rows.sparkSession, f"{folder}/in{part}", rows.schema), f"{folder}/checkpoint{part}"


@query(STATE_SQL)
def scd1_second_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new checkpoint numbers its batches from 0 again, and loses none of them on the same state."""
    rows = event_changes(spark, sf_dir)
    folder = work_folder(spark, "second")
    state = _event_state(spark, f"{folder}/state", rows)
    for stream, checkpoint in _halves(rows, folder, "event_id"):
        scd1_stream(stream, state, checkpoint).awaitTermination()
    return state.read()


@query(ORACLES["stream_fanout_quarantine"])
def route_second_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routed rows of a second checkpoint stand beside those of the first."""
    bound = INPUTS["orders"]
    rows = bound.frame(spark, sf_dir)
    folder = work_folder(spark, "second-route")
    for stream, checkpoint in _halves(rows, folder, "order_id"):
        route_stream(stream, bound.contract, f"{folder}/out", checkpoint, as_of=AS_OF).awaitTermination()
    parts = [
        read_route(spark, f"{folder}/out", rows.schema, route).withColumn("route", F.lit(route)) for route in ("clean", "quarantine")
    ]
    return parts[0].unionByName(parts[1]).select("order_id", "user_key", "restaurant_key", "total_amount", "route")


@query(STATE_SQL)
def scd1_delete_then_late_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delete arrives before the older updates of its key, which must not revive it."""
    rows = event_changes(spark, sf_dir)
    folder = work_folder(spark, "late")
    state = _event_state(spark, f"{folder}/state", rows)
    deletes = F.col("__op") == "d"
    rows.filter(deletes).write.parquet(f"{folder}/in")
    scd1_stream(parquet_stream(spark, f"{folder}/in", rows.schema), state, f"{folder}/checkpoint").awaitTermination()
    rows.filter(~deletes).write.mode("append").parquet(f"{folder}/in")
    scd1_stream(parquet_stream(spark, f"{folder}/in", rows.schema), state, f"{folder}/checkpoint").awaitTermination()
    return state.read()


_EARLY = "value > 10"


@query(f"""WITH before AS (SELECT user_id, event_id, value FROM ({latest_sql(
        EVENTS_SQL + f' WHERE {_EARLY}', 'user_id', 'ts DESC, event_id DESC')}) AS s WHERE __op <> 'd'),
    after AS (SELECT user_id, event_id, value FROM ({STATE_SQL}) AS s) {FEED_SQL}""")
def state_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second of two batches changed, from what its own keys were before."""
    rows = event_changes(spark, sf_dir)
    state = _event_state(spark, f"{work_folder(spark, 'feed')}/state", rows, feed=True)
    state.apply(rows.filter(_EARLY), "early")
    state.apply(rows.filter(f"NOT ({_EARLY})"), "late")
    return state.changes("late").select("user_id", "event_id", "value", "_change_type")


@query(f"""SELECT __op, count(*) AS "rows", round(sum(value), 2) AS value FROM ({STATE_SQL}) AS s GROUP BY __op""")
def totals_from_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate kept up from what four micro-batches changed; the state itself is not read for it."""
    rows = event_changes(spark, sf_dir)
    stream, folder, checkpoint = _arrivals(rows, "totals", "event_id")
    state = _event_state(spark, f"{folder}/state", rows, feed=True)
    scd1_stream(stream, state, checkpoint).awaitTermination()
    totals = totals_of_changes(state.changes(), ["__op"], ["value"]).where("rows > 0")
    return totals.withColumns({"rows": F.col("rows").cast("long"), "value": F.round("value", 2)})


#: Share by which a sketch of distinct values may be off.
_SKETCH_ERROR = 0.05


@query("""SELECT event_type, user_id % 4 AS part, count(*) AS "rows", count(DISTINCT event_id % 3000) AS distinct_ids, true AS near
    FROM events GROUP BY ALL""")
def distinct_on_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values counted from sketches of four micro-batches, held against the exact count."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_type", "user_id % 4 AS part", "event_id", "event_id % 3000 AS id")
    by = ["event_type", "part"]
    stream, folder, checkpoint = _arrivals(rows, "sketches", "event_id")
    sketch_stream(stream, by, "id", f"{folder}/out", checkpoint).awaitTermination()
    counted = read_sketches(spark, rows.schema, by, f"{folder}/out")
    exact = rows.groupBy(*by).agg(F.count_distinct("id").alias("distinct_ids"))
    near = F.abs(F.col("distinct_count") - F.col("distinct_ids")) <= F.col("distinct_ids") * _SKETCH_ERROR
    return counted.join(exact, by).select(*by, "rows", "distinct_ids", near.alias("near"))


def _bound_source(spark: SparkSession, sf_dir: str):
    """Each domain's records as a stream of files, the way exported topics arrive."""

    def source(contract):
        bound = INPUTS[contract.name]
        return _arrivals(bound.frame(spark, sf_dir), f"source-{contract.name}", (bound.tie_break or bound.contract.keys)[0], 2)[0]

    return source


@query(ORACLES["gold_payments_by_status"])
def pipeline_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to bronze, silver, quarantine and gold through the warehouse's own streams."""
    warehouse = Warehouse(
        spark,
        work_folder(spark, "warehouse"),
        contracts={"payments": CONTRACTS["payments"]},
        tie_break={"payments": INPUTS["payments"].tie_break},
    )
    warehouse.run_bronze(_bound_source(spark, sf_dir), AS_OF)
    warehouse.run_silver(AS_OF)
    warehouse.run_gold(["payments_by_status"], AS_OF)
    return rounded(warehouse.gold("payments_by_status").drop("_computed_at"))


@query(ORACLES["users_unify"], name="pipeline_users")
def pipeline_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both registries' files to bronze, then fused into the users table of the warehouse."""
    names = ("users_mongo", "users_mssql")
    warehouse = Warehouse(
        spark,
        work_folder(spark, "warehouse"),
        contracts={n: CONTRACTS[n] for n in names},
        tie_break={"users": ("uuid",)},
    )
    warehouse.run_bronze(_bound_source(spark, sf_dir), AS_OF)
    warehouse.run_users(AS_OF)
    return warehouse.silver("users").drop("_ingested_at", "_merged_at")


_COUNTED = ("gps_events", "orders", "payments")


@query(" UNION ALL ".join(
    f"SELECT '{s}' AS scope, table_name, rule, on_failure, passed, failed FROM ({_failing(d, s, arriving=s == 'bronze')}) AS m"
    for d in _COUNTED for s in ("bronze", "silver") if CONTRACTS[d].rules_for(s)))
def dq_bronze_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of both scopes as the warehouse keeps them while it ingests."""
    house = Warehouse(
        spark,
        work_folder(spark, "warehouse"),
        contracts={n: CONTRACTS[n] for n in _COUNTED},
        tie_break={n: INPUTS[n].tie_break for n in _COUNTED if INPUTS[n].tie_break},
    )
    house.run_bronze(_bound_source(spark, sf_dir), AS_OF)
    house.run_silver(AS_OF)
    counts = reduce(DataFrame.unionByName, [house.rule_metrics(n) for n in _COUNTED])
    names = ("scope", "table_name", "rule", "on_failure")
    return counts.groupBy(*names).agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


DRIFTING = load_contract(
    {
        "table": {"name": "drifting", "layers": ["bronze"], "merge_key": "event_id"},
        "schema": [
            {"name": "event_id", "type": "long", "nullable": False},
            {"name": "user_id", "type": "integer", "nullable": True},
            {"name": "value", "type": "double", "nullable": True},
        ],
        "quality": {"rules": []},
        "storage": {"cluster_by": ["event_id"]},
        "schema_evolution": {"new_fields": "allowed", "removed_fields": "forbidden", "type_changes": "allowed"},
    }
)


@query("""SELECT event_id, CAST(user_id AS INTEGER) AS user_id, value,
    CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type FROM events""")
def bronze_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later files widen an integer and bring a column that the contract doesn't know."""
    rows, folder = spark.read.parquet(f"{sf_dir}/events.parquet"), work_folder(spark, "drift")
    plain = rows.selectExpr("event_id", "CAST(user_id AS INT) AS user_id", "value", "event_type")
    wide = plain.withColumn("user_id", F.col("user_id").cast("long"))
    house = Warehouse(spark, f"{folder}/house", contracts={"drifting": DRIFTING})
    for exported in (plain.where("event_id % 2 <> 1").drop("event_type"), wide.where("event_id % 2 = 1")):
        exported.write.mode("append").parquet(f"{folder}/in/drifting")
        house.run_bronze(lambda c: file_stream(spark, f"{folder}/in/{c.name}"), AS_OF, frames_by_schema)
    return house.bronze("drifting").drop("_ingested_at")


def _shared(field: str) -> str:
    """Every eighth holder of a number has taken the number of the next."""
    return f"CASE WHEN CAST({field} AS INT) % 8 = 0 THEN CAST(CAST({field} AS INT) + 1 AS STRING) ELSE {field} END"


_UNIQUE = {"drivers": "driver_id", "restaurants": "cnpj"}


@query(" UNION ALL ".join(
    f"""SELECT '{d}' AS table_name, uuid, value, count(DISTINCT uuid) OVER (PARTITION BY value) > 1 AS clashes
    FROM (SELECT uuid, {_shared(f)} AS value FROM ({INPUTS[d].sql}) AS r) AS v WHERE value IS NOT NULL""" for d, f in _UNIQUE.items()))
def unique_while_streaming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that two drivers or restaurants share, found against the kept index as the batches come."""
    house = Warehouse(spark, work_folder(spark, "unique"), contracts={d: CONTRACTS[d] for d in _UNIQUE})

    def source(contract):
        rows = INPUTS[contract.name].frame(spark, sf_dir)
        field = _UNIQUE[contract.name]
        return _arrivals(rows.withColumn(field, F.expr(_shared(field))), f"source-{contract.name}", "uuid", 3)[0]

    house.run_bronze(source, AS_OF)
    house.run_silver(AS_OF)
    parts = [
        house.clashes(d).select(F.lit(d).alias("table_name"), "uuid", F.col(f).alias("value"), F.col(f"{f}_unique").alias("clashes"))
        for d, f in _UNIQUE.items()
    ]
    return parts[0].unionByName(parts[1])


def _drifting_people(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Half of the events as an earlier export of changes per user, and half as a later one with another column."""
    changes = rows.selectExpr("user_id", "event_id", "nullif(greatest(value, 10), 10) AS value", "event_type", "'u' AS __op", "event_id AS __source_ts_ms")
    return changes.where("event_id % 2 <> 1").drop("event_type"), changes.where("event_id % 2 = 1")


PEOPLE = load_contract(
    {
        "table": {"name": "people", "layers": ["bronze", "silver"], "merge_key": "user_id"},
        "schema": [
            {"name": "user_id", "type": "long", "nullable": False},
            {"name": "event_id", "type": "long", "nullable": True},
            {"name": "value", "type": "double", "nullable": True},
            {"name": "__op", "type": "string", "nullable": True},
            {"name": "__source_ts_ms", "type": "long", "nullable": True},
        ],
        "quality": {"rules": [{"field": "value", "check": "not_null", "on_failure": "quarantine", "scope": ["silver"]}]},
        "storage": {"cluster_by": ["user_id"]},
        "schema_evolution": {"new_fields": "allowed", "removed_fields": "forbidden", "type_changes": "forbidden"},
    }
)


def _drifted_house(spark: SparkSession, sf_dir: str) -> Warehouse:
    rows, folder = spark.read.parquet(f"{sf_dir}/events.parquet"), work_folder(spark, "drift")
    for exported in _drifting_people(rows):
        exported.write.mode("append").parquet(f"{folder}/in/people")
        house = Warehouse(spark, f"{folder}/house", contracts={"people": PEOPLE}, tie_break={"people": ("event_id",)})
        house.run_bronze(lambda c: file_stream(spark, f"{folder}/in/{c.name}"), AS_OF, frames_by_schema)
        house.run_silver(AS_OF)
    return house


_DRIFTED = "SELECT user_id, event_id, CASE WHEN value > 10 THEN value END AS value, CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type FROM events"


@query(f"""SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place
    FROM ({_DRIFTED}) AS d WHERE value IS NOT NULL) AS ranked WHERE place = 1""")
def silver_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that files bring beyond the contract goes through bronze to the current rows."""
    return _drifted_house(spark, sf_dir).silver("people").select("user_id", "event_id", "value", "event_type")


@query(f"SELECT * FROM ({_DRIFTED}) AS d WHERE value IS NULL")
def quarantine_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drifted_house(spark, sf_dir).quarantine("people").select("user_id", "event_id", "value", "event_type")


@query(f"SELECT * FROM ({INPUTS['gps_events'].sql}) AS r WHERE gps_id IS NOT NULL")
def bronze_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches rewritten as large files by key, and later ones beside them."""
    bound = INPUTS["gps_events"]
    house = Warehouse(spark, work_folder(spark, "settled"), contracts={"gps_events": bound.contract})
    rows, path = bound.frame(spark, sf_dir), work_folder(spark, "settled-in")
    for part in range(2):
        rows.where(F.pmod(F.xxhash64("gps_id"), F.lit(2)) == part).repartition(3).write.mode("append").parquet(path)
        house.run_bronze(lambda c: parquet_stream(spark, path, rows.schema, 2), AS_OF)
        if not part:
            house.settle()
    return house.bronze("gps_events").select(*bound.names)


@query(INPUTS["recommendations"].sql, name="source_switch_volume")
def source_switch_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A domain exported as typed Parquet and read back through the source switch."""
    bound, folder = INPUTS["recommendations"], work_folder(spark, "volume")
    export(spark, bound.frame(spark, sf_dir), f"{folder}/exports", bound.contract)
    stream = source_stream(spark, bound.contract, "volume", {"base": f"{folder}/exports"})
    append_stream(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(bound.contract.payload_type).parquet(f"{folder}/out").select(*bound.names)


@query("SELECT * FROM lineitem")
def clustered_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table laid out by key ranges, read back whole."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    path = f"{work_folder(spark, 'clustered')}/items"
    write_clustered(items, path, ["l_orderkey"])
    return spark.read.schema(items.schema).parquet(path)
