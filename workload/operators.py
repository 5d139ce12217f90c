"""Single operators: rules, keyed state, envelopes, conformity, landing, monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import CONTRACTS, Contract, evolve, load_contract
from tidemark.functions import driver_key, rule_fails, strip_wire_header
from tidemark.operators import (
    apply_reject,
    change_feed,
    conform,
    conformity_errors,
    flag_clashing,
    flatten_envelope,
    latest_per_key,
    rule_counts,
    scd1,
    skip_tombstones,
    snapshot_diff,
    snapshot_plus_changes,
    split_quarantine,
    unique_against_target,
    upsert,
)
from tidemark.operators.conform import conformed_columns
from tidemark.operators.ranks import ranked
from tidemark.operators.series import on_grid
from tidemark.plans import monitoring
from tidemark.sources import (
    decode_json,
    load_summary,
    parse_landing,
    read_landing,
    select_files,
    split_files,
    with_domain,
)
from tidemark.sources.storage import child_names, work_folder
from workload.inputs import INPUTS, Input
from workload.layers import AS_OF, bronze_of
from workload.registry import query, register, table

# --- quality rules ----------------------------------------------------------------------------


def _failing(domain: str, scope: str, action: str | None = None, arriving: bool = False) -> str:
    """SQL counting passed and failed rows of a bound domain's rules, one row per rule.

    Of the rows that bronze keeps, or of all ``arriving`` ones.
    """
    bound, parts = INPUTS[domain], []
    for r in bound.contract.rules_for(scope, action):
        test = {
            "not_null": f"{r.field} IS NULL",
            "allowed_values": f"{r.field} IS NOT NULL AND {r.field} NOT IN ({', '.join(map(repr, r.values))})",
            "not_future": f"{r.field} > TIMESTAMP '{AS_OF}'",
            "unique": "false",
        }[r.check]
        failed = f"count(*) FILTER ({test})"
        parts.append(
            f"SELECT '{domain}' AS table_name, '{r.name}' AS rule, '{r.on_failure}' AS on_failure,"
            f" count(*) - {failed} AS passed, {failed} AS failed FROM records_{domain}"
        )
    key = bound.contract.keys[0]
    kept = "true" if arriving else f"{key} IS NOT NULL"
    records = f"records_{domain} AS (SELECT * FROM ({bound.sql}) AS r WHERE {kept})"
    return f"WITH {records} {' UNION ALL '.join(parts)}"


def _rules(bound_domain: str, scope: str, action: str | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = bronze_of(spark, sf_dir, bound_domain)
        return rule_counts(rows, CONTRACTS[bound_domain], scope, action, AS_OF)

    return run


@query(f"""WITH records AS ({INPUTS['payment_events'].sql}) SELECT * FROM records WHERE event_id IS NOT NULL""")
def bronze_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_reject(INPUTS["payment_events"].frame(spark, sf_dir), CONTRACTS["payment_events"], "bronze")


@query(f"SELECT * FROM ({INPUTS['orders'].sql}) AS r WHERE user_key IS NOT NULL AND restaurant_key IS NOT NULL"
       " AND total_amount IS NOT NULL")
def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_quarantine(INPUTS["orders"].frame(spark, sf_dir), CONTRACTS["orders"])[0]


@query(f"SELECT * FROM ({INPUTS['orders'].sql}) AS r WHERE user_key IS NULL OR restaurant_key IS NULL"
       " OR total_amount IS NULL")
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_quarantine(INPUTS["orders"].frame(spark, sf_dir), CONTRACTS["orders"])[1]


@query(f"SELECT *, 'clean' AS route FROM ({INPUTS['ratings'].sql}) AS r")
def quarantine_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a quarantine rule every row is clean and none is set apart."""
    clean, apart = split_quarantine(INPUTS["ratings"].frame(spark, sf_dir), CONTRACTS["ratings"])
    return clean.withColumn("route", F.lit("clean")).unionByName(apart.withColumn("route", F.lit("quarantine")))


@query(_failing("gps_events", "bronze", "warn"))
def dq_warn_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules("gps_events", "bronze", "warn")(spark, sf_dir)


@query(f"{_failing('payments', 'silver', 'warn')}")
def dq_allowed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules("payments", "silver", "warn")(spark, sf_dir)


@query(f"{_failing('ratings', 'bronze', 'warn')}")
def dq_allowed_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules("ratings", "bronze", "warn")(spark, sf_dir)


@query(f"""SELECT event_id, dt_current_timestamp > TIMESTAMP '{AS_OF}' AS future
    FROM ({INPUTS['recommendations'].sql}) AS r""")
def dq_not_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = next(r for r in CONTRACTS["recommendations"].rules if r.check == "not_future")
    rows = INPUTS["recommendations"].frame(spark, sf_dir)
    return rows.select("event_id", rule_fails(rule, AS_OF).alias("future"))


_METERED = ("orders", "payments", "payment_events", "order_items", "driver_shifts")


@query(" UNION ALL ".join(f"SELECT * FROM ({_failing(d, 'silver')}) AS m_{d}" for d in _METERED))
def dq_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [_rules(d, "silver")(spark, sf_dir) for d in _METERED]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@query("""SELECT c_custkey, c_acctbal, c_acctbal IN (SELECT c_acctbal FROM customer
    GROUP BY c_acctbal HAVING count(DISTINCT c_custkey) > 1) AS clashes FROM customer""")
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return flag_clashing(rows, "c_acctbal", ["c_custkey"], "clashes")


@query("""WITH items AS (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_partkey IN (SELECT l_partkey FROM items GROUP BY l_partkey
        HAVING min(l_orderkey * 10 + l_linenumber) <> max(l_orderkey * 10 + l_linenumber)) AS clashes FROM items""")
def dq_unique_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return flag_clashing(rows, "l_partkey", ["l_orderkey", "l_linenumber"], "clashes")


@query("""WITH batch AS (SELECT s_suppkey AS id, CAST(round(s_acctbal) AS BIGINT) AS code FROM supplier),
    target AS (SELECT c_custkey AS id, CAST(round(c_acctbal) AS BIGINT) AS code FROM customer),
    owners AS (SELECT * FROM batch UNION SELECT * FROM target WHERE id NOT IN (SELECT id FROM batch))
    SELECT id, code, code IN (SELECT code FROM owners GROUP BY code HAVING count(DISTINCT id) > 1) AS clashes
    FROM batch""")
def dq_unique_vs_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "CAST(round(s_acctbal) AS BIGINT) AS code")
    target = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "CAST(round(c_acctbal) AS BIGINT) AS code")
    return unique_against_target(batch, target, "code", ["id"], "clashes")


# --- envelopes --------------------------------------------------------------------------------

_ROW = "struct(event_id, user_id, event_type, value)"


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as change envelopes: errors are deletes, purchases are followed by a tombstone."""
    return table(spark, sf_dir, "events").selectExpr(
        f"CASE WHEN event_type IN ('error', 'click') THEN {_ROW} END AS before",
        f"CASE WHEN event_type NOT IN ('error', 'purchase') THEN {_ROW} END AS after",
        "CASE WHEN event_type = 'error' THEN 'd' WHEN event_type = 'signup' THEN 'c'"
        " WHEN event_type <> 'purchase' THEN 'u' END AS op",
        "struct(unix_millis(CAST(ts AS TIMESTAMP)) AS ts_ms) AS source",
    )


@query("""SELECT event_id, user_id, event_type, value, CASE WHEN event_type = 'error' THEN 'd'
    WHEN event_type = 'signup' THEN 'c' ELSE 'u' END AS __op, epoch_us(ts) // 1000 AS __source_ts_ms
    FROM events WHERE event_type <> 'purchase'""", name="flatten_envelope")
def flatten_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_envelope(_envelopes(spark, sf_dir))


@query("SELECT event_id, props AS value FROM events WHERE event_type <> 'error'")
def tombstone_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "events").selectExpr(
        "event_id", "CASE WHEN event_type <> 'error' THEN props END AS value"
    )
    return skip_tombstones(messages)


@query("""SELECT c_custkey AS id, c_acctbal AS amount, 'r' AS __op, 0 AS __source_ts_ms FROM customer
    UNION ALL SELECT o_custkey, o_totalprice, CASE o_orderstatus WHEN 'P' THEN 'd' ELSE 'u' END,
    epoch_us(o_orderdate) // 1000 FROM orders""", name="snapshot_plus_changes")
def snapshot_then_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _initial_and_changes(spark, sf_dir).withColumn("__source_ts_ms", F.coalesce("__source_ts_ms", F.lit(0)))


def _initial_and_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_acctbal AS amount")
    changes = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS id",
        "o_totalprice AS amount",
        "CASE o_orderstatus WHEN 'P' THEN 'd' ELSE 'u' END AS __op",
        "unix_millis(CAST(o_orderdate AS TIMESTAMP)) AS __source_ts_ms",
    )
    return snapshot_plus_changes(snapshot, changes)


@query("SELECT event_id, props AS body FROM events", name="strip_wire_header")
def strip_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = table(spark, sf_dir, "events").selectExpr(
        "event_id", "concat(unhex('0000000007'), encode(props, 'utf-8')) AS value"
    )
    return framed.select("event_id", strip_wire_header(F.col("value")).cast("string").alias("body"))


# --- keyed state ------------------------------------------------------------------------------

EVENT_CHANGES = (
    "user_id", "event_id", "ts", "value", "props",
    "CASE WHEN event_type = 'signup' THEN 'c' WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS __op",
)


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a change stream keyed by user: signups create, errors delete, the rest update."""
    return table(spark, sf_dir, "events").selectExpr(*EVENT_CHANGES)


_RANK = "CASE __op WHEN 'r' THEN 0 WHEN 'c' THEN 1 WHEN 'd' THEN 3 ELSE 2 END"


def latest_sql(records: str, keys: str, order: str) -> str:
    return f"""SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order})
        AS place FROM ({records}) AS records) AS ranked WHERE place = 1"""


EVENTS_SQL = f"SELECT {', '.join(EVENT_CHANGES)} FROM events"
STATE_SQL = f"SELECT * FROM ({latest_sql(EVENTS_SQL, 'user_id', 'ts DESC, event_id DESC')}) AS s WHERE __op <> 'd'"


@query(STATE_SQL)
def scd1_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd1(event_changes(spark, sf_dir), ["user_id"], "ts", tie_break=["event_id"])


_ITEM_ORDER = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_partkey",
               "l_suppkey")


@query(f"""SELECT * FROM ({latest_sql('SELECT * FROM lineitem', 'l_orderkey, l_linenumber',
    'l_shipdate DESC, ' + ', '.join(f'{c} DESC' for c in _ITEM_ORDER))}) AS s WHERE l_returnflag <> 'R'""")
def scd1_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    return scd1(rows, ["l_orderkey", "l_linenumber"], "l_shipdate", "l_returnflag = 'R'", _ITEM_ORDER)


@query(f"""SELECT * FROM ({latest_sql(EVENTS_SQL, 'user_id',
    f"date_trunc('hour', ts) DESC, {_RANK} DESC, event_id DESC")}) AS s WHERE __op <> 'd'""")
def scd1_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.date_trunc("hour", F.col("ts"))
    return scd1(event_changes(spark, sf_dir), ["user_id"], hour, tie_break=["event_id"])


@query(f"{latest_sql(EVENTS_SQL, 'user_id', 'value DESC, event_id DESC')}", name="latest_per_key")
def latest_row_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(event_changes(spark, sf_dir), ["user_id"], ["value", "event_id"])


@query(f"""WITH final AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM ({latest_sql(
    'SELECT * FROM orders', 'o_custkey', 'o_orderdate DESC, o_orderkey DESC')}) AS l)
    SELECT c_custkey AS id, coalesce(o_totalprice, c_acctbal) AS amount,
        CASE WHEN o_custkey IS NULL THEN c_name END AS note FROM customer LEFT JOIN final ON o_custkey = c_custkey
    UNION ALL SELECT o_custkey, o_totalprice, NULL FROM final WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def upsert_last_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_acctbal AS amount", "c_name AS note")
    batch = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS id", "o_totalprice AS amount", "CAST(NULL AS STRING) AS note", "o_orderdate", "o_orderkey"
    )
    return upsert(target, batch, ["id"], ["o_orderdate", "o_orderkey"])


def _states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The state of the change stream halfway and at the end."""
    changes = event_changes(spark, sf_dir)
    earlier = changes.filter(F.col("ts") < F.lit(AS_OF).cast("timestamp_ntz"))
    return tuple(
        scd1(c, ["user_id"], "ts", tie_break=["event_id"]).select("user_id", "event_id", "value")
        for c in (earlier, changes)
    )


_STATES = f"""before AS (SELECT user_id, event_id, value FROM ({latest_sql(
        EVENTS_SQL + f" WHERE ts < TIMESTAMP '{AS_OF}'", 'user_id', 'ts DESC, event_id DESC')}) AS s WHERE __op <> 'd'),
    after AS (SELECT user_id, event_id, value FROM ({STATE_SQL}) AS s)"""


@query(f"""WITH {_STATES} SELECT coalesce(a.user_id, b.user_id) AS user_id,
    CASE WHEN b.user_id IS NULL THEN 'insert' WHEN a.user_id IS NULL THEN 'delete' ELSE 'update' END AS change,
    b.event_id AS event_before, a.event_id AS event_after, b.value AS value_before, a.value AS value_after
    FROM before AS b FULL OUTER JOIN after AS a ON a.user_id = b.user_id
    WHERE b.user_id IS NULL OR a.user_id IS NULL OR (a.event_id, a.value) <> (b.event_id, b.value)""", name="snapshot_diff")
def snapshot_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    previous, current = _states(spark, sf_dir)
    return snapshot_diff(previous, current, ["user_id"]).select(
        "user_id",
        "change",
        F.col("before.event_id").alias("event_before"),
        F.col("after.event_id").alias("event_after"),
        F.col("before.value").alias("value_before"),
        F.col("after.value").alias("value_after"),
    )


FEED_SQL = """SELECT a.*, 'insert' AS _change_type FROM after AS a WHERE user_id NOT IN (SELECT user_id FROM before)
    UNION ALL SELECT b.*, 'delete' FROM before AS b WHERE user_id NOT IN (SELECT user_id FROM after)
    UNION ALL SELECT b.*, 'update_preimage' FROM before AS b JOIN after AS a USING (user_id)
        WHERE (a.event_id, a.value) <> (b.event_id, b.value)
    UNION ALL SELECT a.*, 'update_postimage' FROM before AS b JOIN after AS a USING (user_id)
        WHERE (a.event_id, a.value) <> (b.event_id, b.value)"""


@query(f"WITH {_STATES} {FEED_SQL}", name="change_feed")
def snapshot_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_feed(*_states(spark, sf_dir), ["user_id"])


# --- conformity -------------------------------------------------------------------------------

RAW_EVENTS: Contract = load_contract(
    {
        "table": {"name": "raw_events", "layers": ["bronze"], "merge_key": "event_id"},
        "schema": [
            {"name": "event_id", "type": "long", "nullable": False},
            {"name": "ts", "type": "timestamp", "nullable": False},
            {"name": "user_id", "type": "integer", "nullable": True},
            {"name": "value", "type": "integer", "nullable": True},
            {"name": "amount", "type": "double", "nullable": False},
            {"name": "flag", "type": "boolean", "nullable": True},
            {"name": "day", "type": "date", "nullable": True},
            {"name": "note", "type": "string", "nullable": True},
        ],
        "quality": {"rules": []},
        "storage": {"cluster_by": ["event_id"]},
        "schema_evolution": {"new_fields": "allowed", "removed_fields": "forbidden", "type_changes": "forbidden"},
    }
)


def _raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with every column as text: times as ISO, epoch milliseconds or nonsense."""
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "CASE WHEN event_type = 'error' THEN 'sometime' WHEN event_type IN ('view', 'click')"
        " THEN CAST(unix_millis(CAST(ts AS TIMESTAMP)) AS STRING) ELSE CAST(ts AS STRING) END AS ts",
        "CASE WHEN value < 1 THEN 'u' || user_id ELSE CAST(user_id AS STRING) END AS user_id",
        "CAST(value AS STRING) AS value",
        "CASE WHEN value > 20 THEN NULL ELSE CAST(value AS STRING) END AS amount",
        "CASE WHEN event_type = 'click' THEN 'true' WHEN event_type = 'view' THEN 'false' ELSE '?' END AS flag",
        "CAST(CAST(ts AS DATE) AS STRING) AS day",
        "props AS note",
        "event_type AS surprise",
    )


_CONFORMED = """SELECT event_id,
    CASE WHEN event_type = 'error' THEN NULL WHEN event_type IN ('view', 'click')
        THEN make_timestamp((epoch_us(ts) // 1000) * 1000) ELSE ts END AS ts,
    CASE WHEN value < 1 THEN NULL ELSE CAST(user_id AS INT) END AS user_id,
    CAST(round(CAST(value AS DECIMAL(18, 6)), 0) AS INT) AS value,
    CASE WHEN value > 20 THEN NULL ELSE value END AS amount,
    CASE WHEN event_type = 'click' THEN true WHEN event_type = 'view' THEN false END AS flag,
    CAST(ts AS DATE) AS day, props AS note FROM events"""


@query(_CONFORMED)
def conform_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(_raw_text(spark, sf_dir), RAW_EVENTS)


@query("""SELECT event_id, concat_ws(' ', CASE WHEN event_type = 'error' THEN 'not timestamp:ts' END,
    CASE WHEN value < 1 THEN 'not integer:user_id' END, CASE WHEN value > 20 THEN 'missing:amount' END,
    CASE WHEN event_type NOT IN ('click', 'view') THEN 'not boolean:flag' END) AS errors
    FROM events""", name="conformity_errors")
def conformity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = conformity_errors(_raw_text(spark, sf_dir), RAW_EVENTS)
    return checked.select(F.col("event_id").cast("bigint"), F.concat_ws(" ", "_errors").alias("errors"))


@query("SELECT event_id, ts, CAST(user_id AS INT) AS user_id, value AS amount, props AS note FROM events")
def json_payload_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "events").selectExpr(
        "concat(unhex('0000000007'), encode(to_json(struct(event_id, ts, user_id, value AS amount, props AS note),"
        " map('timestampNTZFormat', 'yyyy-MM-dd HH:mm:ss.SSSSSS')), 'utf-8')) AS value"
    )
    return decode_json(messages, RAW_EVENTS).select("event_id", "ts", "user_id", "amount", "note")


@query("""SELECT event_type AS surprise, count(*) AS n, min(event_id) AS least, max(event_id) AS most
    FROM events GROUP BY event_type""")
def schema_evolution_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw_text(spark, sf_dir)
    arriving = raw.select(*conformed_columns(raw, RAW_EVENTS), "surprise")
    widened = evolve(arriving, RAW_EVENTS)
    return widened.groupBy("surprise").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("least"), F.max("event_id").alias("most")
    )


# --- landing ----------------------------------------------------------------------------------


@query("""SELECT o_orderkey, CAST(CAST(regexp_replace(o_orderpriority || o_custkey, '[^0-9]', '', 'g') AS BIGINT) % 354
    + 1 AS STRING) AS driver FROM orders""")
def driver_key_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat("o_orderpriority", F.col("o_custkey").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", driver_key(raw).alias("driver"))


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the JSON lines an application exports, some of them broken off."""
    return table(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_totalprice < 2000 THEN '{\"order_id\": ' ELSE to_json(struct("
        "CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS user_key,"
        " CAST(o_custkey AS STRING) AS restaurant_key, 'dr' || o_custkey AS driver_key,"
        " CAST(o_orderdate AS STRING) AS order_date, o_totalprice AS total_amount, o_orderstatus AS unknown)) END"
        " AS value"
    )


@query("""SELECT CASE WHEN broken THEN NULL ELSE CAST(o_orderkey AS STRING) END AS order_id,
    CASE WHEN broken THEN NULL ELSE CAST(o_custkey AS STRING) END AS user_key,
    CASE WHEN broken THEN NULL ELSE CAST(o_custkey % 354 + 1 AS STRING) END AS driver_key,
    CAST(NULL AS STRING) AS payment_key, CASE WHEN broken THEN NULL ELSE o_orderdate END AS order_date,
    CASE WHEN broken THEN NULL ELSE o_totalprice END AS total_amount, broken
    FROM (SELECT *, o_totalprice < 2000 AS broken FROM orders) AS o""")
def landing_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "landing")
    _order_lines(spark, sf_dir).write.text(f"{folder}/kafka_orders_export.json")
    records = read_landing(spark, folder, CONTRACTS["orders"])
    return records.select(
        "order_id", "user_key", "driver_key", "payment_key", "order_date", "total_amount",
        F.col("_corrupt_record").isNotNull().alias("broken"),
    )


@query("""SELECT CAST(user_id AS INT) AS status_id, CAST(event_id AS STRING) AS order_identifier,
    CASE WHEN event_type = 'click' THEN '"click"' ELSE replace(props, ' ', '') END AS status, ts AS dt_current_timestamp
    FROM events""")
def landing_nested_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "events").selectExpr(
        "'{\"status_id\": ' || user_id || ', \"order_identifier\": \"' || event_id || '\", \"status\": '"
        " || CASE WHEN event_type = 'click' THEN '\"click\"' ELSE props END"
        " || ', \"dt_current_timestamp\": \"' || CAST(ts AS STRING) || '\"}' AS value"
    )
    return parse_landing(lines, CONTRACTS["order_status"]).select(
        "status_id", "order_identifier", "status", "dt_current_timestamp"
    )


# Every other domain as JSON lines, read back by its contract's projection. A payment event's name arrives as JSON text.
_AS_JSON = {"payment_events": "* REPLACE (CAST(to_json(event) AS VARCHAR) AS event)"}


def _landed(bound: Input):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = bound.frame(spark, sf_dir).select(F.to_json(F.struct("*"), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("value"))
        return parse_landing(lines, bound.contract).select(*bound.names)

    return run


for _bound in INPUTS.values():
    if _bound.domain not in ("orders", "order_status"):
        register(f"landing_{_bound.domain}", _landed(_bound), f"SELECT {_AS_JSON.get(_bound.domain, '*')} FROM ({_bound.sql}) AS r")


_FILE = (
    "CASE event_type WHEN 'view' THEN 'kafka_orders_01.json' WHEN 'click' THEN 'mysql_menu_02.json'"
    " WHEN 'signup' THEN 'mssql_users_' || user_id || '.json' WHEN 'error' THEN 'kafka_unknown_1.json'"
    " ELSE 'readme.json' END"
)


@query("""SELECT event_id, CASE event_type WHEN 'view' THEN 'kafka_orders' WHEN 'click' THEN 'mysql_menu'
    WHEN 'signup' THEN 'mssql_users' END AS domain FROM events""")
def landing_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr("event_id", f"{_FILE} AS file")
    return with_domain(rows, F.col("file")).select("event_id", "domain")


@query("""WITH days AS (SELECT CAST(ts AS DATE) AS day, count(*) AS records FROM events GROUP BY 1),
    placed AS (SELECT *, row_number() OVER (ORDER BY day) AS place, count(*) OVER () AS files FROM days)
    SELECT 'kafka_events_' || CAST(day AS STRING) || '.json' AS file, records,
    CASE WHEN place <= floor(files * 0.8) THEN 'initial' ELSE 'incremental' END AS batch FROM placed""")
def batch_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "batches")
    daily = table(spark, sf_dir, "events").selectExpr(
        "to_json(struct(*)) AS value", "'kafka_events_' || CAST(CAST(ts AS DATE) AS STRING) || '.json' AS file"
    )
    daily.write.partitionBy("file").text(folder)
    names = [n.removeprefix("file=") for n in child_names(spark, folder) if n.startswith("file=")]
    loads = []
    for batch in ("initial", "incremental"):
        paths = [f"{folder}/file={n}" for n in select_files(names, batch)]
        if paths:
            lines = spark.read.option("basePath", folder).text(paths)
            loads.append(lines.groupBy("file").agg(F.count(F.lit(1)).alias("records")).withColumn("batch", F.lit(batch)))
    return loads[0] if len(loads) == 1 else loads[0].unionByName(loads[1])


@query("""WITH names AS (SELECT DISTINCT 'kafka_events_' || CAST(user_id AS STRING) || '_' || event_type || '.json' AS file FROM events),
    placed AS (SELECT file, row_number() OVER (ORDER BY file) AS place, count(*) OVER () AS files FROM names)
    SELECT file, CASE WHEN place <= floor(files * 0.8) THEN 'initial' ELSE 'incremental' END AS batch FROM placed""")
def batch_split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split over a table of names, ordered in ranges; no list of them is held anywhere."""
    name = "'kafka_events_' || CAST(user_id AS STRING) || '_' || event_type || '.json' AS file"
    return split_files(table(spark, sf_dir, "events").selectExpr(name).distinct())


@query("SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS place FROM lineitem")
def rank_over_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return ranked(table(spark, sf_dir, "lineitem").select(*keys), keys, "place")


@query(f"""WITH routed AS (SELECT *, {_FILE} AS file FROM events)
    SELECT CASE event_type WHEN 'view' THEN 'kafka_orders' WHEN 'click' THEN 'mysql_menu'
        WHEN 'signup' THEN 'mssql_users' END AS domain, count(DISTINCT file) AS files,
        count(*) FILTER (value >= 1) AS records, count(*) FILTER (value < 1) AS errors FROM routed GROUP BY 1""", name="load_summary")
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr("value", f"{_FILE} AS file")
    return load_summary(rows, F.col("file"), F.col("value") < 1)


# --- monitoring -------------------------------------------------------------------------------

_TOPIC = "CASE WHEN event_type = 'error' THEN '__offsets' ELSE event_type END AS topic"


def _samples(spark: SparkSession, sf_dir: str, value: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(ts AS TIMESTAMP) AS ts", "event_id", _TOPIC, "user_id AS partition", f"{value} AS value"
    )


_LAGS = f"""SELECT * FROM ({latest_sql(
    f'SELECT ts, event_id, {_TOPIC}, user_id, value FROM events', 'topic, user_id', 'ts DESC, event_id DESC')}) AS l
    WHERE topic NOT LIKE '\\_\\_%' ESCAPE '\\'"""


@query(f"SELECT topic, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS lag FROM ({_LAGS}) AS n GROUP BY topic")
def lag_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = _samples(spark, sf_dir, "CAST(value AS DECIMAL(18,2))")
    return monitoring.lag_by_topic(samples, ["event_id"]).withColumn("lag", F.col("lag").cast("double"))


@query(f"SELECT CAST(coalesce(sum(CAST(value AS DECIMAL(18,2))), 0) AS DOUBLE) AS lag FROM ({_LAGS}) AS n")
def total_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = _samples(spark, sf_dir, "CAST(value AS DECIMAL(18,2))")
    return monitoring.total_lag(samples, ["event_id"]).select(F.col("lag").cast("double"))


_GROWN = f"""grown AS (SELECT topic, ts, event_id, CASE WHEN last IS NULL THEN 0 WHEN value < last THEN value
        ELSE value - last END AS inc FROM (SELECT *, lag(value) OVER (PARTITION BY topic ORDER BY ts, event_id) AS last
        FROM (SELECT ts, event_id, {_TOPIC}, event_id % 1000 AS value FROM events) AS s
        WHERE topic NOT LIKE '\\_\\_%' ESCAPE '\\') AS told)"""


@query(f"""WITH {_GROWN},
    spread AS (SELECT topic, ts, event_id, inc, (epoch_us(ts) // 60000000) + 1 + k AS w_end
        FROM grown, (SELECT unnest([0, 1, 2, 3, 4]) AS k) AS ks),
    windows AS (SELECT topic, w_end, count(*) AS n, min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b,
        sum(inc) - arg_min(inc, event_id) AS increase FROM spread GROUP BY topic, w_end)
    SELECT topic, make_timestamp(w_end * 60000000) AS window_end, CAST(increase AS DOUBLE) AS increase,
        CAST(increase AS DOUBLE) / ((b - a) / 1000000.0) AS rate FROM windows WHERE n > 1 AND b > a""")
def rate_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.message_rate(_samples(spark, sf_dir, "event_id % 1000").drop("partition"), ["event_id"])


@query(f"""WITH grown AS (SELECT topic, broker, ts, event_id, CASE WHEN last IS NULL THEN 0 WHEN value < last THEN value
        ELSE value - last END AS inc FROM (SELECT *, lag(value) OVER (PARTITION BY topic, broker ORDER BY ts, event_id) AS last
        FROM (SELECT ts, event_id, {_TOPIC}, event_id % 2 AS broker, event_id % 1000 AS value FROM events) AS s
        WHERE topic NOT LIKE '\\_\\_%' ESCAPE '\\') AS told),
    spread AS (SELECT topic, broker, ts, event_id, inc, (epoch_us(ts) // 60000000) + 1 + k AS w_end
        FROM grown, (SELECT unnest([0, 1, 2, 3, 4]) AS k) AS ks),
    windows AS (SELECT topic, broker, w_end, count(*) AS n, min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b,
        sum(inc) - arg_min(inc, event_id) AS increase FROM spread GROUP BY topic, broker, w_end)
    SELECT topic, make_timestamp(w_end * 60000000) AS window_end, CAST(sum(increase) AS DOUBLE) AS increase,
        round(sum(CAST(increase AS DOUBLE) / ((b - a) / 1000000.0)), 9) AS rate FROM windows WHERE n > 1 AND b > a
    GROUP BY topic, w_end""")
def rate_by_broker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two brokers count on their own; a topic's rate is the sum of theirs."""
    samples = _samples(spark, sf_dir, "event_id % 1000").drop("partition").withColumn("broker", F.col("event_id") % 2)
    return monitoring.message_rate(samples, ["event_id"]).withColumn("rate", F.round("rate", 9))


@query(f"""SELECT topic, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS lag FROM ({latest_sql(
    f"SELECT ts, event_id, {_TOPIC}, user_id, event_id % 2 AS grp, value FROM events", 'topic, user_id, grp', 'ts DESC, event_id DESC')}) AS l
    WHERE topic NOT LIKE '\\_\\_%' ESCAPE '\\' GROUP BY topic""")
def lag_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two consumer groups lag behind one partition each by their own."""
    samples = _samples(spark, sf_dir, "CAST(value AS DECIMAL(18,2))").withColumn("group", F.col("event_id") % 2)
    return monitoring.lag_by_topic(samples, ["event_id"]).select("topic", F.col("lag").cast("double"))



def _held_sql(samples: str, series: str, test: str, seconds: int) -> str:
    return f"""WITH told AS (SELECT *, lag({test}) OVER w AS held, {test} AS holds FROM ({samples}) AS s
            WINDOW w AS (PARTITION BY {series} ORDER BY ts, event_id)),
        marked AS (SELECT *, max(CASE WHEN holds AND NOT coalesce(held, false) THEN ts END)
            OVER (PARTITION BY {series} ORDER BY ts, event_id) AS active_since FROM told)
        SELECT {series}, active_since, min(ts) AS firing_since, max(ts) AS last_seen, count(*) AS samples
        FROM marked WHERE holds AND epoch_us(ts) - epoch_us(active_since) >= {seconds} * 1000000
        GROUP BY {series}, active_since"""


def _alert_sql(labels: str, series: str, seconds: int) -> str:
    return _held_sql(f"SELECT ts, event_id, {labels}, value / 10 AS value FROM events", series, "(value < 1)", seconds)


def _alert_samples(spark: SparkSession, sf_dir: str, **labels: str) -> DataFrame:
    names = [f"{v} AS {k}" for k, v in labels.items()]
    return table(spark, sf_dir, "events").selectExpr("CAST(ts AS TIMESTAMP) AS ts", "event_id", *names, "value / 10 AS value")


@query(_alert_sql("event_type AS connector, user_id AS task", "connector, task", monitoring.TASK_SECONDS))
def alert_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.task_alerts(_alert_samples(spark, sf_dir, connector="event_type", task="user_id"), ["event_id"], step_seconds=None)


@query(_alert_sql("event_type AS broker", "broker", monitoring.REPLICA_SECONDS).replace("(value < 1)", "(value > 0)"))
def alert_replicas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.replica_alerts(_alert_samples(spark, sf_dir, broker="event_type"), ["event_id"], step_seconds=None)


@query(_alert_sql("event_type AS cluster", "cluster", monitoring.BROKER_SECONDS))
def alert_broker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.broker_alerts(_alert_samples(spark, sf_dir, cluster="event_type"), ["event_id"], step_seconds=None)


@query(_held_sql(f"SELECT ts, event_id, {_TOPIC}, value FROM events WHERE event_type <> 'error'", "topic",
                 "(value > 2)", 1800))
def alert_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = monitoring.own_topics(_samples(spark, sf_dir, "value"))
    return monitoring.alerts(samples, ["topic"], F.col("value") > 2, 1800, ["event_id"], step_seconds=None)


@query(_held_sql(
    f"SELECT ts, event_id, {_TOPIC}, user_id AS partition, value * 200 AS value FROM events WHERE event_type <> 'error'",
    "topic, partition", "(value > 1000)", 300))
def alert_lag_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.lag_alerts(_samples(spark, sf_dir, "value * 200"), ["event_id"], step_seconds=None)


@query(f"""SELECT count(*) FILTER (value / 10 < 1) AS failed_tasks, min(value / 10) AS lowest_ratio FROM ({latest_sql(
    'SELECT * FROM events', 'event_type, user_id', 'ts DESC, event_id DESC')}) AS n""")
def failed_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "events").selectExpr(
        "ts", "event_id", "event_type AS connector", "user_id AS task", "value / 10 AS value"
    )
    return monitoring.failing_tasks(samples, ["event_id"])


@query(f"""SELECT CAST(sum(CAST(floor(value) AS DECIMAL(18,0))) AS DOUBLE) AS running FROM ({latest_sql(
    'SELECT * FROM events', 'event_type', 'ts DESC, event_id DESC')}) AS n""")
def running_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "events").selectExpr(
        "ts", "event_id", "event_type AS connector", "CAST(floor(value) AS DOUBLE) AS value"
    )
    return monitoring.running_tasks(samples, ["event_id"])


@query("""WITH told AS (SELECT *, lag(value) OVER (PARTITION BY connector, task ORDER BY ts, event_id) AS last
        FROM (SELECT ts, event_id, event_type AS connector, user_id // 50 AS task, event_id % 5000 AS value
        FROM events) AS s),
    spread AS (SELECT connector, task, ts, event_id, CASE WHEN last IS NULL THEN 0 WHEN value < last THEN value
        ELSE value - last END AS inc, (epoch_us(ts) // 60000000) + 1 + k AS w_end
        FROM told, (SELECT unnest([0, 1, 2, 3, 4]) AS k) AS ks),
    windows AS (SELECT connector, task, w_end, count(*) AS n, min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b,
        sum(inc) - arg_min(inc, event_id) AS increase FROM spread GROUP BY connector, task, w_end)
    SELECT connector, task, make_timestamp(w_end * 60000000) AS window_end, CAST(increase AS DOUBLE) AS increase,
        CAST(increase AS DOUBLE) / ((b - a) / 1000000.0) AS rate FROM windows WHERE n > 1 AND b > a""")
def error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "events").selectExpr(
        "CAST(ts AS TIMESTAMP) AS ts", "event_id", "event_type AS connector", "user_id DIV 50 AS task",
        "event_id % 5000 AS value",
    )
    return monitoring.error_rate(samples, ["event_id"])


@query(f"""WITH told AS (SELECT *, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS last
        FROM (SELECT ts, event_id, event_type, event_id % 1000 AS value FROM events) AS s),
    spread AS (SELECT event_type, ts, event_id, CASE WHEN last IS NULL THEN 0 WHEN value < last THEN value
        ELSE value - last END AS inc, (epoch_us(ts) // 60000000) + 1 + k AS w_end
        FROM told, (SELECT unnest([0, 1, 2, 3, 4]) AS k) AS ks),
    windows AS (SELECT event_type, w_end, count(*) AS n, min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b,
        sum(inc) - arg_min(inc, event_id) AS increase FROM spread GROUP BY event_type, w_end)
    SELECT make_timestamp(w_end * 60000000) AS window_end,
        round(sum(CAST(increase AS DOUBLE) / ((b - a) / 1000000.0)), 6) AS rate
    FROM windows WHERE n > 1 AND b > a GROUP BY w_end""")
def rate_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "events").selectExpr(
        "CAST(ts AS TIMESTAMP) AS ts", "event_id", "event_type AS topic", "event_id % 1000 AS value"
    )
    return monitoring.total_rate(samples, ["event_id"]).withColumn("rate", F.round("rate", 6))


@query(_held_sql(
    """SELECT date_trunc('minute', ts) AS ts, 0 AS event_id, event_type AS topic, sum(floor(value) * 2000) AS value
    FROM events WHERE event_type <> 'error' GROUP BY 1, 3""", "topic", "(value > 10000)", 600))
def alert_lag_critical(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = _samples(spark, sf_dir, "floor(value) * 2000").withColumn("ts", F.date_trunc("minute", "ts"))
    return monitoring.critical_lag_alerts(samples, step_seconds=None)


# Alerts as they are evaluated: every five minutes here, each series with its newest sample of the last three hours.
_STEP, _LOOKBACK = 300, 10_800


def _grid_sql(samples: str, series: str) -> str:
    """(series, ts, event_id, value) at every step: the newest known sample of each series, while it is not too old."""
    return f"""SELECT {series}, make_timestamp(mark * {_STEP}000000) AS ts, 0 AS event_id, value FROM (
        SELECT *, unnest(generate_series(slot, least(last, coalesce(following - 1, last)))) AS mark FROM (
            SELECT *, lead(slot) OVER (PARTITION BY {series} ORDER BY slot) AS following FROM (
                SELECT {series}, CAST(ceil(epoch_us(ts) / {_STEP}000000) AS BIGINT) AS slot, arg_max(value, (ts, event_id)) AS value,
                    CAST((max(epoch_us(ts)) + {_LOOKBACK}000000 - 1) // {_STEP}000000 AS BIGINT) AS last
                FROM ({samples}) AS s WHERE value IS NOT NULL GROUP BY ALL) AS thinned) AS told WHERE last >= slot) AS points"""


def _on_grid_held_sql(samples: str, by: str, test: str, seconds: int) -> str:
    """Episodes over the grid: a step without a value ends one."""
    return f"""WITH told AS (SELECT *, coalesce(lag({test}) OVER w AND epoch_us(ts) - lag(epoch_us(ts)) OVER w <= {_STEP}000000, false) AS held,
            {test} AS holds FROM ({samples}) AS s WINDOW w AS (PARTITION BY {by} ORDER BY ts)),
        marked AS (SELECT *, max(CASE WHEN holds AND NOT held THEN ts END) OVER (PARTITION BY {by} ORDER BY ts) AS active_since FROM told)
        SELECT {by}, active_since, min(ts) AS firing_since, max(ts) AS last_seen, count(*) AS samples FROM marked
        WHERE holds AND epoch_us(ts) - epoch_us(active_since) >= {seconds} * 1000000 GROUP BY {by}, active_since"""


_GROUPED = f"""SELECT ts, event_id, {_TOPIC}, user_id % 3 AS partition, event_id % 2 AS "group",
    CASE WHEN event_id % 7 <> 0 THEN floor(value) * {{}} END AS value FROM events WHERE event_type <> 'error'"""


def _grouped(spark: SparkSession, sf_dir: str, factor: int) -> DataFrame:
    """Lags of two consumer groups on three partitions of a topic, all scraped at moments of their own; a seventh of the scrapes failed."""
    samples = _samples(spark, sf_dir, f"CASE WHEN event_id % 7 <> 0 THEN floor(value) * {factor} END")
    return samples.withColumns({"partition": F.col("partition") % 3, "group": F.col("event_id") % 2})


_EVALUATED = {"step_seconds": _STEP, "lookback_seconds": _LOOKBACK}
_LABELS = '"group", topic, partition'


@query(_on_grid_held_sql(_grid_sql(_GROUPED.format(20), _LABELS), _LABELS, "(value > 1000)", monitoring.LAG_HIGH_SECONDS))
def alert_lag_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group that is behind fires on its own, whatever other groups on its partition do."""
    return monitoring.lag_alerts(_grouped(spark, sf_dir, 20), ["event_id"], **_EVALUATED)


@query(_on_grid_held_sql(
    f"SELECT topic, ts, sum(value) AS value FROM ({_grid_sql(_GROUPED.format(50), _LABELS)}) AS g GROUP BY topic, ts",
    "topic", "(value > 10000)", monitoring.LAG_CRITICAL_SECONDS))
def alert_lag_critical_unaligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions and groups scraped at different moments add up to a topic's lag."""
    return monitoring.critical_lag_alerts(_grouped(spark, sf_dir, 50), ["event_id"], **_EVALUATED)


@query(_grid_sql(_GROUPED.format(1), _LABELS).replace("0 AS event_id, ", ""))
def series_on_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every series is worth at each step, failed scrapes bridged."""
    samples = monitoring.own_topics(_grouped(spark, sf_dir, 1))
    seen = on_grid(samples, ["group", "topic", "partition"], _STEP, _LOOKBACK, tie_break=["event_id"])
    return seen.withColumn("value", F.col("value").cast("double"))
