"""The contract domains bound to the test tables.

A binding lists select expressions that both engines understand, so that query and SQL start
from the same records; ``MS(x)`` stands for the epoch milliseconds of a time stamp and ``TAXID(x)``
for a number written as a tax id.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.contracts import CONTRACTS, Contract
from workload.registry import table

_TAXID = (
    r"(substr(lpad(CAST(\1 AS STRING), 9, '0'), 1, 3) || '.' || substr(lpad(CAST(\1 AS STRING), 9, '0'), 4, 3)"
    r" || '.' || substr(lpad(CAST(\1 AS STRING), 9, '0'), 7, 3) || '-00')"
)


@dataclass(frozen=True)
class Input:
    domain: str
    source: str
    columns: tuple[str, ...]
    tie_break: tuple[str, ...]

    @property
    def names(self) -> list[str]:
        return [c.rsplit(" AS ", 1)[1] for c in self.columns]

    @property
    def contract(self) -> Contract:
        return CONTRACTS[self.domain]

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """The records as a source delivers them."""
        texts = [re.sub(r"MS\((\w+)\)", r"unix_millis(CAST(\1 AS TIMESTAMP))", c) for c in self.columns]
        return table(spark, sf_dir, self.source).selectExpr(*[re.sub(r"TAXID\((\w+)\)", _TAXID, c) for c in texts])

    @property
    def sql(self) -> str:
        texts = [re.sub(r"MS\((\w+)\)", r"(epoch_us(\1) // 1000)", c) for c in self.columns]
        return f"SELECT {', '.join(re.sub(r'TAXID\((\w+)\)', _TAXID, c) for c in texts)} FROM {self.source}"


_ITEM = "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"

_ALL = (
    Input("orders", "orders", (
        "CAST(o_orderkey AS STRING) AS order_id",
        "CAST(o_custkey AS STRING) AS user_key",
        "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN NULL"
        " ELSE CAST(o_custkey AS STRING) END AS restaurant_key",
        "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(o_custkey AS STRING) END AS driver_key",
        "CAST(o_custkey AS STRING) AS payment_key",
        "o_orderdate AS order_date",
        "CASE WHEN o_totalprice < 2000 THEN NULL ELSE o_totalprice END AS total_amount",
        "o_orderdate AS dt_current_timestamp",
        "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'd' ELSE 'c' END AS __op",
        "MS(o_orderdate) AS __source_ts_ms",
    ), ("payment_key",)),
    Input("order_items", "lineitem", (
        f"{_ITEM} AS order_item_id",
        "CAST(l_orderkey AS STRING) AS order_id",
        "CASE WHEN l_quantity = 13 THEN NULL ELSE CAST(l_partkey AS STRING) END AS product_id",
        "CAST(l_suppkey AS INT) AS restaurant_id",
        "CAST(l_quantity AS INT) AS quantity",
        "l_extendedprice AS unit_price",
        "l_discount AS discount_applied",
        "l_extendedprice AS subtotal",
        "l_linestatus = 'O' AS is_combo",
        "l_shipdate AS dt_current_timestamp",
        "CASE WHEN l_returnflag = 'R' THEN 'd' ELSE 'u' END AS __op",
        "MS(l_shipdate) AS __source_ts_ms",
    ), ("product_id", "restaurant_id", "quantity", "unit_price", "discount_applied", "is_combo")),
    Input("payments", "orders", (
        "CAST(o_custkey AS STRING) AS payment_id",
        "CAST(o_orderkey AS STRING) AS order_key",
        "CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'O'"
        " THEN 'pending' WHEN o_orderstatus = 'F' THEN 'succeeded' ELSE 'chargeback' END AS status",
        "o_orderpriority AS method",
        "o_totalprice AS amount",
        "o_totalprice - 100 AS net_amount",
        "o_totalprice - 1000 AS platform_fee",
        "CASE WHEN o_orderstatus = 'P' THEN o_totalprice END AS refund_amount",
        "o_totalprice + 10 AS tax_amount",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'USD' ELSE 'BRL' END AS currency",
        "o_orderdate AS dt_current_timestamp",
        "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'd' ELSE 'u' END AS __op",
        "MS(o_orderdate) AS __source_ts_ms",
    ), ("order_key",)),
    Input("payment_events", "events", (
        "CASE WHEN value < 1 THEN NULL ELSE CAST(event_id AS STRING) END AS event_id",
        "CASE WHEN event_type = 'signup' AND value > 15 THEN NULL ELSE CAST(user_id AS STRING) END AS payment_id",
        "CASE WHEN value > 20 THEN '{\"event_name\": \"' || event_type || '\", \"amount\": 1}'"
        " WHEN event_type = 'error' THEN NULL ELSE event_type END AS event",
        "ts AS dt_current_timestamp",
        "'c' AS __op",
        "MS(ts) AS __source_ts_ms",
    ), ("payment_id",)),
    Input("order_status", "events", (
        "CAST(user_id AS INT) AS status_id",
        "CASE WHEN value < 1 THEN NULL ELSE CAST(event_id AS STRING) END AS order_identifier",
        "props AS status",
        "ts AS dt_current_timestamp",
        "CASE WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS __op",
        "MS(ts) AS __source_ts_ms",
    ), ("order_identifier",)),
    Input("driver_shifts", "lineitem", (
        f"{_ITEM} AS shift_id",
        "CASE WHEN l_quantity = 7 THEN NULL ELSE CAST(l_suppkey AS STRING) END AS driver_id",
        "CASE WHEN l_returnflag = 'A' THEN 'Morning' WHEN l_returnflag = 'N' THEN 'Evening' ELSE 'Night' END"
        " AS shift_type",
        "CAST(l_quantity AS INT) AS shift_duration_min",
        "l_linenumber AS num_orders",
        "l_extendedprice AS earnings_brl",
        "l_quantity AS distance_covered_km",
        "l_tax AS shift_rating",
        "l_shipdate AS dt_current_timestamp",
        "'u' AS __op",
        "MS(l_shipdate) AS __source_ts_ms",
    ), ("driver_id", "shift_type", "shift_duration_min", "earnings_brl", "shift_rating")),
    Input("drivers", "supplier", (
        "'d' || CAST(s_suppkey AS STRING) AS uuid",
        "CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(s_suppkey AS STRING) END AS driver_id",
        "s_name AS first_name",
        "CAST(s_nationkey AS STRING) AS city",
        "CASE WHEN s_acctbal > 5000 THEN 'bike' ELSE 'car' END AS vehicle_type",
        "'r' AS __op",
        "s_suppkey AS __source_ts_ms",
    ), ("driver_id",)),
    Input("restaurants", "customer", (
        "'r' || CAST(c_custkey AS STRING) AS uuid",
        "CAST(c_custkey AS INT) AS restaurant_id",
        "CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_custkey AS STRING) END AS cnpj",
        "c_name AS name",
        "c_mktsegment AS cuisine_type",
        "CAST(c_nationkey AS STRING) AS city",
        "'r' AS __op",
        "c_custkey AS __source_ts_ms",
    ), ("restaurant_id",)),
    Input("search_events", "orders", (
        "CAST(o_orderkey AS STRING) AS search_id",
        "CASE WHEN o_totalprice < 2000 THEN NULL ELSE CAST(o_custkey AS INT) END AS user_id",
        "o_orderpriority AS query_text",
        "CAST(floor(o_totalprice / 1000) AS INT) AS result_count",
        "o_orderdate AS timestamp",
        "'c' AS __op",
        "MS(o_orderdate) AS __source_ts_ms",
    ), ("user_id",)),
    Input("recommendations", "events", (
        "CAST(event_id AS STRING) AS event_id",
        "CASE WHEN value < 1 THEN NULL ELSE CAST(user_id AS INT) END AS user_id",
        "event_type AS event_type",
        "props AS product_id",
        "ts AS timestamp",
        "ts AS dt_current_timestamp",
        "'c' AS __op",
        "MS(ts) AS __source_ts_ms",
    ), ("user_id",)),
    Input("users_mongo", "events", (
        "'m' || CAST(event_id AS STRING) AS uuid",
        "CASE WHEN event_type = 'view' THEN NULL ELSE CAST(floor(value * 10) AS INT) END AS user_id",
        "CASE WHEN value < 1 THEN NULL ELSE TAXID(user_id) END AS cpf",
        "'u' || CAST(user_id AS STRING) || '@example.org' AS email",
        "CASE WHEN event_type = 'click' THEN NULL ELSE props END AS phone_number",
        "event_type AS city",
        "CASE WHEN value > 20 THEN 'BR' END AS country",
        "props AS delivery_address",
        "ts AS dt_current_timestamp",
        "CASE WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS __op",
        "MS(ts) AS __source_ts_ms",
    ), ("uuid",)),
    Input("users_mssql", "orders", (
        "'s' || CAST(o_orderkey AS STRING) AS uuid",
        "CAST(o_custkey AS INT) AS user_id",
        "CASE WHEN o_totalprice < 2000 THEN NULL ELSE TAXID(o_custkey) END AS cpf",
        "o_orderpriority AS first_name",
        "o_orderstatus AS last_name",
        "CAST(o_custkey AS STRING) AS phone_number",
        "CAST(o_orderdate AS DATE) AS birthday",
        "o_orderpriority AS job",
        "'PT' AS country",
        "o_orderdate AS dt_current_timestamp",
        "CASE WHEN o_orderstatus = 'P' THEN 'd' ELSE 'u' END AS __op",
        "MS(o_orderdate) AS __source_ts_ms",
    ), ("uuid",)),
    Input("gps_events", "events", (
        "CASE WHEN value < 1 THEN NULL ELSE CAST(event_id AS STRING) END AS gps_id",
        "CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS STRING) END AS order_id",
        "value AS lat",
        "-value AS lon",
        "ts AS timestamp",
        "ts AS dt_current_timestamp",
        "MS(ts) AS __source_ts_ms",
    ), ()),
    Input("inventory", "lineitem", (
        "CASE WHEN l_quantity = 7 THEN NULL ELSE CAST(l_partkey AS STRING) || '@' || CAST(l_suppkey AS STRING) END"
        " AS stock_id",
        "CAST(l_suppkey AS INT) AS restaurant_id",
        "CAST(l_partkey AS STRING) AS product_id",
        "CAST(l_quantity AS INT) AS quantity_available",
        "l_shipdate AS last_updated",
        "MS(l_shipdate) AS __source_ts_ms",
    ), ()),
    Input("menu_sections", "part", (
        "CASE WHEN p_size = 1 THEN NULL ELSE CAST(p_partkey AS STRING) END AS menu_section_id",
        "p_size AS restaurant_id",
        "p_name AS name",
        "p_type AS description",
        "p_retailprice > 950 AS active",
    ), ()),
    Input("products", "part", (
        "CASE WHEN p_size = 2 THEN NULL ELSE CAST(p_partkey AS STRING) END AS product_id",
        "p_size AS restaurant_id",
        "p_name AS name",
        "p_brand AS product_type",
        "p_type AS cuisine_type",
        "p_retailprice AS price",
    ), ()),
    Input("ratings", "lineitem", (
        f"CASE WHEN l_quantity = 9 THEN NULL ELSE {_ITEM} END AS uuid",
        "l_linenumber AS rating_id",
        "CAST(l_suppkey AS STRING) AS restaurant_identifier",
        "CAST(l_linenumber AS DOUBLE) AS rating",
        "l_shipdate AS timestamp",
        "l_shipdate AS dt_current_timestamp",
    ), ()),
    Input("receipts", "orders", (
        "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderkey AS STRING) END AS receipt_id",
        "CAST(o_orderkey AS STRING) AS order_id",
        "CAST(o_custkey AS STRING) AS payment_id",
        "o_totalprice AS total_amount",
        "o_orderdate AS receipt_generated_at",
    ), ()),
    Input("routes", "lineitem", (
        f"CASE WHEN l_linestatus = 'O' AND l_quantity = 5 THEN NULL ELSE {_ITEM} END AS route_id",
        "CAST(l_orderkey AS STRING) AS order_id",
        "CAST(l_suppkey AS STRING) AS driver_id",
        "l_quantity AS distance_km",
        "l_shipdate AS start_time",
        "l_shipdate AS dt_current_timestamp",
    ), ()),
    Input("support_tickets", "conversations", (
        "CASE WHEN role = 'system' THEN NULL ELSE CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) END"
        " AS ticket_id",
        "CAST(turn AS INT) AS user_id",
        "role AS category",
        "text AS description",
    ), ()),
)

INPUTS: dict[str, Input] = {i.domain: i for i in _ALL}


def silver_sql(domain: str) -> str:
    """SQL for the current state of a bound domain: reject, quarantine, latest row, deletes."""
    bound = INPUTS[domain]
    key = bound.contract.keys[0]
    required = [key] + [r.field for r in bound.contract.rules_for("silver", "quarantine") if r.check == "not_null"]
    ties = "".join(f", {c} DESC NULLS LAST" for c in bound.tie_break)
    return f"""SELECT {', '.join(bound.names)} FROM (
        SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY __source_ts_ms DESC NULLS LAST,
            CASE __op WHEN 'r' THEN 0 WHEN 'c' THEN 1 WHEN 'd' THEN 3 ELSE 2 END DESC{ties}) AS place
        FROM ({bound.sql}) AS records WHERE {' AND '.join(f'{c} IS NOT NULL' for c in required)}) AS ranked
        WHERE place = 1 AND coalesce(__op, 'u') <> 'd'"""
