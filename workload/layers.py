"""Bronze, silver and quarantine of every bound domain, and the six gold tables on top."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import (
    bronze,
    driver_performance,
    payment_funnel,
    payment_lifecycle,
    payments_by_status,
    revenue_per_restaurant,
    silver,
    user_behavior,
)
from tidemark.plans.gold import order_values
from tidemark.plans.users import candidates, split_users
from tidemark.sources.storage import work_folder, written
from workload.inputs import INPUTS, Input, silver_sql
from workload.registry import query, register, table

AS_OF = "2024-01-15 00:00:00"


def bronze_of(spark: SparkSession, sf_dir: str, domain: str) -> DataFrame:
    bound = INPUTS[domain]
    return bronze(bound.frame(spark, sf_dir), bound.contract, AS_OF)


def silver_of(spark: SparkSession, sf_dir: str, domain: str) -> tuple[DataFrame, DataFrame]:
    bound = INPUTS[domain]
    return silver(bronze_of(spark, sf_dir, domain), bound.contract, AS_OF, bound.tie_break)


def _register_domain(bound: Input) -> None:
    domain, contract = bound.domain, bound.contract
    key = contract.keys[0]
    register(
        f"bronze_{domain}",
        lambda spark, sf_dir: bronze_of(spark, sf_dir, domain).select(*bound.names),
        f"SELECT * FROM ({bound.sql}) AS records WHERE {key} IS NOT NULL",
    )
    if "silver" not in contract.layers or domain.startswith("users_"):
        return
    register(
        f"silver_{domain}",
        lambda spark, sf_dir: silver_of(spark, sf_dir, domain)[0].select(*bound.names),
        silver_sql(domain),
    )
    required = [r.field for r in contract.rules_for("silver", "quarantine") if r.check == "not_null"]
    register(
        f"quarantine_{domain}",
        lambda spark, sf_dir: silver_of(spark, sf_dir, domain)[1].select(*bound.names),
        f"SELECT * FROM ({bound.sql}) AS records WHERE {key} IS NOT NULL"
        f" AND ({' OR '.join(f'{c} IS NULL' for c in required)})",
    )


for _bound in INPUTS.values():
    _register_domain(_bound)


# --- users ------------------------------------------------------------------------------------

_PERSON = """
    cur_{s} AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY key ORDER BY __source_ts_ms DESC,
            CASE __op WHEN 'd' THEN 3 ELSE 2 END DESC, uuid DESC) AS place
        FROM (SELECT *, replace(replace(cpf, '.', ''), '-', '') AS key FROM ({sql}) AS r) AS k
        WHERE key IS NOT NULL) AS ranked WHERE place = 1 AND __op <> 'd')"""

_FUSED = f"""WITH {_PERSON.format(s='m', sql=INPUTS['users_mongo'].sql)},
    {_PERSON.format(s='s', sql=INPUTS['users_mssql'].sql)},
    fused AS (SELECT coalesce(m.key, s.key) AS cpf, coalesce(m.user_id, s.user_id) AS user_id,
        m.uuid AS uuid_mongo, s.uuid AS uuid_mssql, m.email, s.first_name, s.last_name,
        coalesce(m.phone_number, s.phone_number) AS phone_number, m.city,
        coalesce(m.country, s.country) AS country, m.delivery_address, s.birthday, s.job,
        CAST(NULL AS STRING) AS company_name
        FROM cur_m AS m FULL OUTER JOIN cur_s AS s ON m.key = s.key),
    repeated AS (SELECT user_id FROM fused WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1)"""

_USERS = f"{_FUSED} SELECT * FROM fused WHERE user_id IS NULL OR user_id NOT IN (SELECT user_id FROM repeated)"


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_folder(spark, 'users')}/fused"
    sources = [bronze_of(spark, sf_dir, d) for d in ("users_mongo", "users_mssql")]
    return candidates(*sources, ["uuid"], lambda fused: written(fused, path))


@query(_USERS)
def users_unify(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_users(_candidates(spark, sf_dir), AS_OF)
    return good.drop("_ingested_at", "_merged_at")


@query(f"""{_FUSED} SELECT cpf, user_id, user_id IN (SELECT user_id FROM repeated) AS repeated
    FROM fused WHERE user_id IS NOT NULL""")
def users_duplicate_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = _candidates(spark, sf_dir)
    reason = F.col("_quarantine_reason")
    found = tagged.filter(F.col("user_id").isNotNull() & (reason.isNull() | (reason == "duplicate_user_id")))
    return found.select("cpf", "user_id", reason.isNotNull().alias("repeated"))


@query(f"""{_FUSED},
    lost_m AS ({INPUTS['users_mongo'].sql}), lost_s AS ({INPUTS['users_mssql'].sql})
    SELECT *, 'duplicate_user_id' AS _quarantine_reason FROM fused
    WHERE user_id IN (SELECT user_id FROM repeated)
    UNION ALL SELECT NULL, user_id, uuid, NULL, email, NULL, NULL, phone_number, city, country, delivery_address,
        NULL, NULL, NULL, 'missing_cpf' FROM lost_m WHERE cpf IS NULL
    UNION ALL SELECT NULL, user_id, NULL, uuid, NULL, first_name, last_name, phone_number, NULL, country, NULL,
        birthday, job, NULL, 'missing_cpf' FROM lost_s WHERE cpf IS NULL""")
def users_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_users(_candidates(spark, sf_dir), AS_OF)
    return bad.drop("_ingested_at", "_quarantine_ts")


# --- gold -------------------------------------------------------------------------------------


def _sum(column: str) -> str:
    return f"round(sum({column}), 2)"


def _avg(column: str) -> str:
    return f"round(avg({column}), 6)"


def rounded(df: DataFrame) -> DataFrame:
    """Sums to two places and averages to six: doubles are added in any order, here and there."""
    names = [f.name for f in df.schema if f.dataType.simpleString() == "double" and f.name.startswith(("total_", "avg_")) and "duration" not in f.name]
    return df.withColumns({n: F.round(n, 2 if n.startswith("total_") else 6) for n in names})


_NAMED = f"""WITH events_now AS ({silver_sql('payment_events')}),
    named AS (SELECT *, CASE WHEN event LIKE '{{%' THEN coalesce(json_extract_string(event, '$.event_name'), event)
        ELSE event END AS event_name FROM events_now)"""


@query("""SELECT l_returnflag AS status, count(*) AS payment_count, round(sum(l_extendedprice * l_discount * l_tax), 4) AS total_amount_brl,
    round(avg(l_extendedprice * l_discount * l_tax), 4) AS avg_amount_brl FROM lineitem GROUP BY l_returnflag""")
def sum_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of more than two decimals, each counted in full."""
    fine = F.col("l_extendedprice") * F.col("l_discount") * F.col("l_tax")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("status"), F.col("l_orderkey").alias("payment_id"), fine.alias("amount"))
    rows = rows.withColumns({c: F.col("amount") for c in ("net_amount", "platform_fee", "refund_amount", "tax_amount")})
    out = payments_by_status(rows).select("status", "payment_count", "total_amount_brl", "avg_amount_brl")
    return out.withColumns({c: F.round(c, 4) for c in ("total_amount_brl", "avg_amount_brl")})


@query(f"""SELECT status, count(payment_id) AS payment_count, {_sum('amount')} AS total_amount_brl,
    {_avg('amount')} AS avg_amount_brl, {_sum('net_amount')} AS total_net_amount_brl,
    {_sum('platform_fee')} AS total_platform_fee_brl, {_sum('refund_amount')} AS total_refund_amount_brl,
    {_sum('tax_amount')} AS total_tax_amount_brl FROM ({silver_sql('payments')}) AS payments_now GROUP BY status""")
def gold_payments_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(payments_by_status(silver_of(spark, sf_dir, "payments")[0]))


@query(f"""{_NAMED} SELECT event_name, count(event_id) AS event_count,
    count(DISTINCT payment_id) AS unique_payment_count FROM named WHERE event_name IS NOT NULL GROUP BY event_name""")
def gold_payment_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payment_funnel(silver_of(spark, sf_dir, "payment_events")[0])


@query(f"""{_NAMED}, spans AS (SELECT payment_id, count(event_id) AS event_count,
        min(dt_current_timestamp) AS first_event_at, max(dt_current_timestamp) AS last_event_at
        FROM named GROUP BY payment_id),
    ordered AS (SELECT payment_id, event_name,
        row_number() OVER (PARTITION BY payment_id ORDER BY dt_current_timestamp, event_id) AS up,
        row_number() OVER (PARTITION BY payment_id ORDER BY dt_current_timestamp DESC, event_id DESC) AS down
        FROM named WHERE event_name IS NOT NULL)
    SELECT spans.payment_id, event_count, f.event_name AS first_event_name, l.event_name AS last_event_name,
        first_event_at, last_event_at, CAST(CAST(floor(epoch(last_event_at)) AS BIGINT)
        - CAST(floor(epoch(first_event_at)) AS BIGINT) AS DOUBLE) AS lifecycle_duration_sec
    FROM spans LEFT JOIN ordered AS f ON f.payment_id = spans.payment_id AND f.up = 1
        LEFT JOIN ordered AS l ON l.payment_id = spans.payment_id AND l.down = 1""")
def gold_payment_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payment_lifecycle(silver_of(spark, sf_dir, "payment_events")[0])


@query(f"""WITH shifts_now AS ({silver_sql('driver_shifts')}), orders_now AS ({silver_sql('orders')}),
    drivers_now AS ({silver_sql('drivers')}),
    shifts AS (SELECT driver_id, count(shift_id) AS total_shifts, CAST(sum(num_orders) AS BIGINT) AS total_orders,
        {_sum('earnings_brl')} AS total_earnings_brl, {_avg('shift_rating')} AS avg_shift_rating,
        {_sum('distance_covered_km')} AS total_distance_km, avg(shift_duration_min) AS avg_shift_duration_min
        FROM shifts_now GROUP BY driver_id),
    driven AS (SELECT TRY_CAST(driver_key AS INT) AS number, count(DISTINCT order_id) AS order_count
        FROM orders_now WHERE driver_key IS NOT NULL GROUP BY 1)
    SELECT shifts.driver_id, first_name, CAST(NULL AS STRING) AS last_name, city, vehicle_type, total_shifts,
        total_orders, order_count, total_earnings_brl, avg_shift_rating, total_distance_km, avg_shift_duration_min
    FROM shifts LEFT JOIN drivers_now ON drivers_now.driver_id = shifts.driver_id
        LEFT JOIN driven ON TRY_CAST(shifts.driver_id AS INT) = driven.number""")
def gold_driver_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = {d: silver_of(spark, sf_dir, d)[0] for d in ("driver_shifts", "drivers", "orders")}
    return rounded(driver_performance(state["driver_shifts"], state["drivers"], state["orders"]))


@query(f"""WITH items_now AS ({silver_sql('order_items')}), orders_now AS ({silver_sql('orders')}),
    restaurants_now AS ({silver_sql('restaurants')}),
    per_order AS (SELECT restaurant_key, count(DISTINCT order_id) AS total_orders,
        {_avg('total_amount')} AS avg_order_value_brl FROM orders_now GROUP BY restaurant_key),
    sales AS (SELECT o.restaurant_key, count(i.order_item_id) AS total_items_sold,
        {_sum('i.subtotal')} AS total_revenue_brl, {_avg('i.discount_applied')} AS avg_discount_brl
        FROM items_now AS i JOIN orders_now AS o ON i.order_id = o.order_id GROUP BY o.restaurant_key)
    SELECT sales.restaurant_key AS restaurant_cnpj, name AS restaurant_name, city, cuisine_type, total_orders,
        total_items_sold, total_revenue_brl, avg_order_value_brl, avg_discount_brl
    FROM sales LEFT JOIN per_order ON per_order.restaurant_key = sales.restaurant_key
        LEFT JOIN restaurants_now ON restaurants_now.cnpj = sales.restaurant_key""")
def gold_revenue_per_restaurant(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = {d: silver_of(spark, sf_dir, d)[0] for d in ("order_items", "orders", "restaurants")}
    return rounded(revenue_per_restaurant(state["order_items"], state["orders"], state["restaurants"]))


@query(f"""SELECT restaurant_key, count(DISTINCT order_id) AS total_orders,
    {_avg('total_amount')} AS avg_order_value_brl FROM ({silver_sql('orders')}) AS orders_now GROUP BY restaurant_key""")
def order_value_no_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(order_values(silver_of(spark, sf_dir, "orders")[0]))


@query(f"""{_USERS.replace('WITH ', 'WITH searches_now AS (' + silver_sql('search_events') + '), recs_now AS ('
    + silver_sql('recommendations') + '),', 1).replace(' SELECT * FROM fused WHERE', ', people AS (SELECT * FROM fused WHERE', 1)}),
    searches AS (SELECT user_id, count(search_id) AS total_searches, avg(result_count) AS avg_results_per_search,
        count(DISTINCT query_text) AS distinct_queries FROM searches_now GROUP BY user_id),
    seen AS (SELECT user_id, count(event_id) AS total_rec_events,
        count(*) FILTER (event_type = 'view') AS rec_views, count(*) FILTER (event_type = 'click') AS rec_clicks,
        count(*) FILTER (event_type = 'purchase') AS rec_purchases,
        count(DISTINCT product_id) AS distinct_products_seen FROM recs_now GROUP BY user_id)
    SELECT coalesce(searches.user_id, seen.user_id) AS user_id, total_searches, avg_results_per_search,
        distinct_queries, total_rec_events, rec_views, rec_clicks, rec_purchases, distinct_products_seen,
        cpf, city, country
    FROM searches FULL OUTER JOIN seen ON searches.user_id = seen.user_id
        LEFT JOIN people ON people.user_id = coalesce(searches.user_id, seen.user_id)""")
def gold_user_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    people, _ = split_users(_candidates(spark, sf_dir), AS_OF)
    searches, seen = (silver_of(spark, sf_dir, d)[0] for d in ("search_events", "recommendations"))
    return user_behavior(searches, seen, people)
