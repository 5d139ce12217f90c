"""Cross-domain aggregates, recomputed in full: DataFrames in, one DataFrame out.

Every fact is aggregated to its join key before it is joined, so no join sees a key twice and a
key with a large share of the rows is reduced on the map side. Joins carry no hints: adaptive
execution broadcasts a side once its measured size is below the session's threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts.model import SEQUENCE
from tidemark.functions.scalars import event_name, seconds_between
from tidemark.operators.keyed import one_row_per_key

# Measures that are not money are added with this many decimals.


def _newest_first(df: DataFrame, tie: str) -> list[str]:
    """Order for picking one of several dimension rows: the newest change, then the merge key."""
    return [SEQUENCE, tie] if SEQUENCE in df.columns else [tie]


def payments_by_status(payments: DataFrame) -> DataFrame:
    return payments.groupBy("status").agg(
        F.count("payment_id").alias("payment_count"),
        F.sum(F.col("amount")).alias("total_amount_brl"),
        F.avg(F.col("amount")).alias("avg_amount_brl"),
        F.sum(F.col("net_amount")).alias("total_net_amount_brl"),
        F.sum(F.col("platform_fee")).alias("total_platform_fee_brl"),
        F.sum(F.col("refund_amount")).alias("total_refund_amount_brl"),
        F.sum(F.col("tax_amount")).alias("total_tax_amount_brl"),
    )


def payment_funnel(payment_events: DataFrame) -> DataFrame:
    """Events and distinct payments per event name, nameless events left out."""
    named = payment_events.select("event_id", "payment_id", event_name(F.col("event")).alias("event_name"))
    return (
        named.filter(F.col("event_name").isNotNull())
        .groupBy("event_name")
        .agg(
            F.count("event_id").alias("event_count"),
            F.count_distinct("payment_id").alias("unique_payment_count"),
        )
    )


def payment_lifecycle(payment_events: DataFrame) -> DataFrame:
    """First and last event of each payment by event time, event id breaking ties.

    Nameless events count and stretch the time span but lend no name.
    """
    named = payment_events.select(
        "payment_id",
        "event_id",
        F.col("dt_current_timestamp").alias("at"),
        event_name(F.col("event")).alias("event_name"),
    )
    moment = F.when(F.col("event_name").isNotNull(), F.struct("at", "event_id"))
    spans = named.groupBy("payment_id").agg(
        F.count("event_id").alias("event_count"),
        F.min_by("event_name", moment).alias("first_event_name"),
        F.max_by("event_name", moment).alias("last_event_name"),
        F.min("at").alias("first_event_at"),
        F.max("at").alias("last_event_at"),
    )
    duration = seconds_between(F.col("first_event_at"), F.col("last_event_at"))
    return spans.withColumn("lifecycle_duration_sec", duration)


def driver_performance(driver_shifts: DataFrame, drivers: DataFrame, orders: DataFrame) -> DataFrame:
    """Shift totals per driver with the driver's data and the orders assigned to them.

    ``total_orders`` adds the shifts' own counters, ``order_count`` counts distinct orders and is
    null for a driver without any. Driver keys that are no number match nobody.
    """
    shifts = driver_shifts.groupBy("driver_id").agg(
        F.count("shift_id").alias("total_shifts"),
        F.sum("num_orders").alias("total_orders"),
        F.sum(F.col("earnings_brl")).alias("total_earnings_brl"),
        F.avg(F.col("shift_rating")).alias("avg_shift_rating"),
        F.sum(F.col("distance_covered_km")).alias("total_distance_km"),
        F.avg("shift_duration_min").alias("avg_shift_duration_min"),
    )
    people = one_row_per_key(drivers, ["driver_id"], _newest_first(drivers, "uuid")).select(
        "driver_id", "first_name", "last_name", "city", "vehicle_type"
    )
    driven = (
        orders.filter(F.col("driver_key").isNotNull())
        .select(F.col("driver_key").try_cast("int").alias("driver_number"), "order_id")
        .groupBy("driver_number")
        .agg(F.count_distinct("order_id").alias("order_count"))
    )
    number = F.col("driver_id").try_cast("int")
    return (
        shifts.join(people, "driver_id", "left")
        .join(driven, number == F.col("driver_number"), "left")
        .select(
            "driver_id",
            "first_name",
            "last_name",
            "city",
            "vehicle_type",
            "total_shifts",
            "total_orders",
            "order_count",
            "total_earnings_brl",
            "avg_shift_rating",
            "total_distance_km",
            "avg_shift_duration_min",
        )
    )


def order_values(orders: DataFrame) -> DataFrame:
    """Orders and their average value per restaurant, each order counted once however many items it has."""
    return orders.groupBy("restaurant_key").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.avg(F.col("total_amount")).alias("avg_order_value_brl"),
    )


def revenue_per_restaurant(order_items: DataFrame, orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Sales and order values of the restaurants that sold at least one item.

    Items are added up per order before they meet the orders, so an order keeps its one row and
    its value is not repeated per item. Order and item measures then come out of one aggregation
    over that join, and orders are read once. Items of unknown orders have no restaurant.
    """
    baskets = order_items.groupBy("order_id").agg(
        F.count("order_item_id").alias("items"),
        F.sum("subtotal").alias("revenue"),
        F.sum("discount_applied").alias("discount"),
        F.count("discount_applied").alias("discounts"),
    )
    sales = (
        orders.select("order_id", "restaurant_key", "total_amount")
        .join(baskets, "order_id", "left")
        .groupBy("restaurant_key")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.avg(F.col("total_amount")).alias("order_value"),
            F.count("items").alias("baskets"),
            F.sum("items").alias("total_items_sold"),
            F.sum("revenue").alias("total_revenue_brl"),
            F.try_divide(F.sum("discount"), F.sum("discounts")).alias("avg_discount_brl"),
        )
        .filter(F.col("baskets") > 0)
    )
    places = one_row_per_key(restaurants, ["cnpj"], _newest_first(restaurants, "uuid")).select(
        F.col("cnpj").alias("restaurant_key"), F.col("name").alias("restaurant_name"), "city", "cuisine_type"
    )
    # Orders without a restaurant sold items too, but no order value is attributed to them.
    known = F.col("restaurant_key").isNotNull()
    return sales.join(places, "restaurant_key", "left").select(
        F.col("restaurant_key").alias("restaurant_cnpj"),
        "restaurant_name",
        "city",
        "cuisine_type",
        F.when(known, F.col("orders")).alias("total_orders"),
        "total_items_sold",
        "total_revenue_brl",
        F.when(known, F.col("order_value")).alias("avg_order_value_brl"),
        "avg_discount_brl",
    )


def user_behavior(search_events: DataFrame, recommendations: DataFrame, users: DataFrame) -> DataFrame:
    """Searches and recommendation events per user; counts stay null for a side the user is not in."""
    searches = search_events.groupBy("user_id").agg(
        F.count("search_id").alias("total_searches"),
        F.avg("result_count").alias("avg_results_per_search"),
        F.count_distinct("query_text").alias("distinct_queries"),
    )
    seen = recommendations.groupBy("user_id").agg(
        F.count("event_id").alias("total_rec_events"),
        F.count_if(F.col("event_type") == "view").alias("rec_views"),
        F.count_if(F.col("event_type") == "click").alias("rec_clicks"),
        F.count_if(F.col("event_type") == "purchase").alias("rec_purchases"),
        F.count_distinct("product_id").alias("distinct_products_seen"),
    )
    people = one_row_per_key(users, ["user_id"], ["cpf"]).select("user_id", "cpf", "city", "country")
    return searches.join(seen, "user_id", "full_outer").join(people, "user_id", "left")
