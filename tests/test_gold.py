import pytest

from datetime import datetime

from tidemark.plans import (
    driver_performance,
    payment_funnel,
    payment_lifecycle,
    payments_by_status,
    revenue_per_restaurant,
    user_behavior,
)


def rows(df, *key):
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r for r in df.collect()}


def test_payments_by_status_groups_null_and_ignores_null_amounts(spark):
    schema = "payment_id string, status string, amount double, net_amount double, platform_fee double, refund_amount double, tax_amount double"
    data = [("1", "ok", 0.1, 1.0, None, None, 1.0), ("2", "ok", 0.2, 2.0, None, None, 1.0), ("3", None, None, 1.0, 1.0, 1.0, 1.0)]
    got = rows(payments_by_status(spark.createDataFrame(data, schema)), "status")
    assert got["ok"].total_amount_brl == pytest.approx(0.3) and got["ok"].payment_count == 2
    assert got["ok"].total_platform_fee_brl is None
    assert got[None].avg_amount_brl is None and got[None].total_amount_brl is None


def events(spark):
    t = [datetime(2024, 1, 1, 0, 0, s, 900000) for s in range(10)]
    data = [
        ("e1", "p", '{"event_name": "created"}', t[0]), ("e3", "p", "settled", t[5]), ("e2", "p", None, t[9]),
        ("e4", "q", None, t[1]), ("e5", "q", "[1]", t[2]), ("e7", "r", "b", t[2]), ("e6", "r", "a", t[2]), ("e8", "s", '{"x": 1}', None),
    ]
    return spark.createDataFrame(data, "event_id string, payment_id string, event string, dt_current_timestamp timestamp")


def test_funnel_reads_json_or_plain_names(spark):
    got = rows(payment_funnel(events(spark)), "event_name")
    assert set(got) == {"created", "settled", "[1]", "a", "b", '{"x": 1}'}
    assert got["created"].event_count == 1 and got["created"].unique_payment_count == 1


def test_lifecycle_orders_by_time_then_id_and_counts_nameless_events(spark):
    got = rows(payment_lifecycle(events(spark)), "payment_id")
    assert (got["p"].event_count, got["p"].first_event_name, got["p"].last_event_name) == (3, "created", "settled")
    assert got["p"].lifecycle_duration_sec == 9.0
    assert (got["q"].first_event_name, got["q"].last_event_name) == ("[1]", "[1]")
    assert (got["r"].first_event_name, got["r"].last_event_name) == ("a", "b")
    assert got["s"].lifecycle_duration_sec is None


def test_driver_performance(spark):
    shifts = spark.createDataFrame(
        [("s1", "7", 3, 10.10, 4.5, 1.25, 60), ("s2", "7", 2, 20.20, None, 1.5, 61), ("s3", "x9", 1, 1.0, 5.0, 1.0, 1)],
        "shift_id string, driver_id string, num_orders int, earnings_brl double, shift_rating double, distance_covered_km double, shift_duration_min int",
    )
    drivers = spark.createDataFrame(
        [("u1", "7", "Old", "A", "c", "bike", 1), ("u2", "7", "New", "A", "c", "car", 2), ("u3", "8", "No", "S", "c", "car", 1)],
        "uuid string, driver_id string, first_name string, last_name string, city string, vehicle_type string, __source_ts_ms bigint",
    )
    orders = spark.createDataFrame([("o1", "7"), ("o2", "007"), ("o2", "7"), ("o3", None), ("o4", "zz")], "order_id string, driver_key string")
    got = rows(driver_performance(shifts, drivers, orders), "driver_id")
    assert set(got) == {"7", "x9"}
    r = got["7"]
    assert (r.first_name, r.total_shifts, r.total_orders, r.order_count) == ("New", 2, 5, 2)
    assert (r.total_earnings_brl, r.avg_shift_rating, r.total_distance_km, r.avg_shift_duration_min) == pytest.approx((30.3, 4.5, 2.75, 60.5))
    assert got["x9"].order_count is None and got["x9"].first_name is None


def test_revenue_does_not_repeat_orders_per_item(spark):
    orders = spark.createDataFrame(
        [("o1", "r1", 100.0), ("o2", "r1", 50.0), ("o3", "r2", 10.0), ("o4", None, 5.0), ("o5", "r3", 9.0)],
        "order_id string, restaurant_key string, total_amount double",
    )
    items = spark.createDataFrame(
        [(f"i{n}", "o1", 10.0, 0.5) for n in range(40)]
        + [("x", "o3", 7.0, None), ("y", "o4", 1.0, 0.1), ("z", "lost", 1.0, 0.1), ("w", None, 1.0, 0.1)],
        "order_item_id string, order_id string, subtotal double, discount_applied double",
    )
    places = spark.createDataFrame(
        [("u1", "r1", "First", "C", "x", 1), ("u2", "r1", "Second", "C", "x", 1)],
        "uuid string, cnpj string, name string, city string, cuisine_type string, __source_ts_ms bigint",
    )
    got = rows(revenue_per_restaurant(items, orders, places), "restaurant_cnpj")
    assert set(got) == {"r1", "r2", None}
    r = got["r1"]
    assert (r.total_orders, r.total_items_sold, r.total_revenue_brl, r.avg_order_value_brl) == (2, 40, 400.0, 75.0)
    assert r.avg_discount_brl == 0.5 and r.restaurant_name == "Second"
    assert got["r2"].avg_discount_brl is None and got["r2"].restaurant_name is None
    assert got[None].total_orders is None and got[None].total_items_sold == 1


def test_user_behavior_keeps_users_of_either_side_once(spark):
    searches = spark.createDataFrame([("s1", 1, "pizza", 4), ("s2", 1, "pizza", 7), ("s3", 2, None, None)], "search_id string, user_id int, query_text string, result_count int")
    seen = spark.createDataFrame([("e1", 1, "view", "p"), ("e2", 1, "click", "p"), ("e3", 3, "purchase", "q")], "event_id string, user_id int, event_type string, product_id string")
    users = spark.createDataFrame([("9", 1, "A", "BR"), ("8", 1, "B", "BR"), ("7", 3, "C", "PT"), ("6", None, "D", "PT")], "cpf string, user_id int, city string, country string")
    got = rows(user_behavior(searches, seen, users), "user_id")
    assert set(got) == {1, 2, 3}
    assert tuple(got[1])[1:9] == (2, 5.5, 1, 2, 1, 1, 0, 1) and got[1].cpf == "9"
    assert got[2].total_rec_events is None and got[2].avg_results_per_search is None and got[2].cpf is None
    assert got[3].total_searches is None and got[3].rec_purchases == 1 and got[3].country == "PT"


def test_sums_do_not_depend_on_the_order_of_addition(spark):
    schema = "payment_id string, status string, amount double, net_amount double, platform_fee double, refund_amount double, tax_amount double"
    data = [(str(i), "ok", i * 0.1 + 1e9, 0.0, 0.0, 0.0, 0.0) for i in range(1000)]
    data = [(a, b, round(c, 2), *d) for a, b, c, *d in data]
    answers = {
        payments_by_status(spark.createDataFrame(data, schema).repartition(n)).first().total_amount_brl for n in (1, 3, 7)
    }
    assert max(answers) - min(answers) <= 1e-12 * max(answers)


def test_sums_take_every_value_in_full(spark):
    import math

    schema = "status string, payment_id long, amount double, net_amount double, platform_fee double, refund_amount double, tax_amount double"
    rows = [("small", i, 0.004, 0.0, 0.0, 0.0, 0.0) for i in range(1000)] + [("large", 1, 1e18, math.nan, math.inf, 0.0, 0.0), ("large", 2, 1.0, 1.0, 1.0, None, None)]
    out = {r.status: r for r in payments_by_status(spark.createDataFrame(rows, schema)).collect()}
    assert abs(out["small"].total_amount_brl - 4.0) < 1e-9 and abs(out["small"].avg_amount_brl - 0.004) < 1e-12
    assert out["large"].total_amount_brl == 1e18 and out["large"].avg_amount_brl == 5e17
    assert math.isnan(out["large"].total_net_amount_brl) and out["large"].total_platform_fee_brl == math.inf
