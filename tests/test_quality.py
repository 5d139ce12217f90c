import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.contracts import CONTRACTS, Contract, Field, Rule, contract
from tidemark.functions import driver_key, rule_sql
from tidemark.operators import (
    apply_reject,
    flag_clashing,
    observe_warnings,
    quarantine_condition,
    reject_conditions,
    rule_counts,
    split_quarantine,
    unique_against_target,
    warn_conditions,
)


def made(*rules):
    fields = tuple(Field(n, t) for n, t in (("a", "string"), ("b", "double"), ("at", "timestamp")))
    return Contract("made", ("bronze", "silver"), "s", "t", ("a",), fields, tuple(rules))


def rule(check, action="quarantine", field="a", scope=("silver",), values=()):
    return Rule(field, check, action, scope, values=values)


PARCELS = [("p1", 2.5, "2020-05-01", "sent"), ("p2", None, "2031-01-01", "lost"), (None, 9.0, None, "it's"), ("p4", -1.0, "2020-05-02", None)]


def passing(spark, parcel_rule, as_of="2025-01-01"):
    """Places of the parcels that pass a rule; every row must pass or fail, never neither."""
    fields = tuple(Field(n, t) for n, t in (("code no", "string"), ("weight", "double"), ("due", "timestamp"), ("state", "string")))
    shipped = Contract("parcels", ("bronze", "silver"), "s", "t", ("code no",), fields, (parcel_rule,))
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(PARCELS)], "place int, `code no` string, weight double, due string, state string")
    verdict = rows.withColumn("due", F.col("due").cast("timestamp")).select("place", F.expr(rule_sql(parcel_rule, as_of, shipped)).alias("ok")).collect()
    assert all(r.ok is not None for r in verdict)
    return {r.place for r in verdict if r.ok}


@pytest.mark.parametrize(
    ("check", "column", "values", "places"),
    [
        ("not_null", "code no", (), {0, 1, 3}),
        ("not_null", "state", (), {0, 1, 2}),
        ("allowed_values", "state", ("sent", "it's"), {0, 2, 3}),
        ("allowed_values", "weight", (9, -1), {1, 2, 3}),
        ("not_future", "due", (), {0, 2, 3}),
        ("unique", "state", (), {0, 1, 2, 3}),
    ],
)
def test_rows_that_pass_a_rule(spark, check, column, values, places):
    assert passing(spark, rule(check, field=column, values=values)) == places


def test_a_check_nobody_knows_is_refused():
    with pytest.raises(ValueError):
        rule_sql(rule("shiny"))


def test_rules_act_in_their_own_scope(spark):
    rules = [rule("not_null", action, scope=scope) for action, scope in (("reject", ("bronze",)), ("quarantine", ("silver",)), ("warn", ("bronze", "silver")))]
    c = made(*rules, rule("unique"))
    assert len(reject_conditions(c, "bronze")) == 1 and not reject_conditions(c, "silver")
    assert len(warn_conditions(c, "bronze")) == len(warn_conditions(c, "silver")) == 1
    rows = spark.createDataFrame([("x",), (None,)], "a string")
    assert quarantine_condition(c, "bronze") is None
    assert [r.a for r in rows.where(quarantine_condition(c, "silver")).collect()] == [None]


@pytest.mark.parametrize("name", CONTRACTS)
def test_quarantine_never_looks_at_the_operation(name):
    condition = quarantine_condition(contract(name), "silver") or ""
    assert "__op" not in condition and "__deleted" not in condition


def frame(spark):
    rows = [("x", 1.0, "2024-01-01"), (None, 1.0, "2030-01-01"), ("z", None, None), ("x", 3.0, "2024-01-01")]
    return spark.createDataFrame(rows, "a string, b double, d string").withColumn("at", F.col("d").cast("timestamp"))


def test_split_is_total_and_disjoint(spark):
    c = made(rule("not_null"), rule("allowed_values", field="b", values=(1, 2)))
    clean, bad = split_quarantine(frame(spark), c)
    assert sorted(r.b or 0 for r in clean.collect()) == [0, 1.0]
    assert sorted(r.b for r in bad.collect()) == [1.0, 3.0]
    untouched, none = split_quarantine(frame(spark), made())
    assert untouched.count() == 4 and none.count() == 0 and none.columns == untouched.columns


def test_reject_drops_and_warn_keeps(spark):
    c = made(rule("not_null", "reject", scope=("bronze",)), rule("not_future", "warn", "at"))
    assert apply_reject(frame(spark), c).count() == 3
    seen = Observation()
    assert observe_warnings(frame(spark), c, "silver", seen, "2025-01-01").count() == 4
    assert seen.get == {"rows": 4, "at_not_future": 1}


def test_rule_counts(spark):
    c = made(rule("not_null"), rule("not_future", "warn", "at"), rule("unique"))
    got = {(r.rule, r.on_failure): (r.passed, r.failed) for r in rule_counts(frame(spark), c, "silver", as_of="2025-01-01").collect()}
    assert got == {("a_not_null", "quarantine"): (3, 1), ("at_not_future", "warn"): (3, 1), ("a_unique", "quarantine"): (4, 0)}
    assert rule_counts(frame(spark), made(), "silver").count() == 0


HEAVY = [(f"k{i}", "hot" if i % 3 else f"v{i}") for i in range(90)] + [("v1", "one"), ("v1", "one"), ("n1", None), ("n2", None)]


@pytest.mark.parametrize("heavy_rows", [2, 100_000])
def test_clashes_with_and_without_heavy_values(spark, heavy_rows):
    got = flag_clashing(spark.createDataFrame(HEAVY, "id string, v string"), "v", ["id"], "c", heavy_rows).collect()
    assert sorted((r.id, r.v or "", r.c) for r in got) == sorted((i, v or "", v == "hot") for i, v in HEAVY)


@pytest.mark.parametrize("heavy_rows", [1, 100_000])
def test_clash_with_the_target_ignores_older_versions_of_a_row(spark, heavy_rows):
    target = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("d", None)], "id string, v string")
    batch = spark.createDataFrame([("a", "1"), ("x", "2"), ("c", "9"), ("y", "3"), ("p", "7"), ("q", "7"), ("r", None)], "id string, v string")
    got = {r.id: r.c for r in unique_against_target(batch, target, "v", ["id"], "c", heavy_rows).collect()}
    # c moved from 3 to 9, so y may take 3.
    assert got == {"a": False, "x": True, "c": False, "y": False, "p": True, "q": True, "r": False}


def test_driver_keys_match_plain_arithmetic(spark):
    keys = ["ir7605723", "wr2179397", "", None, "abc", "353", "354", "9" * 18, "9" * 19, "x1" * 40]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select("k", driver_key(F.col("k")).alias("d")).collect()

    def plain(k):
        digits = "".join(c for c in k or "" if c.isdigit())
        return str(int(digits or "0") % 354 + 1) if k else None

    assert [r.d for r in rows] == [plain(k) for k in keys]
