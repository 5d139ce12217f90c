import itertools

import pytest

from tidemark.contracts import contract
from tidemark.operators import conform
from tidemark.plans import bronze, unify_users
from tidemark.plans.users import tag_users

AS_OF = "2024-01-01"


def source(spark, name, rows):
    """Rows of ``(uuid, user_id, cpf, op, sequence)`` as bronze records."""
    df = spark.createDataFrame(rows, "uuid string, user_id int, cpf string, __op string, __source_ts_ms bigint")
    return bronze(df, contract(name), AS_OF)


def unify(spark, mongo, mssql):
    good, bad = unify_users(source(spark, "users_mongo", mongo), source(spark, "users_mssql", mssql), AS_OF)
    return good, bad


@pytest.mark.parametrize("left, right", itertools.product([None, "u", "d"], repeat=2))
def test_deletes_count_per_registry(spark, left, right):
    mongo = [("m0", 1, "1.2-3", "c", 1)] + ([("m1", 1, "123", left, 2)] if left else [])
    mssql = [("s0", 1, "1-23", "c", 1)] + ([("s1", 1, "123", right, 2)] if right else [])
    good, bad = unify(spark, mongo, mssql)
    rows = good.collect()
    assert bad.count() == 0
    expected = {None: {"m": "m0", "s": "s0"}, "u": {"m": "m1", "s": "s1"}, "d": {"m": None, "s": None}}
    pair = (expected[left]["m"], expected[right]["s"])
    assert [(r.cpf, r.uuid_mongo, r.uuid_mssql) for r in rows] == ([] if pair == (None, None) else [("123", *pair)])


def test_all_rows_of_a_repeated_user_id_and_those_without_tax_id_are_quarantined(spark):
    mongo = [("m1", 7, "1", "c", 1), ("m2", 7, "2", "c", 1), ("m3", 8, "3", "c", 1), ("m4", 9, None, "d", 1), ("m5", None, "5", "c", 1)]
    mssql = [("s1", None, "6", "c", 1), ("s2", 7, "4", "c", 1), ("s3", 11, None, "c", 1)]
    good, bad = unify(spark, mongo, mssql)
    assert sorted(r.cpf for r in good.collect()) == ["3", "5", "6"]
    assert sorted((r._quarantine_reason, r.cpf or "", r.user_id) for r in bad.collect()) == [
        ("duplicate_user_id", "1", 7), ("duplicate_user_id", "2", 7), ("duplicate_user_id", "4", 7),
        ("missing_cpf", "", 9), ("missing_cpf", "", 11),
    ]
    assert bad.columns[:-2] == good.columns[:-1]


def test_values_prefer_the_first_registry_column_by_column(spark):
    good, _ = unify(spark, [("m", None, "1", "c", 1)], [("s", 5, "1", "c", 1)])
    row = good.first()
    assert (row.user_id, row.uuid_mongo, row.uuid_mssql) == (5, "m", "s")


@pytest.mark.parametrize("heavy_rows", [2, 100_000])
def test_a_user_id_shared_by_a_third_of_all_users(spark, heavy_rows):
    rows = [(f"m{i}", 0 if i % 3 == 0 else None if i % 3 == 1 else i, str(i), "c", 1) for i in range(300)]
    fused = conform(spark.createDataFrame(rows, "uuid string, user_id int, cpf string, __op string, __source_ts_ms bigint"), contract("users_mongo"))
    from tidemark.plans.users import fused_users

    empty = conform(fused.limit(0), contract("users_mssql"))
    stamped = [bronze(fused, contract("users_mongo"), AS_OF), bronze(empty, contract("users_mssql"), AS_OF)]
    tagged = tag_users(fused_users(*stamped), heavy_rows).collect()
    assert len(tagged) == 300
    assert all((r._quarantine_reason == "duplicate_user_id") == (r.user_id == 0) for r in tagged)
