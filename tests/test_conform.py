from datetime import date, datetime

import pytest

from tidemark.contracts import contract, load_contract
from tidemark.operators import conform, conformity_errors


def made(**types):
    return load_contract(
        {
            "table": {"name": "t", "layers": ["bronze"], "merge_key": "id"},
            "schema": [{"name": "id", "type": "string", "nullable": False}]
            + [{"name": n, "type": t, "nullable": True} for n, t in types.items()]
            + [{"name": "_ingested_at", "type": "timestamp", "nullable": False}],
            "quality": {"rules": []},
            "storage": {"cluster_by": ["id"]},
            "schema_evolution": {},
        }
    )


def test_times_arrive_as_text_millis_or_wall_clock(spark):
    df = spark.sql(
        """SELECT '1' AS id, '2024-01-02 03:04:05.6' AS a, 1704164645600L AS b, TIMESTAMP_NTZ'2024-01-02 03:04:05.6' AS c,
        '2024-01-02T05:04:05.6+02:00' AS d, '1704164645600' AS e, 'soon' AS f, DATE'2024-01-02' AS g"""
    )
    row = conform(df, made(**{n: "timestamp" for n in "abcdefg"})).first()
    moment = datetime(2024, 1, 2, 3, 4, 5, 600000)
    assert (row.a, row.b, row.c, row.d, row.e) == (moment,) * 5
    assert row.f is None and row.g == datetime(2024, 1, 2)


@pytest.mark.parametrize("text, whole", [("171.48", 171), ("171.5", 172), ("-2.5", -3), ("7", 7), ("x", None), ("99999999999", None)])
def test_whole_numbers_round_halves_away_from_zero(spark, text, whole):
    assert conform(spark.createDataFrame([("1", text)], "id string, n string"), made(n="integer")).first().n == whole


def test_unknown_columns_go_and_absent_ones_are_null(spark):
    df = spark.sql("SELECT '1' AS id, 5 AS driver_id, true AS __deleted, 2.5D AS x, 19723 AS d")
    got = conform(df, made(driver_id="string", x="integer", y="double", d="date"))
    assert got.columns == ["id", "driver_id", "x", "y", "d"]
    assert tuple(got.first()) == ("1", "5", 3, None, date(2024, 1, 1))


def test_nested_values_and_times_of_day_become_text(spark):
    df = spark.sql("SELECT '1' AS id, named_struct('a', 1) AS s, TIMESTAMP_NTZ'2024-01-02 03:04:05' AS t")
    assert tuple(conform(df, made(s="string", t="string")).first()) == ("1", '{"a":1}', "2024-01-02T03:04:05.000000")


def test_errors_name_what_is_missing_or_of_another_type(spark):
    df = spark.createDataFrame([(None, "x", "y"), ("1", "2", "z"), ("1", None, "1")], "id string, n string, __op string")
    got = [r._errors for r in conformity_errors(df, made(n="integer", __op="long")).collect()]
    assert got == [["missing:id", "not integer:n"], [], []]


def test_an_absent_required_column_is_missing_in_every_row(spark):
    df = spark.createDataFrame([("1",)], "order_id string")
    assert conformity_errors(df, contract("orders")).first()._errors == ["missing:user_key", "missing:restaurant_key"]
