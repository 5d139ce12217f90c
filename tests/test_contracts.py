import copy
import json

import pytest
from pyspark.sql import types as T

from tidemark.contracts import (
    CONTRACTS,
    check_evolution,
    cluster_by_clause,
    contract,
    create_table_ddl,
    evolve,
    load_contract,
    schema_changes,
    table_properties,
)
from tidemark.contracts.model import CHECKS, ContractError

ALL = list(CONTRACTS.values())
names = pytest.mark.parametrize("c", ALL, ids=list(CONTRACTS))

DOC = {
    "table": {"name": "t", "layers": ["bronze", "silver"], "source": "kafka_t", "kafka_topic": "pg.t", "merge_key": "id"},
    "schema": [
        {"name": "id", "type": "string", "nullable": False},
        {"name": "n", "type": "integer", "nullable": True},
        {"name": "_ingested_at", "type": "timestamp", "nullable": False},
    ],
    "quality": {"rules": [{"field": "id", "check": "not_null", "on_failure": "reject", "scope": ["bronze"]}]},
    "storage": {"cluster_by": ["id"], "properties": {"a.b": True, "c": 3}},
    "schema_evolution": {"new_fields": "allowed", "removed_fields": "forbidden", "type_changes": "forbidden"},
}


def changed(path, value):
    doc = copy.deepcopy(DOC)
    *parents, last = path
    at = doc
    for p in parents:
        at = at[p]
    at[last] = value
    return doc


def test_there_are_twenty_contracts_and_twelve_reach_silver():
    assert len(ALL) == 20
    assert sum("silver" in c.layers for c in ALL) == 12
    assert sum(len(c.rules) for c in ALL) == 79


@names
def test_rules_refer_to_fields_and_known_checks(c):
    for r in c.rules:
        assert r.field in c.field_names and r.check in CHECKS
        assert r.check != "allowed_values" or r.values


@names
def test_merge_key_is_a_clustered_field(c):
    assert set(c.keys) <= set(c.cluster_by) <= set(c.field_names)


@names
def test_struct_type_keeps_order_types_and_nullability(c):
    assert [f.name for f in c.struct_type] == c.field_names
    assert not c.struct_type[c.keys[0]].nullable
    assert "_ingested_at" not in c.payload_type.names


@names
def test_properties_are_text_and_change_feed_follows_silver(c):
    properties = table_properties(c)
    assert all(isinstance(v, str) for v in properties.values())
    assert properties["delta.enableChangeDataFeed"] == str("silver" in c.layers).lower()


@names
def test_ddl_creates_the_table(spark, c):
    spark.sql(create_table_ddl(c, f"ddl_{c.name}"))
    try:
        assert spark.table(f"ddl_{c.name}").columns == c.field_names
    finally:
        spark.sql(f"DROP TABLE ddl_{c.name}")


def test_dimensions_joined_off_their_key_declare_uniqueness():
    assert [r.field for r in contract("drivers").rules if r.check == "unique"] == ["driver_id"]
    assert [r.field for r in contract("restaurants").rules if r.check == "unique"] == ["cnpj"]


def test_unknown_name():
    with pytest.raises(KeyError):
        contract("nothing")


def test_loads_mapping_json_and_yaml(tmp_path):
    loaded = load_contract(DOC)
    assert loaded.keys == ("id",) and loaded.topic == "pg.t" and loaded.source == "kafka_t"
    (tmp_path / "c.json").write_text(json.dumps(DOC))
    assert load_contract(tmp_path / "c.json") == loaded
    yaml = pytest.importorskip("yaml")
    (tmp_path / "c.yml").write_text(yaml.safe_dump(DOC))
    assert load_contract(tmp_path / "c.yml") == loaded
    with pytest.raises(FileNotFoundError):
        load_contract(tmp_path / "missing.yml")


def test_composite_key_and_default_scope():
    doc = changed(("table", "merge_key"), ["id", "n"])
    doc["storage"]["cluster_by"] = ["id", "n"]
    del doc["quality"]["rules"][0]["scope"]
    loaded = load_contract(doc)
    assert loaded.keys == ("id", "n") and loaded.rules[0].scope == ("bronze", "silver")


@pytest.mark.parametrize(
    "path, value, message",
    [
        (("schema", 1, "type"), "decimal", "unknown type"),
        (("schema", 1, "nullable"), "true", "nullable is"),
        (("schema", 1, "name"), "id", "declared twice"),
        (("schema", 1, "name"), 7, "has no name"),
        (("quality", "rules", 0, "field"), "x", "is no column"),
        (("quality", "rules", 0, "check"), "bogus", "invalid check"),
        (("quality", "rules", 0, "check"), "allowed_values", "allows nothing"),
        (("quality", "rules", 0, "scope"), "bronze", "is a list"),
        (("quality", "rules", 0, "scope"), ["gold"], "unknown layer"),
        (("quality", "rules", 0, "on_failure"), "explode", "unknown action"),
        (("storage", "cluster_by"), "id", "is a list"),
        (("storage", "cluster_by"), ["x"], "is no column"),
        (("storage", "cluster_by"), ["n"], "not by its key"),
    ],
)
def test_invalid_contracts_say_why(path, value, message):
    with pytest.raises(ContractError, match=message):
        load_contract(changed(path, value))


def test_missing_section():
    doc = copy.deepcopy(DOC)
    del doc["storage"]
    with pytest.raises(ContractError, match="are missing"):
        load_contract(doc)


def test_cluster_clause():
    assert cluster_by_clause(load_contract(DOC)) == "CLUSTER BY (id)"
    assert cluster_by_clause(load_contract(changed(("storage", "cluster_by"), []))) == ""


def test_evolution_policy(spark):
    c = load_contract(DOC)
    wide = spark.createDataFrame([("a", 1, "x")], "id string, n int, extra string")
    assert schema_changes(c, wide.schema) == [("extra", "new_fields", "string")]
    assert evolve(wide, c).columns == ["id", "n", "extra"]
    with pytest.raises(ContractError, match="removed_fields: n"):
        check_evolution(c, T.StructType().add("id", "string"))
    with pytest.raises(ContractError, match="type_changes: n"):
        check_evolution(c, T.StructType().add("id", "string").add("n", "string"))
    closed = load_contract(changed(("schema_evolution", "new_fields"), "forbidden"))
    with pytest.raises(ContractError, match="new_fields: extra"):
        evolve(wide, closed)
