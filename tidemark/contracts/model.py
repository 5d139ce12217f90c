"""The table contract: schema, merge key, quality rules, storage and evolution policy.

A contract is a plain immutable value on the driver. Operators take it as an argument and turn
it into Column expressions; nothing here touches data.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import types as T

# The column types, rule checks, rule actions and layers a contract may name.
SPARK_TYPES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}
CHECKS = ("not_null", "allowed_values", "not_future", "unique")
ACTIONS = ("reject", "warn", "quarantine")
LAYERS = ("bronze", "silver")
REQUIRED_SECTIONS = ("table", "schema", "quality", "storage", "schema_evolution")

# The reserved columns of a change record.
OP = "__op"
SEQUENCE = "__source_ts_ms"
INGESTED_AT = "_ingested_at"


class ContractError(ValueError):
    """The contract contradicts itself or uses something no operator understands."""


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = True


@dataclass(frozen=True)
class Rule:
    field: str
    check: str
    on_failure: str
    scope: tuple[str, ...]
    severity: str = "warning"
    values: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.field}_{self.check}"


@dataclass(frozen=True)
class Evolution:
    new_fields: str = "allowed"
    removed_fields: str = "forbidden"
    type_changes: str = "forbidden"


@dataclass(frozen=True)
class Contract:
    name: str
    layers: tuple[str, ...]
    source: str
    topic: str
    keys: tuple[str, ...]
    fields: tuple[Field, ...]
    rules: tuple[Rule, ...] = ()
    cluster_by: tuple[str, ...] = ()
    compression: str = "zstd"
    properties: Mapping[str, object] = field(default_factory=dict, hash=False)
    evolution: Evolution = Evolution()

    def __post_init__(self) -> None:
        _check_fields(self)
        _check_rules(self)
        _check_storage(self)

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def struct_type(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, SPARK_TYPES[f.type], f.nullable) for f in self.fields])

    @property
    def record_type(self) -> T.StructType:
        """The same columns as they are stored: rows that break a rule hold nulls anywhere."""
        return T.StructType([T.StructField(f.name, SPARK_TYPES[f.type]) for f in self.fields])

    @property
    def payload_fields(self) -> tuple[Field, ...]:
        """The fields a source delivers: everything but the arrival stamp set on ingest."""
        return tuple(f for f in self.fields if f.name != INGESTED_AT)

    @property
    def payload_type(self) -> T.StructType:
        """The stored columns a source delivers."""
        return T.StructType([T.StructField(f.name, SPARK_TYPES[f.type]) for f in self.payload_fields])

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise ContractError(f"{self.name}: no field '{name}'")

    def rules_for(self, scope: str, action: str | None = None) -> list[Rule]:
        return [r for r in self.rules if scope in r.scope and action in (None, r.on_failure)]


def _check_fields(c: Contract) -> None:
    seen = set()
    for f in c.fields:
        if not isinstance(f.name, str):
            raise ContractError(f"{c.name}: a column has no name, or one that is not text")
        if f.name in seen:
            raise ContractError(f"{c.name}: column '{f.name}' is declared twice")
        if f.type not in SPARK_TYPES:
            raise ContractError(f"{c.name}.{f.name}: unknown type '{f.type}', the types are {list(SPARK_TYPES)}")
        if not isinstance(f.nullable, bool):
            raise ContractError(f"{c.name}.{f.name}: nullable is true or false, not {f.nullable!r}")
        seen.add(f.name)


def _check_rules(c: Contract) -> None:
    names = set(c.field_names)
    for r in c.rules:
        where = f"{c.name}.{r.field}"
        if r.field not in names:
            raise ContractError(f"{c.name}: a rule is about '{r.field}', which is no column")
        if r.check not in CHECKS:
            raise ContractError(f"{where}: invalid check '{r.check}', the checks are {list(CHECKS)}")
        if r.on_failure not in ACTIONS:
            raise ContractError(f"{where}: unknown action '{r.on_failure}', the actions are {list(ACTIONS)}")
        if r.check == "allowed_values" and not r.values:
            raise ContractError(f"{where}: allowed_values allows nothing, list its values")
        for layer in r.scope:
            if layer not in LAYERS:
                raise ContractError(f"{where}: unknown layer '{layer}', the layers are {list(LAYERS)}")


def _check_storage(c: Contract) -> None:
    for col in (*c.cluster_by, *c.keys):
        if col not in c.field_names:
            raise ContractError(f"{c.name}: key or clustering column '{col}' is no column")
    for key in c.keys:
        if c.cluster_by and key not in c.cluster_by:
            raise ContractError(f"{c.name}: the table is clustered by {list(c.cluster_by)} and not by its key '{key}'")


def _as_list(value: object, what: str) -> list:
    if not isinstance(value, (list, tuple)):
        raise ContractError(f"{what} is a list, not a {type(value).__name__}")
    return list(value)


def _read_document(path: Path) -> Mapping:
    text = path.read_text(encoding="utf-8")
    if path.suffix == ".json":
        return json.loads(text)
    try:
        import yaml
    except ImportError as missing:
        raise ContractError(f"{path.name}: YAML contracts need PyYAML; JSON ones load without it") from missing
    return yaml.safe_load(text)


def load_contract(source: str | Path | Mapping) -> Contract:
    """Build a Contract from a YAML or JSON file, or from an already parsed mapping."""
    if isinstance(source, Mapping):
        doc, origin = source, "contract"
    else:
        doc, origin = _read_document(Path(source)), Path(source).name
    missing = [k for k in REQUIRED_SECTIONS if k not in doc]
    if missing:
        raise ContractError(f"{origin}: sections {missing} are missing")

    table, storage = doc["table"], doc["storage"]
    name = table["name"]
    layers = tuple(table.get("layers", LAYERS))
    key = table.get("merge_key") or []
    return Contract(
        name=name,
        layers=layers,
        source=table.get("source", name),
        topic=table.get("kafka_topic", name),
        keys=tuple([key] if isinstance(key, str) else key),
        fields=tuple(Field(f.get("name"), f.get("type"), f.get("nullable")) for f in doc["schema"]),
        rules=tuple(
            Rule(
                field=r.get("field"),
                check=r.get("check"),
                on_failure=r.get("on_failure", "warn"),
                # A rule without a scope holds in every layer its table has.
                scope=tuple(_as_list(r.get("scope", layers), f"{name}.{r.get('field')}: 'scope'")),
                severity=r.get("severity", "warning"),
                values=tuple(_as_list(r.get("values") or [], f"{name}.{r.get('field')}: 'values'")),
            )
            for r in doc["quality"].get("rules", [])
        ),
        cluster_by=tuple(_as_list(storage.get("cluster_by"), f"{name}: storage.cluster_by")),
        compression=storage.get("compression", "zstd"),
        properties=dict(storage.get("properties", {})),
        evolution=Evolution(**{k: doc["schema_evolution"].get(k, v) for k, v in vars(Evolution()).items()}),
    )


PLAIN_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*\Z")


def quoted(name: str) -> str:
    """The column name as SQL text, in backticks only where Spark needs them."""
    return name if PLAIN_IDENTIFIER.match(name) else "`" + name.replace("`", "``") + "`"
