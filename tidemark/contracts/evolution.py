"""Compare an incoming schema with the contract's evolution policy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.contracts.model import SPARK_TYPES, Contract, ContractError


def schema_changes(contract: Contract, incoming: T.StructType) -> list[tuple[str, str, str]]:
    """``(field, change, detail)`` for every difference, in contract order and then new fields."""
    arriving = {f.name: f.dataType for f in incoming}
    declared = {f.name: SPARK_TYPES[f.type] for f in contract.payload_fields}
    changes = []
    for name, expected in declared.items():
        if name not in arriving:
            changes.append((name, "removed_fields", expected.simpleString()))
        elif arriving[name] != expected:
            changes.append((name, "type_changes", f"{expected.simpleString()} -> {arriving[name].simpleString()}"))
    known = set(contract.field_names)
    changes += [(n, "new_fields", t.simpleString()) for n, t in arriving.items() if n not in known]
    return changes


def check_evolution(contract: Contract, incoming: T.StructType) -> list[tuple[str, str, str]]:
    """Raise on a change the policy forbids; return the allowed ones."""
    changes = schema_changes(contract, incoming)
    forbidden = [c for c in changes if getattr(contract.evolution, c[1]) == "forbidden"]
    if forbidden:
        text = "; ".join(f"{kind}: {name} ({detail})" for name, kind, detail in forbidden)
        raise ContractError(f"{contract.name}: schema evolution forbidden: {text}")
    return changes


def evolve(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract columns in order, then the new columns the policy lets through."""
    new = [name for name, kind, _ in check_evolution(contract, df.schema) if kind == "new_fields"]
    declared = [n for n in contract.field_names if n in df.columns]
    return df.select(*declared, *new)
