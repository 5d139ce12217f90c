"""Session-catalog DDL for a contract."""

from __future__ import annotations

from tidemark.contracts.model import SPARK_TYPES, Contract, quoted


def table_properties(contract: Contract) -> dict[str, str]:
    """Table properties as text, the only form DDL accepts."""
    return {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in contract.properties.items()}


def cluster_by_clause(contract: Contract) -> str:
    """``CLUSTER BY (a, b)``, or nothing for an unclustered table."""
    return f"CLUSTER BY ({', '.join(map(quoted, contract.cluster_by))})" if contract.cluster_by else ""


def create_table_ddl(contract: Contract, table: str, using: str = "parquet") -> str:
    """``CREATE TABLE`` text; columns keep their declared nullability."""
    columns = ",\n".join(
        f"  {quoted(f.name)} {SPARK_TYPES[f.type].simpleString().upper()}{'' if f.nullable else ' NOT NULL'}"
        for f in contract.fields
    )
    properties = ", ".join(f"'{k}' = '{v}'" for k, v in table_properties(contract).items())
    clauses = [
        f"CREATE TABLE IF NOT EXISTS {table} (\n{columns}\n)",
        f"USING {using}",
        cluster_by_clause(contract),
        f"TBLPROPERTIES ({properties})" if properties else "",
    ]
    return "\n".join(c for c in clauses if c)
