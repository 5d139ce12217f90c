from tidemark.contracts.ddl import cluster_by_clause, create_table_ddl, table_properties
from tidemark.contracts.domains import CONTRACTS, contract
from tidemark.contracts.evolution import check_evolution, evolve, schema_changes
from tidemark.contracts.model import Contract, Evolution, Field, Rule, load_contract

__all__ = [
    "CONTRACTS",
    "Contract",
    "Evolution",
    "Field",
    "Rule",
    "check_evolution",
    "cluster_by_clause",
    "contract",
    "create_table_ddl",
    "evolve",
    "load_contract",
    "schema_changes",
    "table_properties",
]
