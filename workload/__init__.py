"""The checked queries: every operator run over the test tables, next to the SQL it must equal."""

from workload import layers, operators, streams  # noqa: F401 - they register their queries
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
