"""Quality rules as SQL conditions and Columns.

A condition is true when the row passes and is never null, so a predicate and its negation
split any table into two complementary parts.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.contracts.model import Contract, Rule, quoted


def _literal(value: object, column_type: str | None) -> str:
    text_column = column_type == "string" or (column_type is None and isinstance(value, str))
    if text_column or isinstance(value, str):
        text = "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
        return text if text_column or column_type is None else f"CAST({text} AS {column_type})"
    return str(value)


def _moment(as_of: datetime | str | None) -> str:
    return "current_timestamp()" if as_of is None else f"TIMESTAMP '{as_of}'"


def rule_sql(rule: Rule, as_of: datetime | str | None = None, contract: Contract | None = None) -> str:
    """Condition a row must meet to pass ``rule``.

    Null passes every check but ``not_null``. ``unique`` compares rows with each other, so it
    holds row by row; :mod:`tidemark.operators.uniqueness` checks it across rows.
    """
    name = quoted(rule.field)
    if rule.check == "not_null":
        return f"{name} IS NOT NULL"
    if rule.check == "allowed_values":
        column_type = contract.field(rule.field).type if contract else None
        return f"{name} IS NULL OR {name} IN ({', '.join(_literal(v, column_type) for v in rule.values)})"
    if rule.check == "not_future":
        return f"{name} IS NULL OR {name} <= {_moment(as_of)}"
    if rule.check == "unique":
        return "true"
    raise ValueError(f"no such check: {rule.check!r}")


def rule_passes(rule: Rule, as_of: datetime | str | None = None, contract: Contract | None = None) -> Column:
    return F.expr(rule_sql(rule, as_of, contract))


def rule_fails(rule: Rule, as_of: datetime | str | None = None, contract: Contract | None = None) -> Column:
    return ~rule_passes(rule, as_of, contract)


def all_pass(rules: Sequence[Rule], as_of=None, contract: Contract | None = None) -> Column:
    return F.expr(" AND ".join(f"({rule_sql(r, as_of, contract)})" for r in rules) or "true")


def any_fails(rules: Sequence[Rule], as_of=None, contract: Contract | None = None) -> Column:
    return F.expr(" OR ".join(f"NOT ({rule_sql(r, as_of, contract)})" for r in rules) or "false")
