"""Row-level quality: drop, count or quarantine rows by the rules of a contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.contracts.model import Contract, Rule
from tidemark.functions.rules import all_pass, any_fails, rule_fails, rule_sql


def reject_conditions(contract: Contract, scope: str, as_of=None) -> dict[str, str]:
    """Rule name -> SQL condition of the rules that drop rows in ``scope``."""
    return {r.name: rule_sql(r, as_of, contract) for r in contract.rules_for(scope, "reject")}


def warn_conditions(contract: Contract, scope: str, as_of=None) -> dict[str, str]:
    """Rule name -> SQL condition of the rules that only count rows in ``scope``."""
    return {r.name: rule_sql(r, as_of, contract) for r in contract.rules_for(scope, "warn")}


def _row_level(contract: Contract, scope: str) -> list[Rule]:
    return [r for r in contract.rules_for(scope, "quarantine") if r.check != "unique"]


def quarantine_condition(contract: Contract, scope: str, as_of=None) -> str | None:
    """SQL condition that is true for rows to quarantine; None when the contract has no such rule.

    It never looks at the operation: a delete whose before-image breaks a rule is quarantined
    like any other row.
    """
    rules = _row_level(contract, scope)
    return " OR ".join(f"NOT ({rule_sql(r, as_of, contract)})" for r in rules) or None


def apply_reject(df: DataFrame, contract: Contract, scope: str = "bronze", as_of=None) -> DataFrame:
    """Keep the rows that pass every reject rule."""
    return df.filter(all_pass(contract.rules_for(scope, "reject"), as_of, contract))


def split_quarantine(
    df: DataFrame, contract: Contract, scope: str = "silver", as_of=None
) -> tuple[DataFrame, DataFrame]:
    """``(clean, quarantined)``: two filters that complement each other, no join and no shuffle."""
    failed = any_fails(_row_level(contract, scope), as_of, contract)
    return df.filter(~failed), df.filter(failed)


def failure_counts(rules: Sequence[Rule], contract: Contract, as_of=None) -> list[Column]:
    """One count of failing rows per rule, named after the rule, behind the count of all rows."""
    failures = [F.count_if(rule_fails(r, as_of, contract)).alias(r.name) for r in rules]
    return [F.count(F.lit(1)).alias("rows"), *failures]


def observe_warnings(
    df: DataFrame, contract: Contract, scope: str, name: str | Observation, as_of=None
) -> DataFrame:
    """Keep all rows and count the failures of the warn rules while they pass by.

    The counts ride along with whatever job reads the frame, also per micro-batch on a stream.
    """
    return df.observe(name, *failure_counts(contract.rules_for(scope, "warn"), contract, as_of))


def rule_counts(
    df: DataFrame, contract: Contract, scope: str, action: str | None = None, as_of=None
) -> DataFrame:
    """``(table_name, rule, on_failure, passed, failed)``: all rules of a scope in a single pass."""
    rules = contract.rules_for(scope, action)
    if not rules:
        empty = "table_name string, rule string, on_failure string, passed bigint, failed bigint"
        return df.sparkSession.createDataFrame([], empty)
    totals = df.agg(*failure_counts(rules, contract, as_of))
    per_rule = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.on_failure).alias("on_failure"),
                (F.col("rows") - F.col(f"`{r.name}`")).alias("passed"),
                F.col(f"`{r.name}`").alias("failed"),
            )
            for r in rules
        ]
    )
    return totals.select(F.lit(contract.name).alias("table_name"), F.inline(per_rule))
