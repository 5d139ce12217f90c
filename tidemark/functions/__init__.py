from tidemark.functions.rules import all_pass, any_fails, rule_fails, rule_passes, rule_sql
from tidemark.functions.scalars import (
    digits_only,
    driver_key,
    event_name,
    op_rank,
    plain_id,
    row_hash,
    seconds_between,
    strip_wire_header,
    to_instant,
    to_whole,
)

__all__ = [
    "all_pass",
    "any_fails",
    "digits_only",
    "driver_key",
    "event_name",
    "op_rank",
    "plain_id",
    "row_hash",
    "rule_fails",
    "rule_passes",
    "rule_sql",
    "seconds_between",
    "strip_wire_header",
    "to_instant",
    "to_whole",
]
