from tidemark.operators.conform import conform, conformity_errors
from tidemark.operators.envelope import flatten_envelope, skip_tombstones, snapshot_plus_changes
from tidemark.operators.fuse import fuse, quarantine_shape
from tidemark.operators.keyed import change_feed, latest_per_key, one_row_per_key, scd1, snapshot_diff, upsert
from tidemark.operators.quality import (
    apply_reject,
    observe_warnings,
    quarantine_condition,
    reject_conditions,
    rule_counts,
    split_quarantine,
    warn_conditions,
)
from tidemark.operators.sketches import distinct_sketches, united
from tidemark.operators.uniqueness import clashing_values, flag_clashing, unique_against_target

__all__ = [
    "apply_reject",
    "change_feed",
    "clashing_values",
    "conform",
    "conformity_errors",
    "distinct_sketches",
    "flag_clashing",
    "flatten_envelope",
    "fuse",
    "latest_per_key",
    "observe_warnings",
    "one_row_per_key",
    "quarantine_condition",
    "quarantine_shape",
    "reject_conditions",
    "rule_counts",
    "scd1",
    "skip_tombstones",
    "snapshot_diff",
    "snapshot_plus_changes",
    "split_quarantine",
    "unique_against_target",
    "united",
    "upsert",
    "warn_conditions",
]
