from tidemark.streaming.buckets import KeyedState, ValueIndex, totals_of_changes
from tidemark.streaming.flows import (
    append_stream,
    bronze_stream,
    read_bronze,
    read_route,
    read_sketches,
    route_stream,
    rule_metrics,
    scd1_stream,
    settle_bronze,
    silver_stream,
    sketch_stream,
)

__all__ = [
    "KeyedState",
    "ValueIndex",
    "append_stream",
    "bronze_stream",
    "read_bronze",
    "read_route",
    "read_sketches",
    "route_stream",
    "rule_metrics",
    "scd1_stream",
    "settle_bronze",
    "silver_stream",
    "sketch_stream",
    "totals_of_changes",
]
