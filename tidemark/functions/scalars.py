"""Column expressions shared by the operators. All of them run inside the JVM."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: drivers are numbered from 1 to this.
DRIVERS = 354
# Fixed value: a registry record starts with a magic byte and a four-byte schema id.
WIRE_HEADER_BYTES = 5
# Digits that always fit a long; longer keys take the digit-by-digit branch.
LONG_SAFE_DIGITS = 18


def instant(as_of: datetime | str | None = None) -> Column:
    """The moment rules and audit columns refer to: the given one, or the query's clock."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def plain_id(col: Column) -> Column:
    """A tax id without its dots and dashes, so that both spellings are one key."""
    return F.regexp_replace(col, r"[.\-]", "")


def digits_only(col: Column) -> Column:
    return F.regexp_replace(col, "[^0-9]", "")


def driver_key(col: Column, drivers: int = DRIVERS) -> Column:
    """Map a free-form driver key to the text of a driver number in ``1..drivers``.

    Null and empty keys have no driver; a key without digits counts as zero. The remainder is
    taken digit by digit when the number would not fit a long, so any length is exact.
    """
    digits = digits_only(col)
    remainder = F.when(
        F.length(digits) <= LONG_SAFE_DIGITS,
        F.coalesce(digits.try_cast("bigint"), F.lit(0))
        % F.lit(drivers),
    ).otherwise(
        F.aggregate(
            F.split(digits, ""),
            F.lit(0).cast("bigint"),
            lambda acc, d: (acc * 10 + F.coalesce(d.try_cast("bigint"), F.lit(0))) % F.lit(drivers),
        )
    )
    return F.when(col.isNotNull() & (col != ""), (remainder + 1).cast("string"))


def event_name(col: Column) -> Column:
    """The ``event_name`` of a JSON event, or the text itself when it is not such an object."""
    return F.coalesce(F.get_json_object(col, "$.event_name"), col)


def seconds_between(earlier: Column, later: Column) -> Column:
    """Whole seconds from one moment to another, as a double; each side drops its fraction."""
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)).cast("double")


def op_rank(op: Column) -> Column:
    """Order of operations sharing one sequence value: snapshot, create, update, delete."""
    known = F.when(op == "r", 0).when(op == "c", 1).when(op == "d", 3)
    return known.otherwise(2)


def row_hash(columns: list[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def strip_wire_header(value: Column) -> Column:
    """The message body behind the registry header."""
    return F.substring(value, WIRE_HEADER_BYTES + 1, 2147483647)


def to_instant(col: Column, source: T.DataType) -> Column:
    """A timestamp from ISO text, epoch milliseconds (number or its text), or any time type."""
    if isinstance(source, T.StringType):
        millis = F.timestamp_millis(col.try_cast("bigint"))
        return F.when(col.rlike(r"^-?[0-9]{10,}$"), millis).otherwise(col.try_cast("timestamp"))
    if isinstance(source, T.IntegralType):
        return F.timestamp_millis(col.cast("bigint"))
    return col.cast("timestamp")


def to_whole(col: Column, target: str) -> Column:
    """A whole number, halves rounded away from zero; null when it is none or does not fit."""
    return F.round(col.try_cast(T.DecimalType(38, 6)), 0).try_cast(target)
