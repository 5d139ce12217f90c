"""Bring an incoming frame to the types its contract declares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts.model import SPARK_TYPES, Contract, Field
from tidemark.functions.scalars import to_instant, to_whole


def _cast(field: Field, source: T.DataType) -> Column:
    col = F.col(f"`{field.name}`")
    target = SPARK_TYPES[field.type]
    if field.type == "timestamp":
        return to_instant(col, source)
    if source == target:
        return col
    if field.type in ("integer", "long"):
        return col.try_cast(target) if isinstance(source, T.IntegralType) else to_whole(col, target.simpleString())
    if field.type == "string":
        if isinstance(source, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            return F.to_json(col)
        if isinstance(source, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return col.cast(target)
    if field.type == "date" and isinstance(source, T.IntegralType):
        # Connectors deliver dates as days since the epoch.
        return F.date_add(F.lit("1970-01-01").cast("date"), col.cast("int"))
    return col.try_cast(target)


def _conformed(df: DataFrame, contract: Contract) -> list[tuple[Field, Column]]:
    arriving = {f.name: f.dataType for f in df.schema}
    return [
        (f, _cast(f, arriving[f.name]) if f.name in arriving else F.lit(None).cast(SPARK_TYPES[f.type]))
        for f in contract.payload_fields
    ]


def conformed_columns(df: DataFrame, contract: Contract) -> list[Column]:
    """One typed column per payload field, in contract order."""
    return [c.alias(f.name) for f, c in _conformed(df, contract)]


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract columns in contract order: cast, null where absent, unknown columns dropped.

    A value that cannot be cast becomes null, which the quality rules then see;
    :func:`conformity_errors` names it. The arrival stamp is the one column not touched.
    """
    return df.select(*conformed_columns(df, contract))


def conform_with_new(df: DataFrame, contract: Contract, new: Sequence[str]) -> DataFrame:
    """Contract columns in contract order, then columns it does not know, as text: JSON where they are nested."""
    arriving = {f.name: f.dataType for f in df.schema}
    text = [_cast(Field(name, "string"), arriving[name]).alias(name) for name in new]
    return df.select(*conformed_columns(df, contract), *text)


def conformity_errors(df: DataFrame, contract: Contract, errors: str = "_errors") -> DataFrame:
    """``df`` with a list of what keeps each row from the contract.

    ``missing:<field>`` for a required value that is absent, ``not <type>:<field>`` for a value
    that cannot be cast. Columns starting with an underscore are the pipeline's own and not judged.
    """
    problems = []
    for field, cast in _conformed(df, contract):
        if field.name.startswith("_"):
            continue
        given = F.col(f"`{field.name}`").isNotNull() if field.name in df.columns else F.lit(False)
        if not field.nullable:
            problems.append(F.when(~given, F.lit(f"missing:{field.name}")))
        problems.append(F.when(given & cast.isNull(), F.lit(f"not {field.type}:{field.name}")))
    return df.withColumn(errors, F.array_compact(F.array(*problems)))
