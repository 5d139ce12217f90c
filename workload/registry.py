"""Registration of checked queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def comparable(df: DataFrame) -> DataFrame:
    """Instants as wall-clock time in UTC, the form SQL engines without a session zone return."""
    casts = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in casts})


def register(name: str, run: Query, sql: str | None = None) -> None:
    """Add a query under ``name``, and the SQL with the same result unless there is none."""

    @wraps(run)
    def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return comparable(run(spark, sf_dir))

    if name in QUERIES:
        raise ValueError(f"query '{name}' is registered twice")
    QUERIES[name] = checked
    if sql is not None:
        ORACLES[name] = sql


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Decorator form of :func:`register`, under the function's own name unless one is given."""

    def add(run: Query) -> Query:
        register(name or run.__name__, run, sql)
        return run

    return add
