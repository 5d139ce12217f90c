"""``silver.users``: one user per tax id from two registries, with its own quarantine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts.model import INGESTED_AT, OP, SEQUENCE
from tidemark.functions.scalars import plain_id
from tidemark.operators.fuse import fuse, quarantine_shape
from tidemark.operators.keyed import change_order, latest_per_key
from tidemark.operators.skew import HEAVY_ROWS, balanced_left_join
from tidemark.plans.medallion import stamp

# The columns of a fused user.
SHAPE = T.StructType(
    [
        T.StructField("cpf", T.StringType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("uuid_mongo", T.StringType()),
        T.StructField("uuid_mssql", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("phone_number", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("delivery_address", T.StringType()),
        T.StructField("birthday", T.DateType()),
        T.StructField("job", T.StringType()),
        T.StructField("company_name", T.StringType()),
        T.StructField(INGESTED_AT, T.TimestampType()),
    ]
)
SHARED = ("user_id", "phone_number", "country", INGESTED_AT)
MONGO_ONLY = {"uuid": "uuid_mongo", "email": "email", "city": "city", "delivery_address": "delivery_address"}
MSSQL_ONLY = {
    "uuid": "uuid_mssql",
    "first_name": "first_name",
    "last_name": "last_name",
    "birthday": "birthday",
    "job": "job",
    "company_name": "company_name",
}
MISSING_CPF = "missing_cpf"
DUPLICATE_USER_ID = "duplicate_user_id"


def prepare_users(source: DataFrame) -> DataFrame:
    """A registry's change records with the tax id in its plain spelling."""
    return source.withColumn("cpf", plain_id(F.col("cpf")))


def _current(source: DataFrame, tie_break=None) -> DataFrame:
    known = source.filter(F.col("cpf").isNotNull())
    return latest_per_key(known, ["cpf"], change_order(known, SEQUENCE, tie_break), f"{OP} = 'd'")


def fused_users(mongo: DataFrame, mssql: DataFrame, tie_break=None) -> DataFrame:
    """Current state of each registry, full outer joined on the tax id.

    Deletes count per registry: a person deleted in one lives on with the other's half. Each
    side is already partitioned by the tax id from its aggregation and the join reuses that.
    """
    left, right = _current(mongo, tie_break), _current(mssql, tie_break)
    return fuse(left, right, "cpf", SHARED, MONGO_ONLY, MSSQL_ONLY).select(*SHAPE.names)


def tag_users(fused: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Every fused user with a reason for quarantine, null for none.

    All rows of a repeated user id are tagged: which of them is right cannot be told. Users
    without a user id repeat nothing.
    """
    counts = (
        fused.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_quarantine_reason", F.lit(DUPLICATE_USER_ID))
    )
    return balanced_left_join(
        fused, counts, "user_id", "_quarantine_reason", F.col("_n") > 1, ["cpf"], heavy_rows
    )


def missing_users(mongo: DataFrame, mssql: DataFrame) -> DataFrame:
    """The records without a tax id, which belong to nobody, in the shape of a fused user."""
    from_mongo = {"cpf": "cpf", **{c: c for c in SHARED}, **{name: c for c, name in MONGO_ONLY.items()}}
    from_mssql = {"cpf": "cpf", **{c: c for c in SHARED}, **{name: c for c, name in MSSQL_ONLY.items()}}
    lost = F.col("cpf").isNull()
    return quarantine_shape(mongo.filter(lost), SHAPE, from_mongo, MISSING_CPF).unionByName(
        quarantine_shape(mssql.filter(lost), SHAPE, from_mssql, MISSING_CPF)
    )


def candidates(
    mongo: DataFrame, mssql: DataFrame, tie_break=None, keep: Callable[[DataFrame], DataFrame] = lambda fused: fused
) -> DataFrame:
    """Fused users and the records without a tax id, each with its quarantine reason.

    Tagging reads the fused users more than once. ``keep`` can put them down in a table first, so
    that the join of the registries runs only once.
    """
    mongo, mssql = prepare_users(mongo), prepare_users(mssql)
    tagged = tag_users(keep(fused_users(mongo, mssql, tie_break)))
    return tagged.unionByName(missing_users(mongo, mssql))


def split_users(tagged: DataFrame, as_of=None) -> tuple[DataFrame, DataFrame]:
    """``(users, quarantined)`` of the candidates."""
    reason = F.col("_quarantine_reason")
    good = tagged.filter(reason.isNull()).drop("_quarantine_reason")
    return stamp(good, "_merged_at", as_of), stamp(tagged.filter(reason.isNotNull()), "_quarantine_ts", as_of)


def unify_users(
    mongo: DataFrame, mssql: DataFrame, as_of=None, tie_break=None, keep: Callable[[DataFrame], DataFrame] = lambda df: df
) -> tuple[DataFrame, DataFrame]:
    """``(users, quarantined)`` of two registries' bronze records."""
    return split_users(candidates(mongo, mssql, tie_break, keep), as_of)
