"""Raw tables to clean tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnloom.functions import scalars as S


def union_versions(*versions: DataFrame) -> DataFrame:
    """All rows of all file versions, matched by column name; a column that only some
    versions have is null in the others."""
    first, *rest = versions
    for version in rest:
        first = first.unionByName(version, allowMissingColumns=True)
    return first


def one_row_per_user(raw: DataFrame) -> DataFrame:
    """Smallest row per user in column order.

    Which copy survives must not depend on the run; an aggregate (not a window)
    combines the copies of a heavily repeated user before the shuffle.
    """
    others = [c for c in raw.columns if c != "msno"]
    return raw.groupBy("msno").agg(F.min(F.struct(*others)).alias("row")).select("msno", "row.*")


def clean_members(members: DataFrame) -> DataFrame:
    return members.withColumns(
        {
            "bd": S.valid_age("bd"),
            "registration_init_time": S.day_from_int("registration_init_time"),
        }
    )


def silver_members(raw: DataFrame) -> DataFrame:
    return clean_members(one_row_per_user(raw))


def silver_transactions(*versions: DataFrame) -> DataFrame:
    """Dates parsed, exact copies over all columns removed."""
    days = {c: S.day_from_int(c) for c in ("transaction_date", "membership_expire_date")}
    return union_versions(*versions).withColumns(days).distinct()


def silver_user_logs(*versions: DataFrame) -> DataFrame:
    return union_versions(*versions).withColumn("date", S.day_from_int("date")).distinct()


def silver_train(*versions: DataFrame) -> DataFrame:
    """One label per user; a later file version wins over an earlier one."""
    ranked = union_versions(*[v.withColumn("version", F.lit(i)) for i, v in enumerate(versions)])
    newest = F.max(F.struct("version", "is_churn"))["is_churn"]
    return ranked.groupBy("msno").agg(newest.alias("is_churn"))
