"""Batch jobs: raw files to clean tables to the gold feature table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from churnloom.operators import cleaning, features
from churnloom.sources import tables

# Raw files per table; later versions come after earlier ones.
RAW_FILES = {
    "members": ["members_v3.csv"],
    "transactions": ["transactions.csv", "transactions_v2.csv"],
    "train": ["train.csv", "train_v2.csv"],
    "user_logs": ["user_logs.csv", "user_logs_v2.csv"],
}

CLEANERS = {
    "members": cleaning.silver_members,
    "transactions": cleaning.silver_transactions,
    "train": cleaning.silver_train,
    "user_logs": cleaning.silver_user_logs,
}


def bronze_to_silver(spark: SparkSession, bronze: str, silver: str) -> None:
    for name, files in RAW_FILES.items():
        versions = [tables.read_bronze(spark, f"{bronze}/{f}", name) for f in files]
        cleaned = CLEANERS[name](*versions)
        target = f"{silver}/{name}"
        if name == "user_logs":
            tables.write_by_day(cleaned, target, "date")
        else:
            tables.write_table(cleaned, target)


def silver_to_gold(
    spark: SparkSession, silver: str, gold: str, as_of: date | None = None
) -> DataFrame:
    parts = {n: tables.read_table(spark, f"{silver}/{n}") for n in RAW_FILES}
    built = features.gold_features(
        parts["train"], parts["members"], parts["transactions"], parts["user_logs"], as_of
    )
    tables.write_table(built, gold)
    return tables.read_table(spark, gold)
