"""Churn tables derived from the test tables.

The driver tables are a shop and an event stream. Customers stand in for
members, orders for payments, events for daily listening and for serving
requests, labels for churn labels. Every view reads its whole table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnloom import fixed
from churnloom.functions import scalars as S

STREAM_START = date(2024, 1, 16)
BASELINE_END = date(2024, 1, 15)


class Adapter:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # --- raw tables --------------------------------------------------------
    def members_raw(self) -> DataFrame:
        """Every tenth member twice, as an exact copy."""
        key = F.col("c_custkey")
        day = F.date_add(F.lit(date(2015, 6, 1)), (key % 730).cast("int"))
        gender = F.when(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"), "male").when(
            F.col("c_mktsegment") == "FURNITURE", "female"
        )
        copies = F.when(key % 10 == 0, 2).otherwise(1)
        return (
            self.table("customer")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
            .select(
                key.cast("string").alias("msno"),
                F.col("c_nationkey").alias("city"),
                F.floor(F.col("c_acctbal") / 100).cast("int").alias("bd"),
                gender.alias("gender"),
                ((key % 5).cast("int") + 3).alias("registered_via"),
                _int_day(day).alias("registration_init_time"),
            )
        )

    def transactions_raw(self, version: int) -> DataFrame:
        """Two files; orders whose key ends in 7 are in both."""
        digit = F.col("o_orderkey") % 10
        day = F.to_date("o_orderdate")
        return (
            self.table("orders")
            .where(digit <= 7 if version == 1 else digit >= 7)
            .select(
                F.col("o_custkey").cast("string").alias("msno"),
                _int_day(day).alias("transaction_date"),
                _int_day(F.date_add(day, 30)).alias("membership_expire_date"),
                F.col("o_totalprice").alias("actual_amount_paid"),
                F.col("o_totalprice").alias("plan_list_price"),
                (F.col("o_orderstatus") == "F").cast("int").alias("is_auto_renew"),
                (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("is_cancel"),
            )
        )

    def user_logs_raw(self) -> DataFrame:
        """One row per user and day."""

        def times(kind: str) -> Column:
            return F.count_if(F.col("event_type") == kind).cast("int")

        return (
            self.table("events")
            .groupBy(
                F.col("user_id").cast("string").alias("msno"), _int_day(F.to_date("ts")).alias("date")
            )
            .agg(
                times("view").alias("num_25"),
                times("click").alias("num_50"),
                times("signup").alias("num_75"),
                times("error").alias("num_985"),
                times("purchase").alias("num_100"),
                F.count_distinct("event_type").cast("int").alias("num_unq"),
                F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total_secs"),
            )
        )

    def train_raw(self, version: int) -> DataFrame:
        """Two files; ids divisible by 20 are in both with opposite labels."""
        doc = F.col("doc_id")
        churn = 1 - F.col("quality")
        if version == 1:
            rows = self.table("labels").where(doc % 2 == 0)
        else:
            rows = self.table("labels").where((doc % 2 == 1) | (doc % 20 == 0))
            churn = F.when(doc % 20 == 0, F.col("quality")).otherwise(churn)
        return rows.select(doc.cast("string").alias("msno"), churn.alias("is_churn"))

    # --- stream records ----------------------------------------------------
    def stream_logs(self) -> DataFrame:
        logs = self.user_logs_raw()
        return logs.withColumn("date", S.day_from_int("date")).where(
            F.col("date") >= F.lit(STREAM_START)
        )

    def stream_transactions(self) -> DataFrame:
        day = F.to_date("ts")
        event = F.col("event_id")
        return (
            self.table("events")
            .where((F.col("event_type") == "purchase") & (day >= F.lit(STREAM_START)))
            .select(
                F.col("user_id").cast("string").alias("msno"),
                day.alias("transaction_date"),
                F.col("value").alias("actual_amount_paid"),
                (event % 3 == 0).cast("int").alias("is_auto_renew"),
                (event % 7 == 0).cast("int").alias("is_cancel"),
            )
        )

    # --- serving logs ------------------------------------------------------
    def request_log(self) -> DataFrame:
        single = F.col("event_type").isin("view", "click")
        event = F.col("event_id")
        return self.table("events").select(
            event.alias("request_id"),
            "ts",
            F.lit("POST").alias("method"),
            F.when(single, "/predict/").otherwise("/predict/batch").alias("path"),
            F.when(F.col("event_type") == "error", "500").otherwise("200").alias("status_code"),
            (F.col("value") / 1000).alias("duration_seconds"),
            F.when(single, 1).otherwise(1 + event % 50).cast("int").alias("batch_size"),
        )

    def score_log(self) -> DataFrame:
        event = F.col("event_id")
        p = (event * 7919 % 1000) / 999.0
        return self.table("events").select(
            event.alias("prediction_id"),
            "ts",
            F.col("user_id").cast("string").alias("msno"),
            F.when(F.col("event_type").isin("view", "click"), "/predict/")
            .otherwise("/predict/batch")
            .alias("endpoint"),
            p.alias("churn_probability"),
            S.churn_flag(p).alias("is_churn"),
            F.when(F.col("event_type") == "error", "error").otherwise("success").alias("fetch_status"),
            (F.col("value") / 1000).alias("fetch_seconds"),
        )

    def labelled_scores(self) -> DataFrame:
        """Deterministic scores with many ties and some signal."""
        y = (F.col("o_orderstatus") == "F").cast("int")
        p = (F.col("o_orderkey") * 37 % 1000 + 150 * y) / 1150.0
        return self.table("orders").select(y.alias("is_churn"), p.alias("score"))

    def contributions(self) -> DataFrame:
        """Per user an array of (feature, value), shaped like the explanations."""
        key = F.col("c_custkey")
        items = [
            F.struct(
                F.lit(name).alias("feature"),
                ((key * (i + 3) * 31 + i * i * 17) % 201 / 250.0 - 0.4).alias("value"),
            )
            for i, name in enumerate(fixed.FEATURES)
        ]
        return self.table("customer").select(
            key.cast("string").alias("msno"),
            (key % 3 == 0).cast("int").alias("is_churn"),
            F.array(*items).alias("contributions"),
        )


def _int_day(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
