"""Native streaming aggregates: daily activity and running prediction counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from churnloom.operators import reports


def daily_activity(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Events and value per user and UTC day of a stream with a timestamp ``ts``."""
    return (
        events.withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 day").alias("w"), "user_id")
        .agg(F.count(F.lit(1)).alias("event_count"), F.sum("value").alias("value_sum"))
        .select(F.col("w.start").alias("day_start"), "user_id", "event_count", "value_sum")
    )


def keep_updates(aggregate: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each batch's changed groups to its own folder.

    Update mode also delivers the newest windows, which append mode holds back
    until a later event arrives.
    """

    def write(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        aggregate.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def newest_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last written row per group."""
    rows = spark.read.parquet(path)
    others = [c for c in rows.columns if c not in (*keys, "batch")]
    newest = F.max(F.struct("batch", *others)).alias("row")
    return rows.groupBy(*keys).agg(newest).select(*keys, *[f"row.{c}" for c in others])


def prediction_counters(scores: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Totals since the start of a score stream; one row, replaced per batch."""

    def write(totals: DataFrame, batch_id: int) -> None:
        totals.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        reports.prediction_stats(scores)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def current_counters(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows.orderBy(F.desc("batch")).limit(1).drop("batch")
