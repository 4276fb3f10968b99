"""Day-ordered replay of history as topic messages."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnloom import fixed
from churnloom.schemas import MESSAGE
from churnloom.session import scratch
from churnloom.sources import messages as M
from churnloom.sources.tables import write_by_day


def replay_messages(
    logs: DataFrame, transactions: DataFrame, start: date = fixed.STREAM_START
) -> DataFrame:
    """(day, topic, key, value) of both tables from the start day on."""
    parts = [
        (M.since(logs, "date", start), "date", fixed.LOG_TOPIC),
        (M.since(transactions, "transaction_date", start), "transaction_date", fixed.TRANSACTION_TOPIC),
    ]
    encoded = [
        M.encode(rows, topic).select(_message_day(column), "topic", "key", "value")
        for rows, column, topic in parts
    ]
    return encoded[0].unionByName(encoded[1])


def _message_day(column: str):
    return F.to_date(F.get_json_object("value", f"$.{column}")).alias("day")


def replay(
    messages: DataFrame,
    publish: Callable[[DataFrame, date], None],
    marker_topics: Callable[[date], Sequence[str]] | None = None,
) -> list[date]:
    """Send one day after another in date order, each with its end markers.

    The messages are laid out by day first (one job over all days); each day is
    then read back by its partition and sent by all executors, together with its markers,
    which say how many records of the day belong to each topic. Days with transactions
    only take their place in the order.
    """
    spark = messages.sparkSession
    laid_out = scratch(spark, "replay")
    write_by_day(messages, laid_out, "day")
    staged = spark.read.parquet(laid_out)
    # One row for each calendar day and topic.
    counts = staged.groupBy("day", "topic").agg(F.count(F.lit(1)).alias("records")).collect()
    days = sorted({r.day for r in counts})
    for day in days:
        topics = marker_topics(day) if marker_topics else None
        sent = spark.createDataFrame(
            [(r.day, r.topic, r.records) for r in counts if r.day == day], "day date, topic string, records bigint"
        )
        ends = M.markers(spark.range(1).select(F.lit(day).alias("day")), topics, F.broadcast(sent))
        of_day = spark.read.schema(MESSAGE).parquet(f"{laid_out}/day={day.isoformat()}")
        publish(of_day.unionByName(ends), day)
    return days


def to_files(path: str) -> Callable[[DataFrame, date], None]:
    """Publisher that appends message files, for the file source."""

    def publish(messages: DataFrame, day: date) -> None:
        messages.write.mode("append").json(path)

    return publish


def to_kafka(servers: str) -> Callable[[DataFrame, date], None]:
    def publish(messages: DataFrame, day: date) -> None:
        M.publish_to_kafka(messages, servers)

    return publish


def dry_run(messages: DataFrame, day: date) -> None:
    """Publisher that computes every message and sends none."""
    messages.write.format("noop").mode("overwrite").save()


def sent_counts(spark: SparkSession, path: str) -> DataFrame:
    """Messages per topic and day in a message folder, markers apart."""
    decoded = M.decode(spark.read.schema(M.schemas.MESSAGE).json(path))
    day = F.when(M.is_marker(), F.to_date("date")).otherwise(M.record_day())
    return decoded.groupBy("topic", day.alias("day")).agg(
        F.count_if(~M.is_marker()).alias("records"), F.count_if(M.is_marker()).alias("markers")
    )
