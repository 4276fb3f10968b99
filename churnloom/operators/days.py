"""Day bookkeeping of the stream: which days are ready, open, late or done."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ready_days(control: DataFrame) -> DataFrame:
    """Days whose end was announced on both topics, however often."""
    seen = control.groupBy("day").agg(F.count_distinct("topic").alias("topics"))
    return seen.where("topics = 2").select("day")


def counted_days(control: DataFrame, staged: DataFrame) -> DataFrame:
    """Days whose end was announced on both topics and of which all announced records are
    there: a marker that overtook records of its day does not close it.

    ``control`` has day, topic and ``rows`` (what the marker says was sent; null says
    nothing), ``staged`` has day, topic and the number of ``records``. Of several markers
    the one with the most rows counts; more records than announced close the day too.
    """
    asked = control.groupBy("day", "topic").agg(F.max("rows").alias("rows"))
    there = staged.groupBy("day", "topic").agg(F.sum("records").alias("records"))
    known = asked.join(there, ["day", "topic"], "left")
    enough = F.coalesce(F.col("records"), F.lit(0)) >= F.coalesce(F.col("rows"), F.lit(0))
    seen = known.groupBy("day").agg(F.count_distinct("topic").alias("topics"), F.bool_and(enough).alias("all"))
    return seen.where((F.col("topics") == 2) & F.col("all")).select("day")


def pending_days(buffered: DataFrame, flushed: DataFrame) -> DataFrame:
    """Days with rows that were not flushed yet."""
    return buffered.select("day").distinct().join(flushed.select("day"), "day", "left_anti")


def flush_once(candidates: DataFrame, flushed: DataFrame) -> DataFrame:
    """Candidate days, each once, without those already done."""
    return pending_days(candidates, flushed)


def late_rows(records: DataFrame, flushed: DataFrame) -> DataFrame:
    """Records of a day that was flushed before they came."""
    return records.join(flushed.select("day"), "day", "left_semi")


def on_time_rows(records: DataFrame, flushed: DataFrame) -> DataFrame:
    return records.join(flushed.select("day"), "day", "left_anti")


def transaction_only_days(logs: DataFrame, transactions: DataFrame) -> DataFrame:
    """Days with transactions and no log row at all."""
    return transactions.select("day").distinct().join(
        logs.select("day").distinct(), "day", "left_anti"
    )


def replay_counts(logs: DataFrame, transactions: DataFrame) -> DataFrame:
    """Rows per day and topic, and a total line (day null)."""
    rows = logs.select("day", F.lit(1).alias("l"), F.lit(0).alias("t")).unionAll(
        transactions.select("day", F.lit(0).alias("l"), F.lit(1).alias("t"))
    )
    return rows.rollup("day").agg(F.sum("l").alias("log_rows"), F.sum("t").alias("transaction_rows"))


def replay_progress(done: DataFrame, total_days: int) -> DataFrame:
    """Days done, days planned, and the share, at most 1."""
    count = F.count_distinct("day")
    return done.agg(
        count.alias("dates_done"),
        F.lit(total_days).cast("bigint").alias("total_days"),
        F.least(count / F.lit(total_days), F.lit(1.0)).alias("progress"),
    )
