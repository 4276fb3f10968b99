"""A day's user ids in order, stored in ranges of a fixed number of ids.

``ids/day=D/range=R``   the ids of ranks R * size + 1 to (R + 1) * size, with their rank
``days/day=D``          how many there are

A page is some ranks in a row, so the ranges it needs follow from its number: one, or two
where it crosses a border, however deep it lies. Ranks are counted once, when a day is
flushed; a day that is written again is replaced.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnloom.functions.running import running_sums
from churnloom.session import stored
from churnloom.sources import files

RANGE = 10_000


def write_days(users: DataFrame, path: str, size: int = RANGE) -> None:
    """Store the users (day, msno) of the days present; repeated ones count once."""
    ids = users.select("day", "msno").distinct().withColumn("one", F.lit(1))
    ranked = running_sums(ids, "msno", ["one"], ["day"])
    ranked = ranked.select(
        "msno", F.col("cum_one").alias("rank"), F.col("all_one").alias("total"), "day",
        F.floor((F.col("cum_one") - 1) / size).alias("range"),
    )
    ranked = stored(ranked, "ranked")
    replace = {"partitionOverwriteMode": "dynamic"}
    (
        ranked.drop("total").repartition("day", "range").sortWithinPartitions("day", "range", "rank")
        .write.mode("overwrite").options(**replace).partitionBy("day", "range").parquet(f"{path}/ids")
    )
    totals = ranked.groupBy("day").agg(F.max("total").alias("total"), F.lit(size).cast("bigint").alias("size"))
    totals.coalesce(1).write.mode("overwrite").options(**replace).partitionBy("day").parquet(f"{path}/days")


def read_page(spark: SparkSession, path: str, day: date, page: int = 1, size: int = 20) -> DataFrame:
    """One page of a day in id order, with total and page count on each row; no row for a
    page beyond the last one or a day without users."""
    if page < 1 or size < 1:
        raise ValueError("page and size start at 1")
    empty = spark.createDataFrame([], "msno string, total bigint, page bigint, pages bigint")
    if day.isoformat() not in files.partition_values(spark, f"{path}/days", "day"):
        return empty
    known = spark.read.parquet(f"{path}/days/day={day.isoformat()}").first()
    first, last = (page - 1) * size + 1, min(page * size, known.total)
    if first > last:
        return empty
    needed = range((first - 1) // known.size, (last - 1) // known.size + 1)
    ids = spark.read.schema("msno string, rank bigint").parquet(
        *[f"{path}/ids/day={day.isoformat()}/range={r}" for r in needed]
    )
    pages = -(-known.total // size)
    return (
        ids.where(F.col("rank").between(first, last))
        .orderBy("rank")
        .select("msno", *[F.lit(v).cast("bigint").alias(n) for n, v in (("total", known.total), ("page", page), ("pages", pages))])
    )
