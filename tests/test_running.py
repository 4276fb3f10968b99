"""The two-level running sum against a plain window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from churnloom.functions.running import running_sums


@pytest.mark.parametrize("groups", [[], ["g"]])
@pytest.mark.parametrize("ranges", [None, 2, 50])
def test_same_as_window(spark, groups, ranges):
    rows = spark.range(5000).select(
        # one group holds most of the rows, and one has no name
        F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 == 7, "cold").alias("g"),
        (F.xxhash64("id") % 2000 / 7.0).alias("v"),
        F.lit(1).alias("n"),
    )
    once = rows.groupBy(*groups, "v").agg(F.sum("n").alias("n"))
    got = running_sums(once, "v", ["n"], groups, ranges)
    w = Window.partitionBy(*groups)
    want = once.withColumn("cum_n", F.sum("n").over(w.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
    want = want.withColumn("all_n", F.sum("n").over(w)).select(got.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() == once.count()


def test_ranges_chosen_at_run_time(spark):
    """Small target sizes make adaptive execution keep many ranges."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        rows = spark.range(20000).select(F.col("id").alias("v"), F.lit(1).alias("n"))
        got = running_sums(rows, "v", ["n"])
        assert got.where("cum_n <> v + 1 OR all_n <> 20000").count() == 0 and got.count() == 20000
        assert "_range" in got._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")


def test_no_rows(spark):
    rows = spark.createDataFrame([], "g string, v double, n int")
    assert running_sums(rows, "v", ["n"], ["g"]).count() == 0
