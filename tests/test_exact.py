"""Sums that do not depend on how rows are split, and trailing windows by differences."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from check import connect, difference
from pyspark.sql import functions as F

import __spark_entry__ as entry
from churnloom.operators import features
from churnloom.operators import request_metrics as rm
from churnloom.plans.workspace import Workspace

METRICS = "mean_latency fetch_latency mean_prob mean_batch hist_quantile fetch_quantile rolling_churn_rate".split()


@pytest.fixture(scope="module")
def larger():
    return connect("/root/testdata/sf0.01")


@pytest.mark.parametrize("name", METRICS)
def test_metrics_on_the_larger_tables(spark, larger, name):
    found = entry.queries()[name](spark, "/root/testdata/sf0.01")
    assert difference(found, larger, entry.oracle_sql()[name]) is None


def test_gold_is_the_same_under_any_partitioning(spark):
    w = Workspace(spark, "/root/testdata/sf0.01")
    paid = w.silver_transactions().withColumn("actual_amount_paid", F.col("actual_amount_paid") / 7)
    logs = w.silver_logs().withColumn("total_secs", F.col("total_secs") / 3)
    found = []
    for parts in (1, 7, 40):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        gold = features.gold_features(
            w.silver_train(), w.silver_members(), paid.repartition(parts), logs.repartition(parts + 2)
        )
        found.append(sorted(map(str, gold.collect())))
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert found[0] == found[1] == found[2]


def trailing_by_hand(rows, width, every):
    epoch = dt.datetime(1970, 1, 1)
    out = defaultdict(lambda: [0, Decimal(0)])
    for label, ts, value in rows:
        step = (ts - epoch) // dt.timedelta(seconds=every)
        for k in range(width // every):
            held = out[label, epoch + dt.timedelta(seconds=(step + 1 + k) * every)]
            held[0] += 1
            held[1] += Decimal(str(value or 0))
    return {k: (n, float(v)) for k, (n, v) in out.items()}


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("piece,width,every", [(4096, 300, 15), (20, 300, 15), (7, 60, 60), (3, 120, 60)])
def test_trailing_windows(spark, monkeypatch, kind, piece, width, every):
    monkeypatch.setattr(rm, "STEPS_AT_A_TIME", piece)
    draw = random.Random(piece)
    start = dt.datetime(1969, 12, 31, 23, 40)
    rows = [
        (draw.choice("ab"), start + dt.timedelta(seconds=draw.choice([3, 15, 900, 40_000]) * draw.random()),
         draw.choice([None, 0.1, 0.25, 7.3]))
        for _ in range(200)
    ]
    log = spark.createDataFrame([(a, b.isoformat(), c) for a, b, c in rows], "label string, at string, value double")
    log = log.withColumn("ts", F.col("at").cast(kind))
    from churnloom.functions import scalars as S

    sums = {"n": F.count(F.lit(1)), "total": F.sum(S.exact("value"))}
    got = {
        (r.label, r.end): (r.n, float(r.total or 0))
        for r in rm.windowed(log, sums, ["label"], width, every)
        .withColumn("end", F.col("window_end").cast("timestamp_ntz"))
        .collect()
    }
    assert got == trailing_by_hand(rows, width, every)


def test_each_label_in_one_pass(spark):
    rows = [("p", "200", i) for i in range(40)] + [("q", "500", i) for i in range(0, 40, 3)] + [(None, "200", 5)]
    log = spark.createDataFrame(rows, "path string, status string, s int").withColumn(
        "ts", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'") + F.make_dt_interval(secs=F.col("s"))
    )
    got = {(r.label_of, r.label): r.n for r in rm.rate_by_each(log, ["path", "status"], 60).collect()}
    assert got == {("path", "p"): 40, ("path", "q"): 14, ("path", None): 1, ("status", "200"): 41, ("status", "500"): 14}
    found = rm.trailing_quantiles(log, "s", [10.0, 20.0], [0.5, 0.99], ["path"], overall=True, width=60)
    by = {(r.label_of, r.label, r.q): round(r.quantile, 6) for r in found.collect()}
    assert by["path", "p", 0.5] == round(10 + 10 * (20 - 11) / 10, 6) and by["all", "all", 0.99] == 20.0
