"""Steps whose cost grew with more than their input: each on rows of its own."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from churnloom import fixed
from churnloom.functions import scalars as S
from churnloom.operators import explanation, features, models, preparation
from churnloom.plans import scoring
from churnloom.plans.workspace import Workspace

DAY = dt.date(2024, 1, 15)


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_a_filter_on_a_day_names_the_number_few_times(spark):
    number = F.year("d") * 10000 + F.month("d") * 100 + F.dayofmonth("d")
    rows = spark.range(2).select(F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("d")).select(number.alias("n"))
    found = rows.withColumn("n", S.day_from_int("n")).where(F.col("n") <= F.lit(DAY))
    assert [r.n for r in found.collect()] == [DAY]
    found = _plan(found).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert found.count("year(") <= 12


def test_numbers_as_days(spark):
    numbers = [20240229, 20230229, 20240100, 20240132, 20241301, 10000101, 99991231, 9991231, 100000101, -20240101, 0]
    rows = spark.createDataFrame([(n,) for n in [*numbers, None]], "n bigint")
    found = {r.n: r.day for r in rows.select("n", S.day_from_int("n").alias("day")).collect()}
    days = {20240229: dt.date(2024, 2, 29), 10000101: dt.date(1000, 1, 1), 99991231: dt.date(9999, 12, 31)}
    assert found == {n: days.get(n) for n in [*numbers, None]}


def _gold_inputs(spark):
    train = spark.createDataFrame([("a", 1), ("b", 0), (None, 1)], "msno string, is_churn int")
    members = spark.createDataFrame(
        [(u, 1, 20, "male", 3, DAY) for u in ("a", "c", None)],
        "msno string, city int, bd int, gender string, registered_via int, registration_init_time date",
    )
    paid = spark.createDataFrame(
        [(u, DAY, DAY, 2.5, 1, 0) for u in ("a", "a", "c", None)],
        "msno string, transaction_date date, membership_expire_date date, actual_amount_paid double,"
        " is_auto_renew int, is_cancel int",
    )
    plays = ", ".join(f"num_{p} int" for p in features.PLAYS)
    logs = spark.createDataFrame(
        [(u, DAY, 1.5, *[1] * len(features.PLAYS)) for u in ("b", "c", None)],
        f"msno string, date date, total_secs double, {plays}",
    )
    return train, members, paid, logs


def test_gold_drops_unlabelled_users_before_any_shuffle(spark, monkeypatch):
    inputs = _gold_inputs(spark)
    few = features.gold_features(*inputs, DAY)
    assert _plan(few).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0].count("LeftSemi") == 3
    monkeypatch.setattr(features, "FEW_USERS", 0)
    many = features.gold_features(*inputs, DAY)
    assert "LeftSemi" not in _plan(many)
    assert few.columns == many.columns and few.count() == 3
    assert few.exceptAll(many).count() == many.exceptAll(few).count() == 0


def _artefacts():
    config = {"num_cols_medians": {}, "bd_median": 30.0, "city_mode": 1, "registered_via_mode": 3}
    return scoring.Artefacts(None, config, list(fixed.FEATURES), "", "", {})


def test_rows_to_score_leave_the_tasks_that_read_the_ids(spark):
    latest = spark.range(1).select(
        F.lit("a").alias("msno"), *[F.lit("male" if c == "gender" else "1").alias(c) for c in fixed.FEATURES]
    )
    requests = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "msno string").coalesce(1)
    ready = scoring.prepared(requests, latest, _artefacts())
    assert "REBALANCE_PARTITIONS_BY_NONE" in _plan(ready)
    assert sorted((r.msno or "", r.member_found) for r in ready.collect()) == [
        ("", False), ("a", True), ("b", False), ("b", False),
    ]


def test_equal_rows_are_explained_once(monkeypatch):
    leaves = (
        explanation.Leaf(1.0, (0,), (-np.inf,), (0.5,), (0.25,)),
        explanation.Leaf(-1.0, (0, 2), (0.5, -np.inf), (np.inf, 3.0), (0.75, 0.5)),
    )
    x = np.array([[0.0, 1, 2], [1.0, 1, 4], [0.0, 1, 2], [0.0, 1, 2]])
    whole, seen = explanation.contributions(x, leaves), []
    plain = explanation.contributions
    monkeypatch.setattr(explanation, "contributions", lambda a, b: seen.append(len(a)) or plain(a, b))
    assert (explanation.of_rows(x, leaves) == whole).all() and seen == [2]
    assert explanation.of_rows(x[:0], leaves).shape == (0, 3)


def test_sent_messages_are_encoded_once(spark, tmp_path):
    rows = [(1, dt.datetime(2024, 1, 20, 3), 5, "purchase", 2.0, "{}"), (2, dt.datetime(2024, 1, 21), 6, "view", 1.0, "{}")]
    spark.createDataFrame(
        rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ).write.parquet(f"{tmp_path}/events.parquet")
    w = Workspace(spark, str(tmp_path))
    assert w.sent() is w.sent() and "events.parquet" not in _plan(w.sent())
    assert sorted(map(tuple, w.sent().collect())) == sorted(map(tuple, w.messages().collect()))


def test_a_fit_that_goes_on_grows_few_trees_twice(spark, monkeypatch):
    noise = {c: F.pmod(F.xxhash64("id", F.lit(c)), F.lit(97)).cast("double") for c in fixed.FEATURES}
    named = [v.alias(c) for c, v in noise.items()]
    churn = F.pmod(F.xxhash64("id"), F.lit(2)).cast("int").alias("is_churn")
    rows = spark.range(300).select(F.col("id").cast("string").alias("msno"), *named, churn).coalesce(2)
    asked, plain = [], models.boosted_trees
    monkeypatch.setattr(models, "boosted_trees", lambda **p: asked.append(p["n_estimators"]) or plain(**p))
    # Every round is a little better, up to round 20.
    bounds = lambda model, watched: [(0.5 + min(k, 20) / 100,) * 2 for k in range(model.getNumTrees)]
    monkeypatch.setattr(models, "auc_bounds", bounds)
    monkeypatch.setattr(models, "round_auc", lambda model, watched, two: [k / 100 for k in two])
    kept = models.fit_boosted(rows, 2, n_estimators=24, max_depth=2)
    assert asked == [4, 24] and kept.getNumTrees == 22
    asked.clear()
    models.fit_boosted(rows, 12, n_estimators=24, max_depth=2)
    assert asked == [24]


def test_many_users_are_dealt_evenly(spark, monkeypatch):
    rows = spark.range(0, 4000, 1, 2).select(F.col("id").cast("string").alias("msno"))
    assert preparation.dealt(rows) is rows
    monkeypatch.setattr(preparation, "MANY_ROWS", 4000)
    cores = spark.sparkContext.defaultParallelism
    parts = preparation.dealt(rows).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == cores and max(r["count"] for r in parts) < 1.5 * 4000 / cores
    monkeypatch.setattr(preparation, "ROWS_OF_A_TASK", 300)
    whole = preparation.dealt(rows)
    assert whole.rdd.getNumPartitions() == cores * -(-4000 // (cores * 300))
    assert whole.exceptAll(rows).count() == rows.exceptAll(whole).count() == 0


def test_labelled_users_of_a_large_table_are_broadcast_as_numbers(spark):
    assert features.FEW_USERS >= 1_400_000
    plan = _plan(features.gold_features(*_gold_inputs(spark), DAY))
    assert plan.split("== Physical Plan ==")[1].count("BroadcastExchange HashedRelationBroadcastMode(List(input[0, bigint, ") == 3
