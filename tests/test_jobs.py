"""Batch jobs, sinks, model artefacts and the score log."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from churnloom import fixed
from churnloom.operators import cleaning, evaluation, models
from churnloom.plans import batch, scoring
from churnloom.plans.workspace import Workspace
from churnloom.sources import tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def w(spark):
    return Workspace(spark, SF_DIR)


def test_raw_files_to_gold(spark, tmp_path, w):
    raw = {
        "members_v3.csv": w.members_raw(),
        "transactions.csv": w.transactions_raw(1),
        "transactions_v2.csv": w.transactions_raw(2),
        "train.csv": w.train_raw(1),
        "train_v2.csv": w.train_raw(2),
        "user_logs.csv": w.user_logs_raw(),
        "user_logs_v2.csv": w.user_logs_raw().limit(0),
    }
    for name, df in raw.items():
        df.write.option("header", True).csv(f"{tmp_path}/bronze/{name}")
    batch.bronze_to_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver")
    gold = batch.silver_to_gold(spark, f"{tmp_path}/silver", f"{tmp_path}/gold")
    want = w.gold()
    assert gold.columns == want.columns and gold.count() == want.count()
    a, b = (df.agg(F.sum("total_log_days"), F.sum("total_transactions"), F.sum("bd")).first() for df in (gold, want))
    assert a == b


def test_bronze_columns_are_found_by_name(spark, tmp_path):
    spark.sql("SELECT 1 AS is_churn, 'a' AS msno").write.option("header", True).csv(f"{tmp_path}/train")
    assert tables.read_bronze(spark, f"{tmp_path}/train", "train").collect() == [("a", 1)]
    spark.sql("SELECT 'a' AS msno").write.option("header", True).csv(f"{tmp_path}/short")
    with pytest.raises(ValueError, match="is_churn"):
        tables.read_bronze(spark, f"{tmp_path}/short", "train")


def test_payments_that_differ_in_a_further_column_stay(spark, tmp_path, w):
    paid = w.transactions_raw(1).limit(50).selectExpr("41 AS payment_method_id", "*", "30 AS plan_days")
    both = paid.union(paid.withColumn("plan_days", F.lit(90))).union(paid)
    both.write.option("header", True).csv(f"{tmp_path}/paid")
    read = tables.read_bronze(spark, f"{tmp_path}/paid", "transactions")
    assert cleaning.silver_transactions(read).count() == 2 * paid.distinct().count()


def test_retried_day_replaces_itself_only(spark, tmp_path, w):
    path = f"{tmp_path}/features"
    rows = w.feature_table().drop("event_date")
    tables.append_features(rows, path)
    tables.append_features(rows.where(F.col("event_timestamp") == F.lit(dt.datetime(2024, 1, 20))), path)
    assert spark.read.parquet(path).count() == rows.count()


def test_missing_key_fails_the_write(spark, tmp_path, w):
    broken = w.feature_table().drop("event_date").withColumn("msno", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="msno is required"):
        tables.append_features(broken, f"{tmp_path}/broken")


def test_day_filter_reaches_the_partitions(w):
    plan = tables.day_slice(w.feature_table(), dt.date(2024, 1, 20), ["msno"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_feature_table_is_created_once(spark):
    tables.ensure_feature_table(spark, "features_streaming")
    tables.ensure_feature_table(spark, "features_streaming")
    assert spark.table("features_streaming").columns[-1] == "event_date"
    spark.sql("DROP TABLE features_streaming")


def test_id_list_needs_its_column(spark, tmp_path):
    spark.sql("SELECT 'a' AS user").write.option("header", True).csv(f"{tmp_path}/ids")
    with pytest.raises(ValueError):
        tables.read_ids(spark, f"{tmp_path}/ids")


def test_exports(spark, tmp_path):
    scores = spark.createDataFrame([("a", 0.12345, 0)], "msno string, churn_probability double, is_churn int")
    tables.export_scores(scores, f"{tmp_path}/short")
    tables.export_scores(scores.withColumn("x", F.lit(1)), f"{tmp_path}/all", all_columns=True)
    row = spark.read.option("header", True).csv(f"{tmp_path}/short").first()
    # 0.12345 is a little more than its decimal text says
    assert row.asDict() == {"msno": "a", "churn_probability": "0.1235", "is_churn": "0"}
    assert spark.read.option("header", True).csv(f"{tmp_path}/all").columns[-1] == "x"


def test_saved_model_scores_the_same(spark, w, tmp_path):
    art = w.artefacts()
    loaded = scoring.load(spark, art.path)
    assert loaded.features == fixed.FEATURES and loaded.run_id == art.run_id
    ids = spark.createDataFrame([("0",), ("1",), ("nobody",)], "msno string")
    one, two = (scoring.score_batch(ids, w.latest(), a).orderBy("msno").collect() for a in (art, loaded))
    assert one == two and [r.member_found for r in one] == [True, True, False]


def test_scoring_keeps_every_request(spark, w):
    """Repeated and unknown ids are scored as often as they are asked for."""
    ids = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "7").otherwise(F.col("id").cast("string")).alias("msno"))
    assert scoring.score_batch(ids, w.latest(), w.artefacts()).count() == 3000


def test_run_log_and_score_log(spark, tmp_path):
    models.log_run(spark, f"{tmp_path}/runs", "r1", {"auc_roc": 0.5, "depth": 6})
    models.log_run(spark, f"{tmp_path}/runs", "r2", {"auc_roc": 0.6})
    assert spark.read.parquet(f"{tmp_path}/runs").count() == 3
    scores = spark.createDataFrame([("a", 0.9, 1)], "msno string, churn_probability double, is_churn int")
    for run, time in (("r1", "2017-03-14"), ("r2", None), ("r1", "2017-03-15")):
        scoring.append_scores(scores, f"{tmp_path}/scores", run, time)
    times = sorted(r.predicted_at for r in spark.read.parquet(f"{tmp_path}/scores").collect())
    assert len(times) == 2 and times[0] == "2017-03-15" and times[1].endswith("UTC")


def test_commands_end_to_end(spark, tmp_path, w):
    """Raw files to explained scores, each step through the command line."""
    from churnloom.__main__ import main

    bronze, silver, gold = (f"{tmp_path}/{n}" for n in ("bronze", "silver", "gold"))
    jan = F.col("transaction_date") > 0
    stream_paid = w.stream_transactions().select(
        "msno",
        F.date_format("transaction_date", "yyyyMMdd").cast("int").alias("transaction_date"),
        F.lit(20240301).alias("membership_expire_date"),
        "actual_amount_paid",
        F.col("actual_amount_paid").alias("plan_list_price"),
        "is_auto_renew",
        "is_cancel",
    )
    raw = {
        "members_v3.csv": w.members_raw(),
        "transactions.csv": w.transactions_raw(1).where(jan),
        "transactions_v2.csv": stream_paid,
        "train.csv": w.train_raw(1),
        "train_v2.csv": w.train_raw(2),
        "user_logs.csv": w.user_logs_raw(),
        "user_logs_v2.csv": w.user_logs_raw().limit(0),
    }
    for name, df in raw.items():
        df.write.option("header", True).csv(f"{bronze}/{name}")
    w.table("customer").select(F.col("c_custkey").alias("msno")).write.option("header", True).csv(f"{tmp_path}/ids")

    def run(text):
        main(text.format(t=tmp_path, bronze=bronze, silver=silver, gold=gold).split())

    run("silver --bronze {bronze} --silver {silver}")
    run("gold --silver {silver} --gold {gold} --as-of 2024-01-15")
    run("replay --silver {silver} --messages {t}/messages --start 2024-01-27")
    run("stream --gold {gold} --tables {t}/tables --messages {t}/messages")
    run("train --gold {gold} --model {t}/model --runs {t}/runs --n-estimators 3 --max-depth 2")
    run("refresh-config --gold {gold} --model {t}/model")
    run("score --ids {t}/ids --features {t}/tables/features --model {t}/model --out {t}/scores")
    run("explain --ids {t}/ids --features {t}/tables/features --model {t}/model --out {t}/reasons")
    run("drift --gold {gold} --features {t}/tables/features --out {t}/drift --day 2024-01-28")

    customers = w.table("customer").count()
    assert spark.read.option("header", True).csv(f"{tmp_path}/scores").count() == customers
    assert spark.read.parquet(f"{tmp_path}/reasons").count() == customers
    assert spark.read.parquet(f"{tmp_path}/drift").select("event_date").distinct().count() == 1
    assert spark.read.parquet(f"{tmp_path}/tables/features").select("event_date").distinct().count() == 4


def test_offline_table_is_replaced(spark):
    tables.publish_offline(spark.range(3), "features_train")
    tables.publish_offline(spark.range(2), "features_train")
    assert spark.table("features_train").count() == 2
    spark.sql("DROP TABLE features_train")


def _with_signal(spark, rows=2000):
    """Users whose churn depends on two features, with noise."""
    base = spark.range(rows).withColumn("u", F.rand(1)).withColumn("v", F.rand(2)).withColumn("e", F.randn(3))
    churn = (F.sin(F.col("u") * 6) + F.col("v") ** 2 + 0.3 * F.col("e") > 0.6).cast("int")
    columns = {c: F.lit(0.0) for c in fixed.FEATURES} | {
        fixed.FEATURES[0]: F.col("u"), fixed.FEATURES[5]: F.col("v"), "is_churn": churn, "msno": F.col("id").cast("string")
    }
    return base.select(*[c.alias(n) for n, c in columns.items()]).coalesce(2).cache()


def test_boosting_keeps_more_than_a_few_trees(spark):
    rows = _with_signal(spark)
    stopped = models.fit_boosted(rows, n_estimators=60, max_depth=3)
    assert 5 < stopped.getNumTrees <= 60
    patient = models.fit_boosted(rows, 5, n_estimators=30, max_depth=2)
    assert 5 < patient.getNumTrees <= 30


def test_boosting_waits_thirty_rounds_for_a_better_auc(spark):
    assert models._best_round([0.5, 0.7, 0.6, 0.65, 0.9], 2) == (2, True)
    assert models._best_round([0.5, 0.7, 0.7, 0.8], 3) == (4, False)
    rows = _with_signal(spark, 800)
    kept = models.fit_boosted(rows, n_estimators=40, max_depth=2)
    watched = models.assembled(rows.where(models._held_out(models.VALIDATION_SHARE)))
    fitted = models.assembled(models.weighted(rows).where(~models._held_out(models.VALIDATION_SHARE)))
    whole = models.boosted_trees(n_estimators=40, max_depth=2).fit(fitted)
    found = models.round_auc(whole, watched)
    scored = models.score(watched.drop("features"), whole).withColumnRenamed("churn_probability", "score")
    assert found[-1] == pytest.approx(evaluation.auc(evaluation.threshold_counts(scored)).first().auc_roc)
    assert len(found) == 40 and kept.getNumTrees == models._best_round(found, 30)[0]


def test_rounds_are_watched_by_counts(spark):
    """Bounds hold the exact areas, and what is sent does not grow with the watched users."""
    rows = _with_signal(spark, 1500)
    model = models.boosted_trees(n_estimators=12, max_depth=3).fit(models.assembled(models.weighted(rows)))
    watched = models.assembled(rows)
    exact = models.round_auc(model, watched)
    bounds = models.auc_bounds(model, watched)
    assert len(bounds) == 12 and all(low <= a + 1e-12 and a <= high + 1e-12 for (low, high), a in zip(bounds, exact))
    assert models.round_auc(model, watched, [3, 11]) == [exact[3], exact[11]]
    more = models.auc_bounds(model, watched.union(watched).union(watched))
    assert [x for b in more for x in b] == pytest.approx([x for b in bounds for x in b])


def test_first_rounds_without_fitting_again(spark, tmp_path):
    rows = _with_signal(spark, 600)
    ready = models.assembled(models.weighted(rows))
    short = models.boosted_trees(n_estimators=4, max_depth=3).fit(ready)
    cut = models.first_rounds(models.boosted_trees(n_estimators=9, max_depth=3).fit(ready), 4)
    assert cut.getNumTrees == 4 and cut.treeWeights == short.treeWeights
    assert len(models.feature_importance(spark, cut).collect()) == len(fixed.FEATURES)
    cut.write().overwrite().save(f"{tmp_path}/cut")
    from pyspark.ml.classification import GBTClassificationModel

    scores = [
        sorted((r.msno, r.churn_probability) for r in models.score(rows, m).select("msno", "churn_probability").collect())
        for m in (short, cut, GBTClassificationModel.load(f"{tmp_path}/cut"))
    ]
    assert scores[0] == scores[1] == scores[2]


@pytest.mark.parametrize("name", ["Main", "Logistic Regression", "Random Forest", "Gradient Boosting"])
def test_models_find_a_planted_signal(spark, name):
    rows = _with_signal(spark, 1500)
    late = F.pmod(F.xxhash64("msno"), F.lit(5)) == 0
    early, test = rows.where(~late), rows.where(late)
    if name == "Main":
        model = models.fit_boosted(early, n_estimators=30, max_depth=3)
    else:
        estimator, balanced = models.candidates()[name]
        small = {"Random Forest": models.random_forest(20, 8, 10), "Gradient Boosting": models.baseline_boosting(20, 3, 10)}
        model = models.fit(small.get(name, estimator), early, balanced)
    scored = models.score(test, model).withColumnRenamed("churn_probability", "score")
    area = evaluation.auc(evaluation.threshold_counts(scored)).first().auc_roc
    assert area > (0.75 if name == "Logistic Regression" else 0.85)
