"""Hand-written cases at the edges of the definitions."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from churnloom import fixed
from churnloom.functions import scalars as S
from churnloom.operators import cleaning, days, drift, evaluation, features, lookup
from churnloom.operators import preparation as prep
from churnloom.operators import reports, request_metrics as rm

DAY = dt.date(2024, 1, 16)


def values(df, column):
    return [r[column] for r in df.collect()]


def test_age_outside_range_is_unknown(spark):
    df = spark.createDataFrame([(0,), (1,), (100,), (101,), (None,), (-5,)], "bd int")
    assert values(df.select(S.valid_age("bd").alias("bd")), "bd") == [None, 1, 100, None, None, None]


def test_impossible_days_are_null(spark):
    df = spark.createDataFrame([(20170301,), (20170230,), (2017030,), (None,)], "d int")
    got = values(df.select(S.day_from_int("d").alias("d")), "d")
    assert got == [dt.date(2017, 3, 1), None, None, None]


def test_gender_codes(spark):
    df = spark.createDataFrame([("male",), ("female",), (None,), ("other",)], "g string")
    assert values(df.select(S.gender_code("g").alias("g")), "g") == [0, 1, 2, 2]


def test_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(0.781,), (0.7809,), (None,)], "p double")
    assert values(df.select(S.churn_flag("p").alias("f")), "f") == [1, 0, None]


def test_score_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.999,), (1.0,), (None,)], "p double")
    assert values(df.select(S.score_bin("p", 20).alias("b")), "b") == [0, 1, 19, 19, None]


def test_event_time_defaults_to_now(spark):
    df = spark.createDataFrame([("2017-03-15",), (None,), ("",)], "t string")
    given, now, empty = values(df.select(S.event_time_or_now("t").alias("t")), "t")
    assert given == "2017-03-15" and now.endswith(" UTC") and empty.endswith(" UTC")


def test_wall_time_survives_other_zones(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-16 23:30:00' AS t")
        row = df.select(
            F.unix_timestamp(S.utc_instant("t")).alias("s"),
            S.utc_wall_time(S.utc_instant("t")).alias("back"),
            S.day_start(F.to_date("t")).alias("start"),
        ).first()
        assert row.s == 1705447800
        assert row.back == dt.datetime(2024, 1, 16, 23, 30)
        assert row.start == dt.datetime(2024, 1, 16)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_later_label_version_wins(spark):
    v1 = spark.createDataFrame([("a", 0), ("b", 1)], "msno string, is_churn int")
    v2 = spark.createDataFrame([("a", 1)], "msno string, is_churn int")
    got = {r.msno: r.is_churn for r in cleaning.silver_train(v1, v2).collect()}
    assert got == {"a": 1, "b": 1}


def test_members_pick_does_not_depend_on_row_order(spark):
    rows = [("a", 3, 20, None, 1, 20150101), ("a", 2, None, "male", 1, 20150101)]
    schema = "msno string, city int, bd int, gender string, registered_via int, registration_init_time int"
    one = cleaning.silver_members(spark.createDataFrame(rows, schema)).collect()
    two = cleaning.silver_members(spark.createDataFrame(rows[::-1], schema)).collect()
    assert one == two and one[0].city == 2


def test_cumulative_by_activity_kind(spark):
    """In logs only, in transactions only, in both; with and without baseline."""
    logs = spark.createDataFrame(
        [(DAY, "log", 1, 100.0), (DAY, "both", 2, None)], "day date, msno string, num_25 int, total_secs double"
    )
    for c in ("num_50", "num_75", "num_985", "num_100", "num_unq"):
        logs = logs.withColumn(c, F.lit(None).cast("int"))
    paid = spark.createDataFrame(
        [(DAY, "paid", 10.0, 1, 0), (DAY, "both", 20.0, 0, 1), (DAY, "both", None, 0, 0)],
        "day date, msno string, actual_amount_paid double, is_auto_renew int, is_cancel int",
    )
    zero = {c: 0 for c in features.TOTALS}
    base_row = {**zero, "msno": "paid", "city": 7, "bd": 30, "gender": "male", "registered_via": 4,
                "total_transactions": 2, "total_amount_paid": 30.0, "total_secs": 0.0}
    order = ["msno", *fixed.DEMOGRAPHICS, *features.TOTALS]
    kinds = ["string", "bigint", "bigint", "string", "bigint"] + [features.total_type(c) for c in features.TOTALS]
    baseline = spark.createDataFrame(
        [tuple(base_row[c] for c in order)], ", ".join(f"{c} {k}" for c, k in zip(order, kinds))
    )
    rows = {r.msno: r for r in features.cumulative_features(features.daily_delta(logs, paid), baseline).collect()}
    assert set(rows) == {"log", "paid", "both"}
    assert rows["log"].avg_amount_paid is None and rows["log"].avg_daily_secs == 100.0
    assert rows["log"].city is None
    assert rows["paid"].total_transactions == 3 and rows["paid"].total_amount_paid == 40.0
    assert rows["paid"].avg_daily_secs is None and rows["paid"].city == 7
    assert rows["both"].total_transactions == 2 and rows["both"].avg_amount_paid == 10.0
    assert rows["both"].avg_daily_secs == 0.0 and rows["both"].total_num_25 == 2


def test_ready_needs_both_topics(spark):
    rows = [("user_logs", DAY), ("user_logs", DAY), ("transactions", dt.date(2024, 1, 17)),
            ("user_logs", dt.date(2024, 1, 17))]
    ready = days.ready_days(spark.createDataFrame(rows, "topic string, day date"))
    assert values(ready, "day") == [dt.date(2024, 1, 17)]


# --- point in time ---------------------------------------------------------


def asof(spark, feature_times, request_times):
    feats = spark.createDataFrame(
        [("u", t, i) for i, t in enumerate(feature_times)], "msno string, event_timestamp timestamp_ntz, x int"
    )
    asks = spark.createDataFrame(
        [(i, "u", t) for i, t in enumerate(request_times)], "id int, msno string, request_time timestamp_ntz"
    )
    got = lookup.asof_features(asks, feats).orderBy("id").collect()
    assert len(got) == len(request_times)
    return [r.x for r in got]


def test_asof_edges(spark):
    t = dt.datetime(2024, 1, 16, 12)
    ttl = fixed.FEATURE_TTL
    second = dt.timedelta(seconds=1)
    assert asof(spark, [t], [t, t - second, t + ttl, t + ttl + second]) == [0, None, 0, None]


def test_asof_prefers_the_newer_row(spark):
    t = dt.datetime(2024, 1, 16, 12)
    hour = dt.timedelta(hours=1)
    assert asof(spark, [t, t + hour, t + 40 * hour], [t + hour / 2, t + hour, t + 39 * hour, t + 41 * hour]) == [0, 1, 1, 2]
    assert asof(spark, [t, t], [t]) == [1]


def test_asof_against_brute_force(spark):
    import random

    rng = random.Random(3)
    start = dt.datetime(2023, 12, 1)
    feats = [(rng.choice("aaab"), start + dt.timedelta(minutes=rng.randrange(90 * 1440)), i) for i in range(60)]
    asks = [(i, rng.choice("aaabc"), start + dt.timedelta(minutes=rng.randrange(120 * 1440))) for i in range(400)]
    f = spark.createDataFrame(feats, "msno string, event_timestamp timestamp_ntz, x int")
    a = spark.createDataFrame(asks, "id int, msno string, request_time timestamp_ntz")
    got = {r.id: r.x for r in lookup.asof_features(a, f).collect()}
    for i, user, time in asks:
        ok = [(t, x) for u, t, x in feats if u == user and time - fixed.FEATURE_TTL <= t <= time]
        assert got[i] == (max(ok)[1] if ok else None)
    assert len(got) == len(asks)


def test_materialize_keeps_the_newest(spark):
    names = ", ".join(f"{c} {'string' if c == 'gender' else 'double'}" for c in fixed.FEATURES)

    def rows(*times):
        return spark.createDataFrame(
            [("u", t, *(None if c == "gender" else float(t.day) for c in fixed.FEATURES)) for t in times],
            f"msno string, event_timestamp timestamp_ntz, {names}",
        )

    jan = lambda d: dt.datetime(2024, 1, d)
    table = rows(jan(1), jan(2), jan(5))
    first = lookup.materialize(None, table, jan(1), jan(3))
    assert values(first, "bd") == [2.0]
    assert values(lookup.materialize(first, table, jan(1), jan(2)), "bd") == [2.0]
    assert values(lookup.materialize(first, table, jan(5), jan(6)), "bd") == [5.0]


# --- drift -------------------------------------------------------------------


def one_feature(spark, numbers, day=None):
    df = spark.createDataFrame([(x,) for x in numbers], "total_secs double")
    for c in fixed.NUMERIC_FEATURES:
        if c != "total_secs":
            df = df.withColumn(c, F.lit(None).cast("double"))
    return df.withColumn("event_date", F.lit(day)) if day else df


def test_histogram_edges(spark):
    bins = drift.drift_baseline(one_feature(spark, [0.0, 1.0, 9.99, 10.0, None])).orderBy("bin").collect()
    assert [r.feature for r in bins] == ["total_secs"] * 10
    assert [r.ref_count for r in bins] == [1, 1, 0, 0, 0, 0, 0, 0, 0, 2]


def test_constant_feature_is_widened(spark):
    bins = drift.drift_baseline(one_feature(spark, [5.0, 5.0])).orderBy("bin").collect()
    assert (bins[0].low, bins[0].high) == (4.5, 5.5)
    assert sum(r.ref_count for r in bins) == 2 and bins[5].ref_count == 2


def test_bins_follow_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    ref = np.round(rng.normal(size=3000), 1)
    want, _ = np.histogram(ref, bins=10)
    got = drift.drift_baseline(one_feature(spark, ref.tolist())).orderBy("bin").collect()
    assert [r.ref_count for r in got] == want.tolist()


def psi_of(spark, ref, cur, **options):
    table = drift.drift_psi(drift.drift_baseline(one_feature(spark, ref)), one_feature(spark, cur, DAY), **options)
    return [r.psi for r in table.collect()]


def test_psi_values(spark):
    import numpy as np

    ref, cur = [float(x % 50) for x in range(500)], [float(x % 30) for x in range(200)]
    assert psi_of(spark, ref, ref) == [0.0]
    r, edges = np.histogram(ref, bins=10)
    c, _ = np.histogram(cur, bins=edges)
    rs, cs = (np.clip(x / (x.sum() + 1e-6), 1e-6, None) for x in (r, c))
    assert psi_of(spark, ref, cur)[0] == pytest.approx(float(((cs - rs) * np.log(cs / rs)).sum()))


def test_psi_outside_values(spark):
    """Outside values do not count, unless the end bins are open."""
    ref = [float(x) for x in range(101)]
    assert psi_of(spark, ref, [500.0])[0] > 1
    assert psi_of(spark, ref, ref + [500.0]) == psi_of(spark, ref, ref)
    assert psi_of(spark, ref, ref + [500.0], open_ends=True)[0] > 0
    assert psi_of(spark, ref, [None]) == []


def test_ks_against_brute_force(spark):
    import random

    rng = random.Random(1)
    ref = [round(rng.gauss(0, 1), 1) for _ in range(300)]
    cur = [round(rng.gauss(0.4, 1.3), 1) for _ in range(80)]
    got = drift.drift_ks(one_feature(spark, ref), one_feature(spark, cur, DAY)).first()
    share = lambda xs, v: sum(x <= v for x in xs) / len(xs)
    assert got.ks_stat == pytest.approx(max(abs(share(ref, v) - share(cur, v)) for v in ref + cur))
    assert (got.ref_n, got.cur_n) == (300, 80)
    same = drift.drift_ks(one_feature(spark, ref), one_feature(spark, ref, DAY)).first()
    assert same.ks_stat == 0.0


def test_ks_far_apart_counts_as_drift(spark):
    """A p-value that rounds to 0 is drift, not its absence."""
    table = drift.drift_table(
        one_feature(spark, [float(x) for x in range(500)]), one_feature(spark, [1000.0 + x for x in range(500)], DAY)
    ).first()
    assert round(table.ks_pvalue, 6) == 0.0 and table.ks_drift and table.level == "critical"


def test_levels(spark):
    df = spark.createDataFrame([(None,), (0.0999,), (0.10,), (0.2499,), (0.25,)], "p double")
    assert values(df.select(S.psi_level("p").alias("l")), "l") == ["pending", "stable", "warning", "warning", "critical"]


# --- preparation and evaluation ------------------------------------------------


def test_policies_for_missing_numbers(spark):
    df = one_feature(spark, [1.0, 3.0, None]).withColumns(
        {"bd": F.lit(None).cast("int"), "city": F.lit(None).cast("int"), "gender": F.lit(None).cast("string"),
         "registered_via": F.lit(9)}
    )
    config = prep.fit_config(df)
    assert config["num_cols_medians"] == {"total_secs": 2.0} and config["bd_median"] is None
    config.update(bd_median=28.0, city_mode=1)
    assert values(prep.impute(df, config, "zero"), "total_secs") == [1.0, 3.0, 0.0]
    assert values(prep.impute(df, config, "median"), "total_secs") == [1.0, 3.0, 2.0]
    row = prep.impute(df, config).first()
    assert (row.bd, row.city, row.gender, row.registered_via) == (28.0, 1, 2, 9)


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([(5,), (3,), (5,), (3,), (9,), (None,)], "city int")
    assert values(prep.modes(df, ["city"]), "mode") == [3.0]


def test_refresh_keeps_other_settings(spark, tmp_path):
    df = one_feature(spark, [1.0, 2.0]).withColumns(
        {"bd": F.lit(30), "city": F.lit(4), "registered_via": F.lit(7)}
    )
    config = prep.fit_config(df, {"run_id": "x", "bd_median": 1.0})
    prep.save_config(spark, config, str(tmp_path / "config"))
    back = prep.load_config(spark, str(tmp_path / "config"))
    assert back["run_id"] == "x" and back["bd_median"] == 30.0 and back["num_cols_medians"]["total_secs"] == 1.5


def test_unknown_registration_is_in_neither_part(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2016, 5, 31)), ("b", dt.date(2016, 6, 1)), ("c", None)], "msno string, registration_init_time date"
    )
    early, late = prep.split_by_registration(df)
    assert values(early, "msno") == ["a"] and values(late, "msno") == ["b"]


def test_evaluation_without_positive_predictions(spark):
    scored = spark.createDataFrame([(1, 0.1), (0, 0.2)], "is_churn int, score double")
    row = evaluation.confusion(scored).first()
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)


def test_auc_does_not_depend_on_scale(spark):
    scored = spark.range(500).select(
        (F.col("id") % 3 == 0).cast("int").alias("is_churn"), (F.col("id") * 7 % 40 / 40.0).alias("score")
    )
    auc = lambda df: evaluation.auc(evaluation.threshold_counts(df)).first().auc_roc
    stretched = scored.withColumn("score", F.exp("score") * 3)
    assert auc(scored) == pytest.approx(auc(stretched))


def test_best_threshold_takes_the_lowest_of_equals(spark):
    curve = spark.createDataFrame([(0.2, 0.5), (0.4, 0.7), (0.6, 0.7)], "threshold double, f1 double")
    assert evaluation.best_threshold(curve).first().best_threshold == 0.4


# --- reports and metrics ---------------------------------------------------------


def test_empty_statistics(spark):
    row = reports.prediction_stats(spark.createDataFrame([], "is_churn int")).first()
    assert (row.total_predictions, row.churn_rate) == (0, 0.0)


def test_pages(spark):
    users = spark.createDataFrame([(DAY, f"u{i:02d}") for i in range(45)], "day date, msno string")
    page = reports.users_page(users, DAY, 3, 20).collect()
    assert [r.msno for r in page] == [f"u{i}" for i in range(40, 45)]
    assert (page[0].total, page[0].pages, page[0].page) == (45, 3, 3)


def test_search_text_is_not_a_pattern(spark):
    df = spark.createDataFrame([("a.B", 1), ("axb", 1), ("a.b", 0)], "msno string, is_churn int")
    assert values(reports.search_ids(df, "A.b"), "msno") == ["a.B"]
    assert values(reports.search_ids(df, "A.b", regex=True), "msno") == ["a.B", "axb"]


def test_reasons_stop_at_zero(spark):
    pairs = [("city", 0.5), ("bd", 0.0), ("gender", -0.2), ("total_secs", 0.9)]
    df = spark.createDataFrame(
        [("u", 1, pairs), ("v", 0, pairs)],
        "msno string, is_churn int, contributions array<struct<feature:string,value:double>>",
    )
    churn, stay = reports.top_reasons(df).collect()
    assert churn.reasons == [fixed.REASON_TEXTS["total_secs"][0], fixed.REASON_TEXTS["city"][0]]
    assert stay.reasons == [fixed.REASON_TEXTS["total_secs"][1], fixed.REASON_TEXTS["city"][1]]


def test_trailing_windows(spark):
    log = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 10),)], "ts timestamp_ntz")
    ends = sorted(values(rm.rate(log, width=60, every=15), "window_end"))
    assert ends == [dt.datetime(2024, 1, 1, 0, 0, 15) + dt.timedelta(seconds=15 * k) for k in range(4)]


def test_quantile_in_the_open_bucket(spark):
    log = spark.createDataFrame([(100.0,), (0.001,)], "d double").withColumn("path", F.lit("p"))
    buckets = rm.bucket_counts(log, "d", [0.5, 1.0], ["path"])
    assert rm.bucket_quantile(buckets, 0.99, ["path"]).first().quantile == 1.0
    assert math.isclose(rm.bucket_quantile(buckets, 0.25, ["path"]).first().quantile, 0.25)
