"""The streaming feature job: barrier, lateness, retries, restarts, folding."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from churnloom import fixed
from churnloom.operators import features
from churnloom.plans.workspace import Workspace
from churnloom.sources import messages as M
from churnloom.sources import tables
from churnloom.streaming import replay
from churnloom.streaming.feature_job import FeatureStream

D = [dt.date(2024, 1, d) for d in range(16, 22)]
LOG, PAID = fixed.LOG_TOPIC, fixed.TRANSACTION_TOPIC


@pytest.fixture(scope="module")
def baseline(spark):
    return tables.baseline_totals(Workspace(spark, "/root/testdata/sf0.001").baseline()).persist()


def log(day, user, secs=10.0):
    return (LOG, user, f'{{"msno":"{user}","date":"{day}","num_25":1,"total_secs":{secs}}}')


def paid(day, user, amount=5.0):
    return (PAID, user, f'{{"msno":"{user}","transaction_date":"{day}","actual_amount_paid":{amount},"is_cancel":1}}')


def end(day, topic, rows=None):
    sent = "" if rows is None else f',"_rows":{rows}'
    return (topic, fixed.MARKER_KEY, f'{{"_end_of_day":true,"date":"{day}"{sent}}}')


def both_ends(day):
    return [end(day, LOG), end(day, PAID)]


def batch(spark, rows):
    return spark.createDataFrame(rows, "topic string, key string, value string")


def job(spark, tmp_path, baseline, **options):
    return FeatureStream(spark, str(tmp_path / "tables"), baseline, **options)


def totals(stream):
    rows = stream.features().select("event_date", "msno", "total_log_days", "total_secs", "total_transactions")
    return sorted(tuple(r) for r in rows.collect())


def test_day_waits_for_both_topics(spark, tmp_path, baseline):
    s = job(spark, tmp_path, baseline)
    s.process(batch(spark, [log(D[0], "x"), end(D[0], LOG), end(D[0], LOG)]), 0)
    assert s.features().count() == 0
    s.process(batch(spark, [paid(D[0], "x"), paid(D[0], "y"), end(D[0], PAID)]), 1)
    assert totals(s) == [(D[0], "x", 1, 10.0, 1), (D[0], "y", 0, 0.0, 1)]
    assert [tuple(r) for r in s.day_status().collect()] == [(D[0], 1, 2)]


def test_late_rows_are_audited_and_left_out(spark, tmp_path, baseline):
    s = job(spark, tmp_path, baseline)
    s.process(batch(spark, [log(D[0], "x"), *both_ends(D[0])]), 0)
    s.process(batch(spark, [log(D[0], "x"), log(D[1], "x"), *both_ends(D[0]), *both_ends(D[1])]), 1)
    assert totals(s) == [(D[0], "x", 1, 10.0, 0), (D[1], "x", 2, 20.0, 0)]
    assert s.late().count() == 1 and s.day_status().count() == 2


def test_repeated_batch_changes_nothing(spark, tmp_path, baseline):
    s = job(spark, tmp_path, baseline)
    rows = [log(D[0], "x"), paid(D[0], "x"), *both_ends(D[0]), log(D[1], "x")]
    s.process(batch(spark, rows), 0)
    before = totals(s)
    s.process(batch(spark, rows), 0)
    assert totals(s) == before and s.late().count() == 0
    s.process(batch(spark, both_ends(D[1])), 1)
    assert totals(s)[-1] == (D[1], "x", 2, 20.0, 1)


def test_batch_that_failed_before_its_commit_is_repeated(spark, tmp_path, baseline):
    class Failing(FeatureStream):
        def _newest(self, work):
            raise RuntimeError("lost")

    rows = [log(D[0], "x"), *both_ends(D[0])]
    root = str(tmp_path / "tables")
    with pytest.raises(RuntimeError):
        Failing(spark, root, baseline).process(batch(spark, rows), 0)
    s = FeatureStream(spark, root, baseline)
    assert s.day_status().count() == 0
    s.process(batch(spark, rows), 0)
    assert totals(s) == [(D[0], "x", 1, 10.0, 0)] and s.latest().count() == 1


def test_open_days_are_flushed_at_the_end(spark, tmp_path, baseline):
    s = job(spark, tmp_path, baseline)
    s.process(batch(spark, [log(D[1], "x"), log(D[0], "x"), log(D[2], "x"), *both_ends(D[2])]), 0)
    assert s.finalize() == [D[0], D[1]]
    assert s.finalize() == []
    seq = {r.day: r.seq for r in s.day_status().collect()}
    assert seq == {D[2]: 1, D[0]: 2, D[1]: 3}
    assert totals(s) == [(D[0], "x", 2, 20.0, 0), (D[1], "x", 3, 30.0, 0), (D[2], "x", 1, 10.0, 0)]


def test_bad_messages_are_dropped(spark, tmp_path, baseline):
    s = job(spark, tmp_path, baseline)
    junk = [(LOG, "k", "not json"), (LOG, "k", '{"msno":"","date":"2024-01-16"}'), (LOG, "k", '{"msno":"z"}'),
            ("elsewhere", "k", '{"msno":"z","date":"2024-01-16"}'),
            (LOG, "x", '{"msno":"x","date":"2024-01-16T05:00:00","total_secs":NaN}')]
    s.process(batch(spark, [*junk, *both_ends(D[0])]), 0)
    assert totals(s) == [(D[0], "x", 1, 0.0, 0)]


@pytest.mark.parametrize("buckets", [1, 64])
def test_buckets_do_not_change_sums(spark, tmp_path, baseline, buckets):
    s = job(spark, tmp_path, baseline, buckets=buckets, keep_latest=False)
    for i, day in enumerate(D[:4]):
        s.process(batch(spark, [log(day, "x"), log(day, f"u{i}"), *both_ends(day)]), i)
    assert [t[2] for t in totals(s) if t[1] == "x"] == [1, 2, 3, 4]


def test_dry_run_publishes_nothing(spark, tmp_path, baseline):
    s = job(spark, tmp_path, baseline, dry_run=True)
    s.process(batch(spark, [log(D[0], "x"), *both_ends(D[0])]), 0)
    assert s.features().count() == 0 and s.latest() is None and s.day_status().count() == 1


def small_replay(spark):
    w = Workspace(spark, "/root/testdata/sf0.001")
    upto = F.col("day") <= F.lit(D[4])
    return w, w.messages().where(upto), upto


@pytest.mark.parametrize("files", [16, None])
def test_stream_equals_batch(spark, tmp_path, baseline, files):
    """The result does not depend on how the input falls into micro-batches."""
    w, sent, upto = small_replay(spark)
    folder = str(tmp_path / "messages")
    assert replay.replay(sent, replay.to_files(folder)) == D[:5]
    s = job(spark, tmp_path, baseline, buckets=5)
    s.run(M.stream_from_files(spark, folder, files), str(tmp_path / "checkpoint"))
    want = features.cumulative_features(w.delta().where(upto), baseline).drop("day")
    got = s.features().drop("event_date")
    rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in got.dtypes]
    got, want = got.select(*rounded), want.select(*rounded)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    newest = s.latest().agg(F.count("*"), F.max("event_timestamp")).first()
    assert newest[0] == want.select("msno").distinct().count() and newest[1].date() == D[4]


def test_restart_goes_on_where_it_stopped(spark, tmp_path, baseline):
    w, sent, upto = small_replay(spark)
    folder, checkpoint = str(tmp_path / "messages"), str(tmp_path / "checkpoint")
    replay.replay(sent.where(F.col("day") <= F.lit(D[1])), replay.to_files(folder))
    job(spark, tmp_path, baseline).run(M.stream_from_files(spark, folder), checkpoint, finalize=False)
    replay.replay(sent.where(F.col("day") > F.lit(D[1])), replay.to_files(folder))
    s = job(spark, tmp_path, baseline)
    s.run(M.stream_from_files(spark, folder), checkpoint)
    want = features.cumulative_features(w.delta().where(upto), baseline)
    assert s.features().agg(F.sum("total_log_days")).first() == want.agg(F.sum("total_log_days")).first()
    assert s.features().count() == want.count() and s.late().count() == 0


def test_dry_replay_sends_nothing(spark):
    _, sent, _ = small_replay(spark)
    assert replay.replay(sent.where(F.col("day") == F.lit(D[0])), replay.dry_run) == [D[0]]


def test_marker_that_overtakes_its_rows_waits(spark, tmp_path, baseline):
    s = job(spark, tmp_path, baseline)
    s.process(batch(spark, [end(D[0], LOG, 2), end(D[0], PAID, 1), log(D[0], "x")]), 0)
    assert s.features().count() == 0 and s.open_days() == [D[0]]
    s.process(batch(spark, [log(D[0], "x", 7.0)]), 1)
    assert s.features().count() == 0
    s.process(batch(spark, [paid(D[0], "y"), log(D[1], "x")]), 2)
    assert totals(s) == [(D[0], "x", 2, 17.0, 0), (D[0], "y", 0, 0.0, 1)]
    assert s.late().count() == 0 and s.open_days() == [D[1]]


def test_repeated_batch_does_not_count_twice(spark, tmp_path, baseline):
    s = job(spark, tmp_path, baseline)
    half = [end(D[0], LOG, 2), end(D[0], PAID, 0), log(D[0], "x")]
    s.process(batch(spark, half), 0)
    s.process(batch(spark, half), 0)
    assert s.features().count() == 0
    s.process(batch(spark, [log(D[0], "z")]), 1)
    assert totals(s) == [(D[0], "x", 1, 10.0, 0), (D[0], "z", 1, 10.0, 0)]


def test_every_message_is_counted(spark, tmp_path, baseline):
    s = job(spark, tmp_path, baseline)
    s.process(batch(spark, [log(D[0], "x"), *both_ends(D[0])]), 0)
    odd = [
        (LOG, "a", "no json"), (LOG, "b", None), (LOG, "c", '{"msno":"","date":"2024-01-17"}'),
        (LOG, "d", '{"msno":"z"}'), ("elsewhere", "e", '{"msno":"z","date":"2024-01-17"}'),
        (None, "f", '{"msno":"z","date":"2024-01-17"}'), (LOG, "g", '{"_end_of_day":true,"date":"soon"}'),
    ]
    s.process(batch(spark, [*odd, log(D[0], "x"), log(D[1], "x"), end(D[1], LOG)]), 1)
    s.process(batch(spark, []), 2)
    counts = sorted(tuple(r) for r in s.batches().select("batch", "messages", "valid", "rejected", "late", "markers").collect())
    assert counts == [(0, 3, 1, 0, 0, 2), (1, 10, 1, 7, 1, 1), (2, 0, 0, 0, 0, 0)]
    reasons = {r.key: r.reason for r in s.rejected().collect()}
    assert reasons == {
        "a": "unparsable", "b": "unparsable", "c": "no user", "d": "no day",
        "e": "unknown topic", "f": "unknown topic", "g": "no day",
    }
    assert [(r.key, r.reason) for r in s.late().collect()] == [("x", "day closed")]


def files_below(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*.parquet") if "_temporary" not in str(p))


def test_work_of_a_batch_does_not_grow_with_days(spark, tmp_path, baseline):
    """The last batch sees as many files of open days, state and done days as an early one."""
    s = job(spark, tmp_path, baseline, buckets=16)
    seen = []
    for i in range(12):
        day = dt.date(2024, 1, 16) + dt.timedelta(days=i)
        s.process(batch(spark, [log(day, "x"), *both_ends(day)]), i)
        root = tmp_path / "tables"
        seen.append({name: len(files_below(root / name)) for name in ("open", "ends", "flushed", "state", "work")})
    assert seen[-1] == seen[3] and seen[-1]["open"] == seen[-1]["ends"] == 0
    assert s.day_status().count() == 12 and s.features().count() == 12


def test_a_flush_rewrites_only_the_buckets_of_its_users(spark, tmp_path, baseline):
    s = job(spark, tmp_path, baseline, buckets=16)
    s.process(batch(spark, [*[log(D[0], f"u{i}") for i in range(200)], *both_ends(D[0])]), 0)
    s.process(batch(spark, [log(D[1], "u7"), log(D[1], "new"), *both_ends(D[1])]), 1)
    held = s.state.manifest(2)
    ids = spark.createDataFrame([("u7",), ("new",)], "msno string")
    touched = set(s.state.buckets_of(ids))
    assert {b for b, v in held.items() if v == 2} == touched and len(held) == 16
    found = s.latest(ids)
    assert len(found.inputFiles()) == len(touched) <= 2
    assert {r.msno: r.total_log_days for r in found.collect() if r.msno in ("u7", "new")} == {"u7": 2, "new": 1}
    assert s.latest().count() == 201
    assert {r.msno: r.feature_date for r in s.last_seen(ids).collect() if r.msno in ("u7", "u8")}["u7"] == D[1]
