"""Every operator as a query over the test tables.

``QUERIES[name](spark, sf_dir)`` gives a DataFrame with portable column types:
whole numbers as bigint, fractions rounded to six places, days and times as text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnloom import fixed
from churnloom.functions import scalars as S
from churnloom.operators import cleaning, days, evaluation, explanation, features, lookup, models
from churnloom.operators import drift as drift_ops
from churnloom.operators import preparation as prep
from churnloom.operators import reports
from churnloom.operators import request_metrics as rm
from churnloom.plans import scoring
from churnloom.plans.workspace import Workspace
from churnloom.session import scratch, stored
from churnloom.sources import messages as M
from churnloom.sources import pages, tables
from churnloom.sources.adapters import BASELINE_END, STREAM_START
from churnloom.streaming import aggregates, replay
from churnloom.streaming.feature_job import FeatureStream
from churnloom.streaming.progress import Progress, run_until_idle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DRIFT_DAY = date(2024, 1, 20)
STEP = fixed.SCRAPE_SECONDS


def portable(df: DataFrame) -> DataFrame:
    out = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        if kind in ("double", "float", "decimal"):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif kind in ("byte", "short", "integer", "long"):
            c = c.cast("bigint")
        elif kind in ("date", "timestamp", "timestamp_ntz"):
            c = c.cast("string")
        elif kind == "array":
            c = F.array_join(c, " | ")
        out.append(c.alias(field.name))
    return df.select(*out)


def query(make: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(make(Workspace(spark, sf_dir)))

    run.__doc__ = make.__doc__
    QUERIES[make.__name__] = run
    return make


# --- sources and sinks -------------------------------------------------------


@query
def scan_csv(w: Workspace) -> DataFrame:
    path = scratch(w.spark, "bronze")
    w.members_raw().write.option("header", True).csv(path)
    return tables.read_bronze(w.spark, path, "members")


@query
def scan_parquet(w: Workspace) -> DataFrame:
    return tables.read_table(
        w.spark, f"{w.sf_dir}/orders.parquet", ["o_custkey", "o_orderstatus", "o_totalprice"]
    )


@query
def overwrite_table(w: Workspace) -> DataFrame:
    """A table replaced by another one."""
    path = scratch(w.spark, "replaced")
    tables.write_table(w.members_raw(), path)
    tables.write_table(w.silver_members(), path)
    return tables.read_table(w.spark, path)


@query
def offline_table(w: Workspace) -> DataFrame:
    """The catalog table that the feature store reads, replaced once."""
    name = f"offline_{uuid.uuid4().hex}"
    tables.publish_offline(w.baseline().limit(1), name)
    tables.publish_offline(w.baseline(), name)
    return _taken(w, tables.baseline_totals(w.spark.table(name)), name)


def _taken(w: Workspace, rows: DataFrame, name: str) -> DataFrame:
    """Rows read from a catalog table, which is dropped then."""
    kept = stored(rows, "taken")
    w.spark.sql(f"DROP TABLE {name}")
    return kept


@query
def create_table(w: Workspace) -> DataFrame:
    """The streaming feature table, made where it is absent and left alone where it is there."""
    name = f"features_{uuid.uuid4().hex}"
    tables.ensure_feature_table(w.spark, name)
    rows = w.feature_table()
    rows.select(*w.spark.table(name).columns).write.insertInto(name)
    tables.ensure_feature_table(w.spark, name)
    found = w.spark.table(name).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("total_log_days").alias("total_log_days")
    )
    return _taken(w, found, name)


@query
def bronze_versions(w: Workspace) -> DataFrame:
    """All raw files in one call per table, each version with its own order of columns and
    some with values that do not parse: rows, a checksum, unparsable values."""
    files = {
        "members": [w.members_raw()],
        "transactions": [w.transactions_raw(1), w.transactions_raw(2)],
        "user_logs": [w.user_logs_raw(), w.user_logs_raw()],
        "train": [w.train_raw(1), w.train_raw(2)],
    }
    number = {
        "members": "registration_init_time", "transactions": "transaction_date", "user_logs": "num_25",
        "train": "is_churn",
    }
    found = []
    for name, versions in files.items():
        root = scratch(w.spark, "bronze")
        for k, rows in enumerate(versions):
            # A version may have its columns in another order, and more of them.
            columns = rows.columns[::-1] if k else rows.columns
            odd = F.when(F.col("msno").endswith("7"), "n/a").otherwise(F.col(number[name]).cast("string"))
            rows = rows.withColumn(number[name], odd).select(*columns, *([F.lit("x").alias("note")] if k else []))
            rows.write.option("header", True).csv(f"{root}/v{k}")
        read = tables.read_bronze(w.spark, [f"{root}/v{k}" for k in range(len(versions))], name, count_bad=True)
        found.append(
            read.agg(
                F.count(F.lit(1)).alias("row_count"),
                F.sum(number[name]).alias("checksum"),
                F.sum(F.size(tables.UNPARSABLE)).alias("unparsable"),
            ).withColumn("table_name", F.lit(name))
        )
    return reduce(DataFrame.unionByName, found)


@query
def export_csv(w: Workspace) -> DataFrame:
    path = scratch(w.spark, "export")
    tables.export_scores(w.score_log(), path)
    back = w.spark.read.option("header", True).csv(path)
    return back.withColumn("is_churn", F.col("is_churn").cast("bigint"))


@query
def score_log_stats(w: Workspace) -> DataFrame:
    """Two runs into the score log, one of them repeated."""
    path = scratch(w.spark, "scores")
    odd = F.col("prediction_id") % 2 == 1
    for run, part in (("a", odd), ("b", ~odd), ("a", odd)):
        scoring.append_scores(w.score_log().where(part), path, run, "2024-01-20T10:00:00Z")
    return reports.prediction_stats(w.spark.read.parquet(path))


@query
def encoded_fields(w: Workspace) -> DataFrame:
    """The fields of the encoded messages, taken from their JSON text."""
    value = lambda name: F.get_json_object("value", f"$.{name}")
    return w.messages().select(
        "topic",
        value("msno").alias("msno"),
        F.coalesce(value("date"), value("transaction_date")).alias("day_text"),
        *[value(c).cast("bigint").alias(c) for c in ("num_25", "num_unq", "is_auto_renew", "is_cancel")],
        *[value(c).cast("double").alias(c) for c in ("total_secs", "actual_amount_paid")],
    )


@query
def write_partitioned(w: Workspace) -> DataFrame:
    path = scratch(w.spark, "by_day")
    tables.write_by_day(w.silver_logs(), path, "date")
    return tables.read_table(w.spark, path).groupBy("date").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("total_secs").alias("total_secs")
    )


@query
def stream_append(w: Workspace) -> DataFrame:
    """Append the daily features twice: the retry must not double a day."""
    path = scratch(w.spark, "appended")
    rows = w.feature_table().drop("event_date")
    tables.append_features(rows, path)
    tables.append_features(rows.where(F.col("event_timestamp") >= F.lit(DRIFT_DAY)), path)
    return w.spark.read.parquet(path).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("total_log_days").alias("total_log_days")
    )


@query
def baseline_scan(w: Workspace) -> DataFrame:
    return tables.baseline_totals(w.baseline())


@query
def replay_source(w: Workspace) -> DataFrame:
    return replay.sent_counts(w.spark, w.message_folder())


@query
def encode_messages(w: Workspace) -> DataFrame:
    return w.messages().select("topic", "key", "value")


@query
def decode_messages(w: Workspace) -> DataFrame:
    decoded = M.decode(w.messages().select("topic", "key", "value"))
    return decoded.select(
        "topic",
        "msno",
        F.coalesce("date", "transaction_date").alias("day_text"),
        "num_25",
        "num_unq",
        "total_secs",
        "actual_amount_paid",
        "is_auto_renew",
        "is_cancel",
    )


@query
def materialize_latest(w: Workspace) -> DataFrame:
    """Push two overlapping ranges one after the other."""
    first = lookup.materialize(None, w.feature_table(), datetime(2024, 1, 16), datetime(2024, 1, 24))
    return lookup.materialize(first, w.feature_table(), datetime(2024, 1, 20), datetime(2024, 1, 28))


@query
def import_ids(w: Workspace) -> DataFrame:
    """A list with an untidy header and blank ids."""
    path = scratch(w.spark, "ids")
    key = F.col("c_custkey")
    padded = F.when(key % 9 == 0, "   ").otherwise(F.concat(F.lit(" "), key.cast("string"), F.lit(" ")))
    w.table("customer").select(padded.alias(" 'MSNO' "), F.col("c_name").alias("Name")).write.option(
        "header", True
    ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return tables.read_ids(w.spark, path)


@query
def sample_keys(w: Workspace) -> DataFrame:
    hashed = F.base64(F.unhex(F.sha2("msno", 256)))
    return tables.sample_ids(w.feature_table().select(hashed.alias("msno")), n=5)


@query
def day_slice(w: Workspace) -> DataFrame:
    return tables.day_slice(w.feature_table(), DRIFT_DAY, ["msno", *fixed.NUMERIC_FEATURES])


# --- projections and filters -----------------------------------------------


@query
def parse_dates(w: Workspace) -> DataFrame:
    """Valid days, and days broken by adding 15 to the day of month."""
    day = F.col("transaction_date")
    both = w.transactions_raw(1).unionByName(w.transactions_raw(2))
    return both.select(
        "msno",
        day.alias("day_number"),
        S.day_from_int(day).alias("parsed"),
        S.day_from_int(day + 15).alias("shifted"),
        S.day_from_text(S.day_from_int(day).cast("string")).alias("from_text"),
    )


@query
def clean_members(w: Workspace) -> DataFrame:
    return cleaning.clean_members(w.members_raw())


@query
def replay_filter(w: Workspace) -> DataFrame:
    logs = w.silver_logs()
    return M.since(logs, "date", STREAM_START).select("msno", "date", "total_secs", "num_unq")


def _event_messages(w: Workspace) -> DataFrame:
    """Events as messages of mixed quality: blank users, missing days, unknown
    topics and control records."""
    event = F.col("event_id")
    purchase = F.col("event_type") == "purchase"
    day = F.when(event % 13 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    record = F.struct(
        F.when(event % 17 == 0, True).alias("_end_of_day"),
        F.when(event % 11 == 0, "").otherwise(F.col("user_id").cast("string")).alias("msno"),
        F.when(~purchase | (event % 17 == 0), day).alias("date"),
        F.when(purchase, day).alias("transaction_date"),
    )
    topic = (
        F.when(purchase, fixed.TRANSACTION_TOPIC)
        .when(F.col("event_type") == "error", "other")
        .otherwise(fixed.LOG_TOPIC)
    )
    return w.table("events").select(
        topic.alias("topic"), F.col("user_id").cast("string").alias("key"), F.to_json(record).alias("value")
    )


@query
def valid_records(w: Workspace) -> DataFrame:
    valid = M.data_records(M.decode(_event_messages(w)))
    return valid.groupBy("day", "msno").agg(F.count(F.lit(1)).alias("records"))


@query
def route_topics(w: Workspace) -> DataFrame:
    valid = M.data_records(M.decode(_event_messages(w)))
    logs = M.log_records(valid).select("day", F.lit("logs").alias("route"))
    paid = M.transaction_records(valid).select("day", F.lit("transactions").alias("route"))
    return logs.unionByName(paid).groupBy("day", "route").agg(F.count(F.lit(1)).alias("records"))


@query
def split_control(w: Workspace) -> DataFrame:
    decoded = M.decode(_event_messages(w))
    control = M.control_records(decoded).groupBy("topic").agg(F.count(F.lit(1)).alias("records"))
    data = M.data_records(decoded).groupBy("topic").agg(F.count(F.lit(1)).alias("records"))
    return control.withColumn("kind", F.lit("control")).unionByName(
        data.withColumn("kind", F.lit("data"))
    )


def _mixed_batches(w: Workspace) -> FeatureStream:
    """Events of mixed quality in two batches; the first closes a day, for which the second
    has late rows."""
    job = w.small_job("mixed")
    messages = _event_messages(w)
    day = F.coalesce(F.get_json_object("value", "$.date"), F.get_json_object("value", "$.transaction_date"))
    early = F.coalesce(day < F.lit(STREAM_START.isoformat()), F.lit(True)) & (F.hash("value") % 2 == 0)
    ends = M.markers(w.spark.range(1).select(F.lit(BASELINE_END).alias("day")))
    job.process(messages.where(early).unionByName(ends), 0)
    job.process(messages.where(~early), 1)
    return job


@query
def rejected_rows(w: Workspace) -> DataFrame:
    """Messages that are no records, by topic and reason."""
    rejected = w.once("mixed", _mixed_batches).rejected()
    return rejected.groupBy("topic", "reason").agg(F.count(F.lit(1)).alias("messages"))


@query
def batch_counts(w: Workspace) -> DataFrame:
    """What became of all messages: valid or late, rejected, markers; none is lost."""
    counts = w.once("mixed", _mixed_batches).batches()
    kept = F.sum(F.col("valid") + F.col("late"))
    whole = F.col("messages") == F.col("valid") + F.col("rejected") + F.col("late") + F.col("markers")
    return counts.agg(
        F.sum("messages").alias("messages"), kept.alias("records"), F.sum("rejected").alias("rejected"),
        F.sum("markers").alias("markers"), F.bool_and(whole).alias("adds_up"),
    )


@query
def counted_days(w: Workspace) -> DataFrame:
    """Markers one batch ahead of half their records; none may be missing from its day."""
    job = w.small_job("counted")
    sent = w.sent()
    counts = sent.groupBy("day", "topic").agg(F.count(F.lit(1)).alias("records"))
    ends = M.markers(sent.select("day").distinct(), counts=counts)
    first = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    messages = sent.drop("day")
    job.process(messages.where(first).unionByName(ends), 0)
    job.process(messages.where(~first), 1)
    per_day = job.features().groupBy(F.col("event_date").alias("day")).agg(
        F.count(F.lit(1)).alias("users"), F.sum("total_log_days").alias("log_days")
    )
    return per_day.join(job.day_status().select("day", "seq"), "day")


@query
def stream_restart(w: Workspace) -> DataFrame:
    """A job that is stopped after the first days and goes on with a new one."""
    root = scratch(w.spark, "restart")
    sent = w.sent()
    for part in (F.col("day") <= F.lit(DRIFT_DAY), F.col("day") > F.lit(DRIFT_DAY)):
        replay.replay(sent.where(part), replay.to_files(f"{root}/messages"))
        job = FeatureStream(w.spark, f"{root}/tables", w.baseline(), buckets=4)
        job.run(M.stream_from_files(w.spark, f"{root}/messages"), f"{root}/checkpoint")
    return job.features().groupBy("event_date").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("total_log_days").alias("total_log_days")
    )


@query
def stream_dry_run(w: Workspace) -> DataFrame:
    """Every day computed and none published."""
    job = w.small_job("dry", dry_run=True)
    sent = w.sent()
    job.process(sent.drop("day").unionByName(M.markers(sent.select("day").distinct())), 0)
    published = job.features().count()
    return job.day_status().withColumn("published", F.lit(published))


def _watched(w: Workspace, name: str, **trigger) -> tuple[Progress, bool]:
    """A query over the message files that counts them; stopped when it is idle."""
    watch = Progress(name)
    w.spark.streams.addListener(watch)
    try:
        source = M.stream_from_files(w.spark, w.message_folder(), files_per_trigger=100)
        run = (
            source.groupBy("topic").count().writeStream.outputMode("update").format("noop").queryName(name)
            .option("checkpointLocation", f"{scratch(w.spark, name)}/checkpoint").trigger(**trigger).start()
        )
        stopped = run_until_idle(run, watch, idle_seconds=3.0)
        run.awaitTermination()
        # Events of the last batches may still be on their way.
        w.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        w.spark.streams.removeListener(watch)
    return watch, stopped


@query
def stream_progress(w: Workspace) -> DataFrame:
    """Progress rows of a query over all messages, added up."""
    watch, _ = _watched(w, "progress", availableNow=True)
    rows = watch.table(w.spark)
    return rows.groupBy("query").agg(F.sum("input_rows").alias("input_rows"))


@query
def idle_stop(w: Workspace) -> DataFrame:
    """A continuous query that has read everything and is stopped then."""
    watch, stopped = _watched(w, "idle", processingTime="500 milliseconds")
    rows = watch.table(w.spark).agg(F.sum("input_rows").alias("input_rows"))
    return rows.withColumn("stopped", F.lit(stopped))


@query
def oot_split(w: Workspace) -> DataFrame:
    early, late = prep.split_by_registration(w.baseline())
    return (
        early.withColumn("part", F.lit("train"))
        .unionByName(late.withColumn("part", F.lit("test")))
        .select("msno", "part", "registration_init_time", "is_churn")
    )


@query
def feature_matrix(w: Workspace) -> DataFrame:
    return prep.feature_matrix(prep.impute(w.baseline(), w.config(), "zero"))


@query
def search_churned(w: Workspace) -> DataFrame:
    plain = reports.search_ids(w.score_log(), "14").withColumn("form", F.lit("text"))
    pattern = reports.search_ids(w.score_log(), "^1.*4$", regex=True).withColumn("form", F.lit("regex"))
    return plain.unionByName(pattern).select("form", "prediction_id", "msno", "churn_probability")


# --- deduplication and set operations ------------------------------------------


@query
def union_versions(w: Workspace) -> DataFrame:
    return cleaning.union_versions(w.transactions_raw(1), w.transactions_raw(2))


@query
def silver_transactions(w: Workspace) -> DataFrame:
    return w.silver_transactions()


@query
def silver_logs(w: Workspace) -> DataFrame:
    return w.silver_logs()


@query
def silver_members(w: Workspace) -> DataFrame:
    return w.silver_members()


@query
def silver_train(w: Workspace) -> DataFrame:
    return w.silver_train()


# --- batch features ----------------------------------------------------------


@query
def txn_features(w: Workspace) -> DataFrame:
    return features.transaction_features(w.silver_transactions())


@query
def log_features(w: Workspace) -> DataFrame:
    return features.log_features(w.silver_logs())


@query
def gold_features(w: Workspace) -> DataFrame:
    return w.gold()


@query
def gold_features_as_of(w: Workspace) -> DataFrame:
    return w.gold(BASELINE_END)


# --- daily and running features ----------------------------------------------


@query
def daily_log_delta(w: Workspace) -> DataFrame:
    return features.daily_log_delta(w.day_logs())


@query
def daily_txn_delta(w: Workspace) -> DataFrame:
    return features.daily_transaction_delta(w.day_transactions())


@query
def daily_delta(w: Workspace) -> DataFrame:
    return w.delta()


@query
def cumulative_features(w: Workspace) -> DataFrame:
    return w.cumulative().drop("day")


@query
def totals_after(w: Workspace) -> DataFrame:
    return features.totals_after(w.delta(), tables.baseline_totals(w.baseline()))


@query
def active_users(w: Workspace) -> DataFrame:
    return features.active_users(w.day_logs(), w.day_transactions())


@query
def active_user_counts(w: Workspace) -> DataFrame:
    return features.active_user_counts(features.active_users(w.day_logs(), w.day_transactions()))


@query
def replay_counts(w: Workspace) -> DataFrame:
    return days.replay_counts(w.day_logs(), w.day_transactions())


@query
def replay_progress(w: Workspace) -> DataFrame:
    return days.replay_progress(w.day_logs(), fixed.REPLAY_DAYS)


@query
def ready_days(w: Workspace) -> DataFrame:
    return days.ready_days(M.control_records(M.decode(w.control_messages())))


@query
def pending_days(w: Workspace) -> DataFrame:
    ready = days.ready_days(M.control_records(M.decode(w.control_messages())))
    buffered = M.data_records(M.decode(w.messages().select("topic", "key", "value")))
    return days.pending_days(buffered, ready)


@query
def flush_once(w: Workspace) -> DataFrame:
    ready = days.ready_days(M.control_records(M.decode(w.control_messages())))
    done = ready.where(F.col("day") <= F.lit(DRIFT_DAY))
    return days.flush_once(ready.unionByName(ready), done)


@query
def txn_only_days(w: Workspace) -> DataFrame:
    paid = w.silver_transactions().select(F.col("transaction_date").alias("day"))
    return days.transaction_only_days(w.silver_logs().select(F.col("date").alias("day")), paid)


# --- feature store -------------------------------------------------------------


@query
def asof_features(w: Workspace) -> DataFrame:
    """A request per event, at its own time, against the daily features."""
    requests = w.table("events").select(
        "event_id", F.col("user_id").cast("string").alias("msno"), F.col("ts").alias("request_time")
    )
    wanted = w.feature_table().select(
        "msno", "event_timestamp", "city", "total_transactions", "total_secs", "avg_daily_secs"
    )
    return lookup.asof_features(requests, wanted).drop("request_time")


@query
def asof_features_ttl(w: Workspace) -> DataFrame:
    """The same with features that are good for two days only."""
    requests = w.table("events").select(
        "event_id", F.col("user_id").cast("string").alias("msno"), F.col("ts").alias("request_time")
    )
    wanted = w.feature_table().select("msno", "event_timestamp", "total_secs")
    return lookup.asof_features(requests, wanted, timedelta(days=2)).drop("request_time")


@query
def score_lookup(w: Workspace) -> DataFrame:
    requests = w.table("customer").select(F.col("c_custkey").cast("string").alias("msno"))
    newest = w.newest(requests)
    seen = newest.select("msno", F.to_date("event_timestamp").alias("feature_date"))
    got = lookup.lookup(requests, newest, seen)
    return got.select("msno", "city", "total_secs", "total_num_unq", "feature_date", "member_found")


@query
def last_seen(w: Workspace) -> DataFrame:
    return lookup.last_seen(w.feature_table())


# --- preparation ---------------------------------------------------------------


@query
def impute_stats(w: Workspace) -> DataFrame:
    return prep.impute_stats(w.baseline())


@query
def impute_features(w: Workspace) -> DataFrame:
    return prep.impute(w.baseline(), w.config(), "zero").select("msno", *fixed.FEATURES)


@query
def impute_serving(w: Workspace) -> DataFrame:
    return prep.impute(w.baseline(), w.config(), "median").select("msno", *fixed.FEATURES)


@query
def cold_start(w: Workspace) -> DataFrame:
    """Everyone in the customer table, most without any feature row."""
    requests = w.table("customer").select(F.col("c_custkey").cast("string").alias("msno"))
    found = lookup.lookup(requests, w.latest())
    return prep.impute(found, w.config(), "median").select("msno", "member_found", *fixed.FEATURES)


@query
def label_rates(w: Workspace) -> DataFrame:
    return prep.label_rates(w.baseline())


@query
def class_weight(w: Workspace) -> DataFrame:
    return prep.class_weight(w.silver_train())


@query
def null_audit(w: Workspace) -> DataFrame:
    """Nulls as they come and after filling."""
    filled = prep.impute(w.baseline(), w.config(), "zero")
    raw = prep.null_audit(w.baseline()).withColumn("stage", F.lit("raw"))
    return raw.unionByName(prep.null_audit(filled).withColumn("stage", F.lit("filled")))


# --- models --------------------------------------------------------------------


def _scored(w: Workspace, name: str) -> DataFrame:
    scored = models.score(w.parts()[1], w.candidate(name))
    return scored.select("msno", "is_churn", "churn_probability")


@query
def train_gbt(w: Workspace) -> DataFrame:
    scored = models.score(w.parts()[1], w.artefacts().model)
    return scored.select("msno", "is_churn", "churn_probability")


@query
def train_lr(w: Workspace) -> DataFrame:
    return _scored(w, "Logistic Regression")


@query
def train_rf(w: Workspace) -> DataFrame:
    return _scored(w, "Random Forest")


@query
def train_gbt_baseline(w: Workspace) -> DataFrame:
    return _scored(w, "Gradient Boosting")


@query
def train_mlp(w: Workspace) -> DataFrame:
    return _scored(w, "Neural Network (MLP)")


@query
def compare_models(w: Workspace) -> DataFrame:
    return models.compare(*w.parts(), {name: w.candidate(name) for name in models.candidates()})


@query
def train_checks(w: Workspace) -> DataFrame:
    """Per model: scored users of the later part, and those with a probability."""
    fitted = {"Main": w.artefacts().model} | {n: w.candidate(n) for n in models.candidates()}
    valid = F.count_if(F.col("churn_probability").between(0, 1))
    found = [
        models.score(w.parts()[1], model)
        .agg(F.count(F.lit(1)).alias("row_count"), valid.alias("valid_count"))
        .withColumn("model", F.lit(name))
        for name, model in fitted.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query
def compare_checks(w: Workspace) -> DataFrame:
    """The measures of the comparison and whether they are in range."""
    measured = compare_models(w)
    bounded = F.col("value").between(0, 1) | ((F.col("metric") == "log_loss") & (F.col("value") >= 0))
    # A part without users has no measures.
    return measured.groupBy("model", "part").agg(
        F.count(F.lit(1)).alias("measures"),
        F.bool_and(bounded | F.col("value").isNull()).alias("in_range"),
    )


@query
def importance_checks(w: Workspace) -> DataFrame:
    return feature_importance(w).agg(
        F.count_distinct("feature").alias("features"), F.round(F.sum("importance"), 4).alias("total")
    )


@query
def score_checks(w: Workspace) -> DataFrame:
    """Both ways of scoring: found or not, flag as the threshold says, at most 3 reasons."""
    found = []
    for kind, scored in (("batch", score_batch(w)), ("users", score_users(w))):
        flag = (F.col("churn_probability") >= fixed.CHURN_THRESHOLD).cast("int") == F.col("is_churn").cast("int")
        found.append(
            scored.select(
                F.lit(kind).alias("kind"),
                "msno",
                "member_found",
                flag.alias("flag_agrees"),
                (F.size("reasons") <= 3).alias("few_reasons"),
            )
        )
    return found[0].unionByName(found[1])


@query
def saved_model(w: Workspace) -> DataFrame:
    """A model and its settings loaded from where they were saved score as before."""
    kept = w.artefacts()
    loaded = scoring.load(w.spark, kept.path)
    old = scoring.score_batch(_customers(w), w.latest(), kept).select("msno", "churn_probability")
    new = scoring.score_batch(_customers(w), w.latest(), loaded).select(
        "msno", F.col("churn_probability").alias("p")
    )
    same = F.count_if(F.col("churn_probability") == F.col("p"))
    return old.join(new, "msno").agg(F.count(F.lit(1)).alias("user_count"), same.alias("same_score"))


@query
def run_log(w: Workspace) -> DataFrame:
    """Measures of two runs, as the log gives them back."""
    path = scratch(w.spark, "runs")
    measured = evaluation.metrics(w.labelled_scores(), score="score")
    for run in ("a", "b"):
        models.log_run(w.spark, path, run, measured)
    rows = w.spark.read.parquet(path).where(F.col("name").isin("auc_roc", "auc_pr", "log_loss"))
    return rows.select("run_id", "name", F.col("value").cast("double").alias("value"))


@query
def event_times(w: Workspace) -> DataFrame:
    """Given times are kept, missing and empty ones are the time of the run."""
    given = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm")).when(
        F.col("event_id") % 3 == 1, ""
    )
    timed = w.table("events").select(given.alias("given"), S.event_time_or_now(given).alias("time"))
    return timed.agg(
        F.count_if(F.col("time") == F.col("given")).alias("kept"),
        F.count_if(F.col("time").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d UTC$")).alias("now"),
    )


@query
def feature_importance(w: Workspace) -> DataFrame:
    return models.feature_importance(w.spark, w.artefacts().model)


# --- evaluation ----------------------------------------------------------------


@query
def eval_auc(w: Workspace) -> DataFrame:
    return evaluation.auc(evaluation.threshold_counts(w.labelled_scores()))


@query
def eval_ap(w: Workspace) -> DataFrame:
    return evaluation.average_precision(evaluation.threshold_counts(w.labelled_scores()))


@query
def eval_logloss(w: Workspace) -> DataFrame:
    return evaluation.log_loss(w.labelled_scores())


@query
def eval_confusion(w: Workspace) -> DataFrame:
    return evaluation.confusion(w.labelled_scores(), 0.5)


@query
def pr_curve(w: Workspace) -> DataFrame:
    return evaluation.pr_curve(evaluation.threshold_counts(w.labelled_scores()))


@query
def best_threshold(w: Workspace) -> DataFrame:
    return evaluation.best_threshold(
        evaluation.pr_curve(evaluation.threshold_counts(w.labelled_scores()))
    )


@query
def class_report(w: Workspace) -> DataFrame:
    return evaluation.class_report(w.labelled_scores(), 0.5)


@query
def roc_curve(w: Workspace) -> DataFrame:
    return evaluation.roc_curve(evaluation.threshold_counts(w.labelled_scores()))


# --- scoring and explanation -----------------------------------------------------


def _customers(w: Workspace) -> DataFrame:
    return w.table("customer").select(F.col("c_custkey").cast("string").alias("msno"))


@query
def score_batch(w: Workspace) -> DataFrame:
    scored = scoring.score_batch(_customers(w), w.latest(), w.artefacts())
    return scoring.batch_response(scored)


@query
def score_users(w: Workspace) -> DataFrame:
    seen = lookup.last_seen(w.feature_table())
    return scoring.score_users(_customers(w), w.latest(), seen, w.artefacts())


@query
def shap_values(w: Workspace) -> DataFrame:
    explained = scoring.explain_users(_customers(w), w.latest(), w.artefacts())
    # An outer generator: the plain one adds a filter that ranks each row again.
    return explained.select("msno", "base_value", F.inline_outer("contributions"))


@query
def shap_additivity(w: Workspace) -> DataFrame:
    """Largest gap between base plus contributions and the model's log-odds."""
    art = w.artefacts()
    scored = models.score(scoring.prepared(_customers(w), w.latest(), art), art.model)
    summed = explanation.explain(scored, art.model, f"{art.path}/model", ["msno", "churn_probability"])
    margin = F.aggregate("contributions", F.col("base_value"), lambda acc, x: acc + x["value"])
    gap = F.abs(1 / (1 + F.exp(-margin)) - F.col("churn_probability"))
    return summed.agg(
        F.count(F.lit(1)).alias("user_count"), F.round(F.max(gap), 6).alias("largest_gap")
    )


@query
def top_reasons(w: Workspace) -> DataFrame:
    return reports.top_reasons(w.contributions()).select("msno", "is_churn", "reasons")


@query
def shap_ranked(w: Workspace) -> DataFrame:
    ranked = reports.ranked_contributions(w.contributions(), 8)
    return ranked.select("msno", F.posexplode_outer("contributions").alias("pos", "c")).select(
        "msno", "pos", "c.feature", "c.value", "c.magnitude"
    )


# --- reports ---------------------------------------------------------------------


@query
def threshold_label(w: Workspace) -> DataFrame:
    p = F.col("churn_probability")
    return w.score_log().select(
        "prediction_id",
        S.churn_flag(p).alias("flag_default"),
        S.churn_flag(p, 500 / 999.0).alias("flag_on_a_score"),
    )


@query
def prediction_stats(w: Workspace) -> DataFrame:
    return reports.prediction_stats(w.score_log())


@query
def batch_summary(w: Workspace) -> DataFrame:
    return reports.batch_summary(w.score_log().where("endpoint = '/predict/batch'"), 0.15)


@query
def score_hist(w: Workspace) -> DataFrame:
    fine = reports.score_histogram(w.score_log(), 20).withColumn("bins", F.lit(20))
    return fine.unionByName(reports.score_histogram(w.score_log(), 25).withColumn("bins", F.lit(25)))


@query
def churn_history(w: Workspace) -> DataFrame:
    return reports.churn_history(w.score_log()).select("prediction_id", "msno", "churn_probability")


@query
def churned_top(w: Workspace) -> DataFrame:
    return reports.churned_top(w.score_log()).select(
        "prediction_id", "msno", "churn_probability"
    )


@query
def batch_top_risks(w: Workspace) -> DataFrame:
    batch = w.score_log().where("endpoint = '/predict/batch'")
    return reports.batch_top_risks(batch).select("prediction_id", "msno", "churn_probability")


def _page_index(w: Workspace) -> str:
    path = scratch(w.spark, "pages")
    # Small ranges, so that pages cross their borders here too.
    pages.write_days(features.active_users(w.day_logs(), w.day_transactions()), path, size=25)
    return path


@query
def users_page(w: Workspace) -> DataFrame:
    """A page from the ranges it lies in."""
    return pages.read_page(w.spark, w.once("pages", _page_index), DRIFT_DAY, page=2, size=20)


@query
def users_page_deep(w: Workspace) -> DataFrame:
    """A later page of another size, by rank over all users of the day."""
    users = features.active_users(w.day_logs(), w.day_transactions())
    return reports.users_page(users, DRIFT_DAY, page=4, size=7)


@query
def format_scores(w: Workspace) -> DataFrame:
    hashed = F.base64(F.unhex(F.sha2("msno", 256)))
    scores = w.score_log().withColumn("msno", F.when(F.col("prediction_id") % 2 == 0, hashed).otherwise(F.col("msno")))
    return reports.format_scores(scores).select("prediction_id", "short_id", "probability_text")


# --- drift -----------------------------------------------------------------------


@query
def drift_baseline(w: Workspace) -> DataFrame:
    return drift_ops.drift_baseline(w.baseline())


@query
def drift_psi(w: Workspace) -> DataFrame:
    return drift_ops.drift_psi(w.baseline_bins(), w.feature_table())


@query
def drift_ks(w: Workspace) -> DataFrame:
    return drift_ops.drift_ks(w.baseline(), w.feature_table())


@query
def drift_ks_pvalue(w: Workspace) -> DataFrame:
    return w.drift().select("event_date", "feature", "ks_pvalue", "ks_drift")


@query
def drift_ks_exact(w: Workspace) -> DataFrame:
    """P-values by counting orders of the pooled values."""
    found = drift_ops.drift_ks(w.baseline(), w.feature_table())
    exact = drift_ops.exact_ks_pvalue(F.col("ks_stat"), F.col("ref_n"), F.col("cur_n"))
    return found.select("event_date", "feature", exact.alias("ks_pvalue"))


@query
def drift_summary(w: Workspace) -> DataFrame:
    return drift_ops.drift_summary(w.drift())


@query
def drift_detail(w: Workspace) -> DataFrame:
    known = drift_ops.drift_detail(w.drift(), F.lit(DRIFT_DAY))
    return known.unionByName(drift_ops.drift_detail(w.drift(), F.lit(date(2024, 3, 1))))


@query
def drift_overview(w: Workspace) -> DataFrame:
    return drift_ops.drift_overview(drift_ops.drift_summary(w.drift()))


# --- streaming -------------------------------------------------------------------


@query
def stream_features(w: Workspace) -> DataFrame:
    return w.stream().features().drop("event_date")


@query
def stream_latest(w: Workspace) -> DataFrame:
    return w.stream().latest().select("msno", "event_timestamp", "total_transactions", "total_secs")


@query
def late_rows(w: Workspace) -> DataFrame:
    return w.stream().late().groupBy("day", "topic").agg(F.count(F.lit(1)).alias("late_rows"))


@query
def day_status(w: Workspace) -> DataFrame:
    return w.stream().day_status()


@query
def stream_drift(w: Workspace) -> DataFrame:
    return w.stream().drift().select("event_date", "feature", "psi", "level", "ks_stat")


@query
def stream_daily(w: Workspace) -> DataFrame:
    """Native daily windows over the event file as a stream."""
    root = scratch(w.spark, "daily")
    events = (
        w.spark.readStream.schema(w.table("events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(w.sf_dir)
        .withColumn("ts", S.utc_instant("ts"))
    )
    run = aggregates.keep_updates(
        aggregates.daily_activity(events), f"{root}/rows", f"{root}/checkpoint"
    )
    run.awaitTermination()
    newest = aggregates.newest_updates(w.spark, f"{root}/rows", ["day_start", "user_id"])
    return newest.withColumn("day_start", F.to_date(S.utc_wall_time("day_start")))


@query
def stream_prediction_stats(w: Workspace) -> DataFrame:
    """Running counters over the events read as a stream of scores."""
    root = scratch(w.spark, "counters")
    events = (
        w.spark.readStream.schema(w.table("events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(w.sf_dir)
    )
    p = F.col("event_id") * 7919 % 1000 / 999.0
    scores = events.select(S.churn_flag(p).alias("is_churn"))
    aggregates.prediction_counters(scores, f"{root}/rows", f"{root}/checkpoint").awaitTermination()
    return aggregates.current_counters(w.spark, f"{root}/rows")


# --- request metrics ---------------------------------------------------------------


@query
def req_rate(w: Workspace) -> DataFrame:
    return rm.rate_by_each(w.request_log(), ["path", "status_code"], every=STEP).drop("label_of")


@query
def error_rate(w: Workspace) -> DataFrame:
    failed = F.col("status_code").startswith("5")
    minute = rm.share(w.request_log(), failed, width=60, every=STEP).withColumn("width", F.lit(60))
    five = rm.share(w.request_log(), failed, width=300, every=STEP).withColumn("width", F.lit(300))
    return minute.unionByName(five)


@query
def mean_latency(w: Workspace) -> DataFrame:
    return rm.mean(w.request_log(), "duration_seconds", every=STEP)


@query
def bucket_counts(w: Workspace) -> DataFrame:
    latency = rm.bucket_counts(
        w.request_log(), "duration_seconds", fixed.LATENCY_BUCKETS, ["path"]
    ).withColumn("measure", F.lit("latency"))
    size = rm.bucket_counts(
        w.request_log(), "batch_size", fixed.BATCH_SIZE_BUCKETS, ["path"]
    ).withColumn("measure", F.lit("batch_size"))
    both = latency.unionByName(size)
    return both.withColumn("le", F.when(F.col("le") == float("inf"), -1.0).otherwise(F.col("le")))


@query
def hist_quantile(w: Workspace) -> DataFrame:
    """By path, by status and over all requests."""
    return rm.trailing_quantiles(
        w.request_log(), "duration_seconds", fixed.LATENCY_BUCKETS, [0.95, 0.99],
        ["path", "status_code"], overall=True, width=300, every=STEP,
    ).drop("label_of")


@query
def in_flight(w: Workspace) -> DataFrame:
    counted = rm.in_flight(w.request_log())
    at = F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return counted.withColumn("at", at)


@query
def metric_totals(w: Workspace) -> DataFrame:
    churned = w.score_log().agg(F.count_if(F.col("is_churn") == 1).alias("churn_predictions"))
    return rm.request_totals(w.request_log()).withColumn("churn_predictions", churned.scalar())


@query
def pred_rate(w: Workspace) -> DataFrame:
    kind = F.when(F.col("path") == "/predict/", "single").otherwise("batch")
    return rm.rate(w.request_log().withColumn("kind", kind), ["kind"], every=STEP)


@query
def rolling_churn_rate(w: Workspace) -> DataFrame:
    """Trailing five minutes, read at every step."""
    return rm.share(w.score_log(), F.col("is_churn") == 1, width=300, every=STEP)


@query
def class_mix(w: Workspace) -> DataFrame:
    return rm.rate(w.score_log(), ["is_churn"], width=300, every=STEP)


@query
def prob_heatmap(w: Workspace) -> DataFrame:
    cells = rm.bucket_counts(
        w.score_log(), "churn_probability", fixed.PROBABILITY_BUCKETS, width=300, every=STEP
    )
    return cells.withColumn("le", F.when(F.col("le") == float("inf"), -1.0).otherwise(F.col("le")))


@query
def mean_prob(w: Workspace) -> DataFrame:
    return rm.mean(w.score_log(), "churn_probability", every=STEP)


@query
def mean_batch(w: Workspace) -> DataFrame:
    return rm.mean(w.request_log().where("path = '/predict/batch'"), "batch_size", every=STEP)


@query
def fetch_rate(w: Workspace) -> DataFrame:
    return rm.rate(w.score_log(), every=STEP)


@query
def fetch_success(w: Workspace) -> DataFrame:
    return rm.share(w.score_log(), F.col("fetch_status") == "success", every=STEP)


@query
def fetch_latency(w: Workspace) -> DataFrame:
    return rm.mean(w.score_log(), "fetch_seconds", ["fetch_status"], every=STEP)


@query
def fetch_quantile(w: Workspace) -> DataFrame:
    found = rm.trailing_quantiles(
        w.score_log(), "fetch_seconds", fixed.FETCH_BUCKETS, [0.95], ["fetch_status"], width=300, every=STEP
    )
    return found.withColumnRenamed("label", "fetch_status").drop("label_of", "q")
