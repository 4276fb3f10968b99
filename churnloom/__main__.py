"""Command line: python -m churnloom <command> ... (or through spark-submit).

Commands: silver, gold, replay, stream, train, refresh-config, score, explain, stats,
materialize, historical, drift.
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from churnloom import fixed, schemas
from churnloom.operators import drift, lookup, preparation, reports
from churnloom.plans import batch, scoring
from churnloom.session import build, stored
from churnloom.sources import messages, tables
from churnloom.sources.buckets import BUCKETS, BucketTable
from churnloom.streaming import replay
from churnloom.streaming.feature_job import FeatureStream, newest_features


def silver(spark: SparkSession, a: argparse.Namespace) -> None:
    batch.bronze_to_silver(spark, a.bronze, a.silver)


def gold(spark: SparkSession, a: argparse.Namespace) -> None:
    batch.silver_to_gold(spark, a.silver, a.gold, a.as_of)


def send(spark: SparkSession, a: argparse.Namespace) -> None:
    """Replay the clean tables as messages, day by day."""
    logs = spark.read.parquet(f"{a.silver}/user_logs")
    paid = spark.read.parquet(f"{a.silver}/transactions")
    publish = replay.to_kafka(a.servers) if a.servers else replay.to_files(a.messages)
    replay.replay(
        replay.replay_messages(logs, paid, a.start), replay.dry_run if a.dry_run else publish
    )


def stream(spark: SparkSession, a: argparse.Namespace) -> None:
    baseline = spark.read.parquet(a.gold)
    job = FeatureStream(spark, a.tables, baseline, check_drift=a.drift, dry_run=a.dry_run)
    if a.servers:
        source = messages.stream_from_kafka(spark, a.servers, starting=a.starting)
    else:
        source = messages.stream_from_files(spark, a.messages)
    job.run(source, f"{a.tables}/checkpoint")


def train(spark: SparkSession, a: argparse.Namespace) -> None:
    given = {k: getattr(a, k) for k in fixed.BOOSTED_TREES if getattr(a, k) is not None}
    done = scoring.train(spark, spark.read.parquet(a.gold), a.model, runs=a.runs, **given)
    for name, value in done.metrics.items():
        print(f"{name}: {value}")


def refresh_config(spark: SparkSession, a: argparse.Namespace) -> None:
    old = preparation.load_config(spark, f"{a.model}/config")
    fresh = preparation.fit_config(spark.read.parquet(a.gold), old)
    preparation.save_config(spark, fresh, f"{a.model}/config")


def _latest(features: DataFrame) -> DataFrame:
    return lookup.latest_rows(features.select("msno", "event_timestamp", *fixed.FEATURES))


def _log(scored: DataFrame, a: argparse.Namespace) -> None:
    if a.log:
        scoring.append_scores(scored, a.log, a.run_id or uuid.uuid4().hex, a.event_time)


def stats(spark: SparkSession, a: argparse.Namespace) -> None:
    """Totals of the score log."""
    for name, value in reports.prediction_stats(spark.read.parquet(a.log)).first().asDict().items():
        print(f"{name}: {value}")


def _bucketed(spark: SparkSession, path: str, buckets: int = BUCKETS) -> BucketTable:
    schema = StructType(schemas.FEATURE_TABLE.fields)
    return BucketTable(spark, path, schema, "event_timestamp", buckets=buckets)


def materialize(spark: SparkSession, a: argparse.Namespace) -> None:
    """Newest features per user into a table in hash buckets; with --since only the rows
    from that day on are read, and only the buckets of their users are written again."""
    features = spark.read.parquet(a.features)
    if a.since:
        features = features.where(F.col("event_date") >= F.lit(a.since))
    table = _bucketed(spark, a.out, a.buckets)
    known = table.versions()
    base = known[-1] if known else None
    table.write(stored(_latest(features), "fresh"), (base or 0) + 1, base)
    table.clean()


def _newest(spark: SparkSession, a: argparse.Namespace, ids: DataFrame) -> DataFrame:
    """Newest feature rows: of the ids' buckets only, or from the whole feature history."""
    if a.latest:
        return _bucketed(spark, a.latest).read(keys=ids)
    if a.tables:
        return newest_features(spark, a.tables, ids)
    return _latest(spark.read.parquet(a.features))


def historical(spark: SparkSession, a: argparse.Namespace) -> None:
    """Features as they were at each request (msno, request_time) of a Parquet table."""
    features = spark.read.parquet(a.features).drop("event_date")
    tables.write_table(lookup.asof_features(spark.read.parquet(a.requests), features), a.out)


def score(spark: SparkSession, a: argparse.Namespace) -> None:
    ids, model = tables.read_ids(spark, a.ids), scoring.load(spark, a.model)
    scored = scoring.score_batch(ids, _newest(spark, a, ids), model, a.threshold)
    _log(scored, a)
    tables.export_scores(scored, a.out)


def explain(spark: SparkSession, a: argparse.Namespace) -> None:
    """Scores with reasons as Parquet."""
    ids, model = tables.read_ids(spark, a.ids), scoring.load(spark, a.model)
    newest = _newest(spark, a, ids)
    seen = newest.select("msno", F.to_date("event_timestamp").alias("feature_date"))
    scored = scoring.score_users(ids, newest, seen, model, a.threshold)
    _log(scored, a)
    tables.write_table(scored, a.out)


def check_drift(spark: SparkSession, a: argparse.Namespace) -> None:
    features = spark.read.parquet(a.features)
    if a.day:
        features = features.where(F.col("event_date") == F.lit(a.day))
    table = drift.drift_table(spark.read.parquet(a.gold), features)
    tables.write_by_day(table, a.out, "event_date")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="churnloom", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, run, *paths: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.set_defaults(run=run)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        return sub

    command("silver", silver, "bronze", "silver")
    command("gold", gold, "silver", "gold").add_argument("--as-of", type=date.fromisoformat)

    sub = command("replay", send, "silver")
    sub.add_argument("--messages")
    sub.add_argument("--servers", help="Kafka servers; without them messages go to files")
    sub.add_argument("--start", type=date.fromisoformat, default=fixed.STREAM_START)
    sub.add_argument("--dry-run", action="store_true")

    sub = command("stream", stream, "gold", "tables")
    sub.add_argument("--messages")
    sub.add_argument("--servers")
    sub.add_argument("--starting", choices=["earliest", "latest"], default="earliest")
    sub.add_argument("--drift", action="store_true")
    sub.add_argument("--dry-run", action="store_true")

    sub = command("train", train, "gold", "model")
    sub.add_argument("--runs")
    for name, value in fixed.BOOSTED_TREES.items():
        sub.add_argument(f"--{name.replace('_', '-')}", type=type(value))

    command("refresh-config", refresh_config, "gold", "model")
    for name, run in (("score", score), ("explain", explain)):
        sub = command(name, run, "ids", "model", "out")
        source = sub.add_mutually_exclusive_group(required=True)
        source.add_argument("--latest", help="table that the materialize command keeps")
        source.add_argument("--tables", help="tables of the stream command")
        source.add_argument("--features", help="feature history, read as a whole")
        sub.add_argument("--threshold", type=float, default=fixed.CHURN_THRESHOLD)
        sub.add_argument("--log", help="score log to add the predictions to")
        sub.add_argument("--run-id", help="a repeated run of this id replaces its rows")
        sub.add_argument("--event-time")
    command("stats", stats, "log")
    sub = command("materialize", materialize, "features", "out")
    sub.add_argument("--since", type=date.fromisoformat)
    sub.add_argument("--buckets", type=int, default=BUCKETS)
    command("historical", historical, "requests", "features", "out")
    command("drift", check_drift, "gold", "features", "out").add_argument(
        "--day", type=date.fromisoformat
    )
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    given = parser().parse_args(arguments)
    given.run(build(), given)


if __name__ == "__main__":
    main()
