"""Feature-store reads and writes: newest row, point in time, request lookup."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnloom import fixed


def latest_rows(features: DataFrame) -> DataFrame:
    """Newest row per user.

    ``max`` over a struct keeps one candidate per task before the shuffle. Equal
    timestamps are settled by the remaining columns, so runs agree.
    """
    others = [c for c in features.columns if c not in ("msno", "event_timestamp")]
    newest = F.max(F.struct("event_timestamp", *others)).alias("row")
    return features.groupBy("msno").agg(newest).select("msno", "row.*")


def in_range(features: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Rows with start <= event_timestamp < end; also prunes day partitions."""
    ts = F.col("event_timestamp")
    rows = features.where((ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz")))
    if "event_date" in features.columns:
        rows = rows.where(F.col("event_date").between(F.lit(start.date()), F.lit(end.date())))
    return rows


def materialize(
    latest: DataFrame | None, features: DataFrame, start: datetime, end: datetime
) -> DataFrame:
    """The latest table after pushing the rows of a time range into it."""
    columns = ["msno", "event_timestamp", *fixed.FEATURES]
    fresh = in_range(features, start, end).select(*columns)
    if latest is not None:
        fresh = fresh.unionByName(latest.select(*columns))
    return latest_rows(fresh)


def asof_features(
    requests: DataFrame,
    features: DataFrame,
    ttl: timedelta = fixed.FEATURE_TTL,
    bucket: timedelta | None = None,
) -> DataFrame:
    """Newest feature row per request with time - ttl <= event_timestamp <= time.

    ``requests`` has ``msno`` and ``request_time``; all its rows and columns are
    kept. Each feature row answers for the time until the next one of its user,
    cut at the ttl. That span is laid out over time buckets and joined on (user,
    bucket): a request meets only the rows of its own bucket, the request side
    is neither sorted by user nor grouped, and adaptive execution can split a
    bucket with very many requests. Buckets are as wide as the ttl unless given, so
    that a feature row is in two of them at most.
    """
    names = [c for c in features.columns if c not in ("msno", "event_timestamp")]
    width = int((bucket or ttl).total_seconds())
    spans = _valid_spans(latest_per_time(features), ttl, width)
    by_bucket = spans.select(
        F.col("msno").alias("_user"),
        F.col("event_timestamp").alias("feature_timestamp"),
        *names,
        "_until",
        F.explode(
            F.sequence(_bucket_of("event_timestamp", width), _bucket_of("_until", width))
        ).alias("_feature_bucket"),
    )
    asked = requests.withColumn("_bucket", _bucket_of("request_time", width))
    valid = (
        (F.col("msno") == F.col("_user"))
        & (F.col("_bucket") == F.col("_feature_bucket"))
        & (F.col("request_time") >= F.col("feature_timestamp"))
        & (F.col("request_time") <= F.col("_until"))
    )
    return asked.join(by_bucket, valid, "left").select(
        *requests.columns, "feature_timestamp", *names
    )


def latest_per_time(features: DataFrame) -> DataFrame:
    """One row per (user, event_timestamp)."""
    others = [c for c in features.columns if c not in ("msno", "event_timestamp")]
    picked = F.max(F.struct(*others)).alias("row")
    return features.groupBy("msno", "event_timestamp").agg(picked).select(
        "msno", "event_timestamp", "row.*"
    )


def _bucket_of(c: str, width: int) -> Column:
    """Number of the time bucket, from zone-free arithmetic."""
    since_epoch = f"cast({c} AS timestamp_ntz) - TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    return F.expr(f"({since_epoch}) div INTERVAL '{width}' SECOND")


def _valid_spans(features: DataFrame, ttl: timedelta, width: int) -> DataFrame:
    """Add ``_until``: the last moment at which the row is the answer.

    The next row is looked for inside the (user, bucket) first and, for the last
    row of a bucket, in the user's next bucket, so the largest window is one
    bucket of one user or the bucket list of one user.
    """
    placed = features.withColumn("_b", _bucket_of("event_timestamp", width))
    inside = Window.partitionBy("msno", "_b").orderBy("event_timestamp")
    firsts = (
        placed.groupBy("msno", "_b")
        .agg(F.min("event_timestamp").alias("_first"))
        .withColumn("_next_first", F.lead("_first").over(Window.partitionBy("msno").orderBy("_b")))
        .drop("_first")
    )
    one_tick = F.expr("INTERVAL '0.000001' SECOND")
    expires = F.col("event_timestamp") + F.lit(ttl)
    following = F.coalesce(F.lead("event_timestamp").over(inside), F.col("_next_first"))
    return (
        placed.join(firsts, ["msno", "_b"])
        .withColumn("_until", F.least(expires, following - one_tick))
        .drop("_b", "_next_first")
    )


def last_seen(features: DataFrame) -> DataFrame:
    """Last streamed day per user."""
    return features.groupBy("msno").agg(F.max("event_date").alias("feature_date"))


def lookup(requests: DataFrame, latest: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Request ids with their newest features; unknown users get nulls.

    ``member_found`` is true when any feature has a value.
    """
    got = requests.join(latest.select("msno", *fixed.FEATURES), "msno", "left")
    if seen is not None:
        got = got.join(seen, "msno", "left")
    found = F.coalesce(*[F.col(c).cast("string") for c in fixed.FEATURES]).isNotNull()
    return got.withColumn("member_found", found)
