"""Streaming features with a completeness barrier.

A day closes when both topics announced its end and all announced records are there, not
when time has passed, so this is one query with ``foreachBatch`` over tables rather than a
watermark:

``open``      what each user added to each open day, one partition per day and batch
``ends``      end-of-day records of open days, likewise
``state``     everyone's totals and newest features, in hash buckets with copy on write
``features``  the append-only feature table, by event_date
``audit``     rejected and late messages, by kind and batch
``batches``   what each batch held: messages, valid, rejected, late, markers
``drift``     drift of each flushed day, if wanted
``flushed``   which days are done; one version is one file, written last

What a batch reads is its own messages, the partitions of the days that are open, and the
buckets of the users it flushes; closed days leave ``open`` and ``ends``. So the files
that are listed and read do not grow with the number of days.

Each write replaces what an earlier try of the same batch left, and a day is done only
when its ``flushed`` row exists: a repeated batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from churnloom import fixed, schemas
from churnloom.functions import scalars as S
from churnloom.operators import days as D
from churnloom.operators import drift as drift_ops
from churnloom.operators import features as feature_ops
from churnloom.sources import files
from churnloom.sources import messages as M
from churnloom.sources.buckets import BUCKETS, BucketTable
from churnloom.sources.tables import append_features, write_by_day

LOGS, TRANSACTIONS, LATE = "logs", "transactions", "late"

SUMS = ", ".join(f"{c} {'exact' if c in feature_ops.MONEY_AND_TIME else 'bigint'}" for c in feature_ops.TOTALS)
OPEN = schemas.columns(f"msno string, {SUMS}, day date, batch bigint")
ENDS = schemas.columns("topic string, rows bigint, day date, batch bigint")
FLUSHED = schemas.columns("day date, seq bigint, batch bigint, user_count bigint")
#: A user of the baseline who was not seen since has seq 0 and no event_timestamp.
STATE = schemas.columns(
    "msno string, seq bigint, event_timestamp timestamp_ntz, city bigint, bd bigint, gender string,"
    f" registered_via bigint, {SUMS}"
)
AUDIT = schemas.columns("topic string, key string, value string, day date, reason string, kind string, batch bigint")
BATCHES = schemas.columns(
    "batch bigint, messages bigint, valid bigint, rejected bigint, late bigint, markers bigint"
)
FEATURES = StructType([*schemas.FEATURE_TABLE.fields, StructField("event_date", DateType())])
DRIFT = schemas.columns(
    "feature string, psi double, level string, ks_stat double, ks_pvalue double,"
    " ks_drift boolean, event_date date"
)


class FeatureStream:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        baseline: DataFrame,
        buckets: int = BUCKETS,
        keep_latest: bool = True,
        check_drift: bool = False,
        dry_run: bool = False,
    ):
        """``baseline`` has a row per known user: ``sources.tables.baseline_totals``
        of the gold table, or the gold table itself when drift is checked too."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.baseline = baseline
        self.state = BucketTable(spark, self._path("state"), STATE, "seq", buckets=buckets)
        self.keep_latest = keep_latest and not dry_run
        self.check_drift = check_drift and not dry_run
        self.dry_run = dry_run
        #: The baseline's bins and value counts, made at the first drift check.
        self.reference: drift_ops.Reference | None = None

    # --- tables ------------------------------------------------------------
    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _read(self, name: str, schema: StructType, *parts: str) -> DataFrame:
        """A table of the job, or the partitions ``parts`` of it; empty before its first write."""
        path = self._path(name)
        try:
            reader = self.spark.read.schema(schema).option("basePath", path)
            return reader.parquet(*([f"{path}/{p}" for p in parts] or [path]))
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing.getCondition()):
                raise
            return self.spark.createDataFrame([], schema)

    def flushed(self) -> DataFrame:
        return self.spark.createDataFrame(self._done(), FLUSHED)

    def features(self) -> DataFrame:
        return self._read("features", FEATURES)

    def drift(self) -> DataFrame:
        return self._read("drift", DRIFT)

    def audit(self) -> DataFrame:
        """Messages that did not become features, with the reason: rejected and late ones."""
        return self._read("audit", AUDIT)

    def late(self) -> DataFrame:
        """Records that came after their day was flushed."""
        return self.audit().where(F.col("kind") == LATE)

    def rejected(self) -> DataFrame:
        return self.audit().where(F.col("kind") == M.REJECTED)

    def batches(self) -> DataFrame:
        """Counts per batch: messages = valid + rejected + late + markers."""
        return self._read("batches", BATCHES)

    def day_status(self) -> DataFrame:
        """Completion record per day, in the order of completion."""
        return self.flushed().select("day", "seq", "user_count")

    def last_seen(self, users: DataFrame | None = None) -> DataFrame:
        """Last streamed day per user, from the newest rows; of the buckets of ``users`` only."""
        rows = self.state.read(self._last_seq() or None, users)
        seen = rows.where(F.col("event_timestamp").isNotNull())
        return seen.select("msno", F.to_date("event_timestamp").alias("feature_date"))

    def latest(self, users: DataFrame | None = None) -> DataFrame | None:
        """Newest feature row per streamed user; of the buckets of ``users`` only."""
        seq = self._last_seq() if self.keep_latest else 0
        return latest_of(self.state.read(seq, users)) if seq else None

    def _done(self) -> list[Row]:
        """Flushed days: one row for each calendar day, of the newest complete version."""
        versions = sorted(map(int, files.partition_values(self.spark, self._path("flushed"), "version")))
        for v in reversed(versions):
            if files.complete(self.spark, self._path(f"flushed/version={v}")):
                rows = self.spark.read.schema(FLUSHED).parquet(self._path(f"flushed/version={v}"))
                return rows.orderBy("seq").collect()
        return []

    def _last_seq(self) -> int:
        return max((r.seq for r in self._done()), default=0)

    def open_days(self) -> list[date]:
        """Days with records that were not flushed yet."""
        done = {r.day for r in self._done()}
        found = map(date.fromisoformat, files.partition_values(self.spark, self._path("open"), "day"))
        return sorted(d for d in found if d not in done)

    # --- micro-batch ---------------------------------------------------------
    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Stage one micro-batch and flush the days it completes."""
        done = self._done()
        rows = self._sorted(batch, done, batch_id).persist()
        try:
            self._stage(rows, batch_id)
        finally:
            rows.unpersist()
        self._flush(self._ready(done), done, batch_id)
        self._close(batch_id)

    def _sorted(self, batch: DataFrame, done: Sequence[Row], batch_id: int) -> DataFrame:
        # Days done by an earlier batch. Days done by a first try of this batch
        # do not count, or its own rows would look late on the second try.
        earlier = [(r.day, True) for r in done if r.batch < batch_id]
        # One row for each flushed day on the broadcast side.
        closed = F.broadcast(self.spark.createDataFrame(earlier, "day date, closed boolean"))
        rows = M.sorted_out(batch).join(closed, "day", "left")
        late = (F.col("kind") == M.DATA) & F.col("closed")
        return rows.withColumns(
            {
                "kind": F.when(late, LATE).otherwise(F.col("kind")),
                "reason": F.when(late, "day closed").otherwise(F.col("reason")),
            }
        )

    def _stage(self, rows: DataFrame, batch_id: int) -> None:
        """What the batch adds to open days, and what it holds besides."""
        kinds = ((M.DATA, "valid"), (M.REJECTED, "rejected"), (LATE, "late"), (M.MARKER, "markers"))
        # Computes the cached rows; an observation of a cached plan may stay empty.
        counts = rows.agg(
            F.count(F.lit(1)).alias("messages"),
            *[F.count_if(F.col("kind") == kind).alias(name) for kind, name in kinds],
        ).first()
        self.spark.createDataFrame([(batch_id, *counts)], BATCHES).coalesce(1).write.mode("overwrite").parquet(
            self._path(f"batches/of={batch_id}")
        )
        numbered = F.lit(batch_id).cast("bigint").alias("batch")
        data = rows.where(F.col("kind") == M.DATA)
        log, paid = data.where(F.col("topic") == fixed.LOG_TOPIC), data.where(F.col("topic") == fixed.TRANSACTION_TOPIC)
        self._replace(feature_ops.daily_delta(log, paid).select("*", numbered), "open", ["day", "batch"])
        ends = rows.where((F.col("kind") == M.MARKER) & F.col("closed").isNull())
        ends = ends.select("topic", F.col("_rows").alias("rows"), "day", numbered).distinct()
        if counts.markers:
            self._replace(ends.coalesce(1), "ends", ["day", "batch"])
        if counts.rejected or counts.late:
            odd = rows.where(F.col("kind").isin(LATE, M.REJECTED))
            odd = odd.select("topic", "key", "value", "day", "reason", "kind", numbered)
            self._replace(odd, "audit", ["kind", "batch"])

    def _replace(self, rows: DataFrame, name: str, by: list[str]) -> None:
        """Write the partitions that the rows belong to, in place of what was there."""
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(
            self._path(name)
        )

    def _ready(self, done: Sequence[Row]) -> list[date]:
        """Open days that are complete, in date order."""
        closed = {r.day for r in done}
        listed = files.partition_values(self.spark, self._path("ends"), "day")
        ended = [d for d in listed if date.fromisoformat(d) not in closed]
        if not ended:
            return []
        control = self._read("ends", ENDS, *[f"day={d}" for d in ended])
        there = set(files.partition_values(self.spark, self._path("open"), "day"))
        held = self._read("open", OPEN, *[f"day={d}" for d in ended if d in there]) if there & set(ended) else None
        if held is None:
            staged = self.spark.createDataFrame([], "day date, topic string, records bigint")
        else:
            pairs = [
                F.struct(F.lit(topic).alias("topic"), F.sum(c).alias("records"))
                for topic, c in ((fixed.LOG_TOPIC, "total_log_days"), (fixed.TRANSACTION_TOPIC, "total_transactions"))
            ]
            staged = held.groupBy("day").agg(F.array(*pairs).alias("x")).select("day", F.inline("x"))
        # A handful of calendar days.
        return [r.day for r in D.counted_days(control, staged).orderBy("day").collect()]

    def _flush(self, days: Sequence[date], done: Sequence[Row], batch_id: int) -> None:
        """Turn complete days into feature rows, in one go for all of them."""
        if not days:
            return
        before = max((r.seq for r in done), default=0)
        last = before + len(days)
        numbered = self.spark.createDataFrame(
            [(d, before + i) for i, d in enumerate(days, 1)], "day date, seq bigint"
        )
        there = set(files.partition_values(self.spark, self._path("open"), "day"))
        parts = [f"day={d.isoformat()}" for d in days if d.isoformat() in there]
        held = self._read("open", OPEN, *parts) if parts else self.spark.createDataFrame([], OPEN)
        delta = held.groupBy("day", "msno").agg(*[F.sum(c).alias(c) for c in feature_ops.TOTALS])
        # One row per flushed day on the broadcast side.
        delta = delta.join(F.broadcast(numbered), "day")
        base = self._base(before)
        self._added_up(delta, base).write.mode("overwrite").parquet(self._path("work"))
        work = self.spark.read.parquet(self._path("work"))
        rows = feature_ops.as_feature_rows(work, [])
        append_features(rows, self._path("features"), self.dry_run)
        self.state.write(self._newest(work), last, base)
        if self.check_drift:
            self._check_drift(rows)
        users = {r.day: r.n for r in work.groupBy("day").agg(F.count(F.lit(1)).alias("n")).collect()}
        new = [(d, before + i, batch_id, users.get(d, 0)) for i, d in enumerate(days, 1)]
        self.spark.createDataFrame([*done, *new], FLUSHED).coalesce(1).write.mode("overwrite").parquet(
            self._path(f"flushed/version={last}")
        )

    def _base(self, before: int) -> int:
        """The version of the state that holds the days done so far; the first is the baseline."""
        if before == 0:
            known = self.baseline.select(
                "msno", F.lit(0).cast("bigint").alias("seq"), F.lit(None).cast("timestamp_ntz").alias("event_timestamp"),
                *[F.col(c).cast(STATE[c].dataType).alias(c) for c in fixed.DEMOGRAPHICS],
                *[S.zero_if_null(F.col(c).try_cast(STATE[c].dataType)).alias(c) for c in feature_ops.TOTALS],
            )
            self.state.write(known, 0)
        return before

    def _added_up(self, delta: DataFrame, base: int) -> DataFrame:
        """day, seq, demographics and totals up to each (user, day) of ``delta``."""
        known = self.state.read(base, delta)
        had = known.select("msno", *fixed.DEMOGRAPHICS, *[F.col(c).alias(f"had_{c}") for c in feature_ops.TOTALS])
        so_far = Window.partitionBy("msno").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        totals = [
            (S.zero_if_null(f"had_{c}") + F.sum(c).over(so_far)).cast(STATE[c].dataType).alias(c)
            for c in feature_ops.TOTALS
        ]
        return delta.join(had, "msno", "left").select("msno", "day", "seq", *fixed.DEMOGRAPHICS, *totals)

    def _newest(self, work: DataFrame) -> DataFrame:
        """The newest row of each flushed user, as the state holds it."""
        stamped = work.withColumn("event_timestamp", S.day_start("day"))
        others = [c for c in STATE.fieldNames() if c not in ("msno", "seq")]
        return stamped.groupBy("msno").agg(F.max(F.struct("seq", *others)).alias("row")).select("msno", "row.*")

    def _check_drift(self, rows: DataFrame) -> None:
        current = rows.withColumn("event_date", F.to_date("event_timestamp"))
        if self.reference is None:
            self.reference = drift_ops.reference(self.baseline)
        found = drift_ops.drift_table(self.baseline, current, known=self.reference)
        write_by_day(found, self._path("drift"), "event_date")

    def _close(self, batch_id: int) -> None:
        """Remove what flushed days left open, and older versions."""
        done = {r.day.isoformat() for r in self._done()}
        for name in ("open", "ends"):
            for d in files.partition_values(self.spark, self._path(name), "day"):
                if d in done:
                    files.remove(self.spark, self._path(f"{name}/day={d}"))
        versions = sorted(map(int, files.partition_values(self.spark, self._path("flushed"), "version")))
        newest = max((v for v in versions if files.complete(self.spark, self._path(f"flushed/version={v}"))), default=None)
        for v in versions:
            if newest is not None and v < newest:
                files.remove(self.spark, self._path(f"flushed/version={v}"))
        self.state.clean()

    def finalize(self) -> list[date]:
        """Flush the days still open at the end of the input, in date order."""
        pending = self.open_days()
        # Done before any further batch: what comes for these days is late.
        self._flush(pending, self._done(), -1)
        self._close(-1)
        return pending

    # --- query ---------------------------------------------------------------
    def start(self, source: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Start on a (topic, key, value) stream. The default trigger takes what is
        there and stops; the checkpoint folder holds the offsets for a restart."""
        return (
            source.writeStream.queryName("features")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .foreachBatch(self.process)
            .start()
        )

    def run(self, source: DataFrame, checkpoint: str, finalize: bool = True) -> None:
        """Process everything available, then flush what stayed open."""
        self.start(source, checkpoint).awaitTermination()
        if finalize:
            self.finalize()


def latest_of(state: DataFrame) -> DataFrame:
    """Feature rows of the users of a state table that were seen in the stream."""
    rows = state.where(F.col("event_timestamp").isNotNull()).withColumn("day", F.col("event_timestamp"))
    return feature_ops.as_feature_rows(rows, [])


def newest_features(spark: SparkSession, root: str, users: DataFrame | None = None) -> DataFrame:
    """Newest feature row per streamed user of a job's tables; with ``users`` only the
    buckets that hold them are read."""
    state = BucketTable(spark, f"{root.rstrip('/')}/state", STATE, "seq")
    return latest_of(state.read(None, users))
