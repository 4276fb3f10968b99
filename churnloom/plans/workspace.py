"""Tables derived once per session and input folder and shared by the queries.

A deployment keeps these tables between jobs (clean tables, the gold table, the
streaming feature table, a trained model); here they go to the scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnloom import fixed
from churnloom.operators import cleaning, drift, features, lookup, models, preparation
from churnloom.plans import scoring
from churnloom.session import scratch, stored
from churnloom.sources import messages as M
from churnloom.sources import tables
from churnloom.sources.buckets import BucketTable
from churnloom.sources.adapters import BASELINE_END, STREAM_START, Adapter
from churnloom.streaming import replay
from churnloom.streaming.feature_job import FeatureStream

LAST_DAY = date(2024, 1, 30)

_kept: dict[tuple[str, str, str], object] = {}


class Workspace(Adapter):
    def _once(self, name: str, make: Callable[[], object]) -> object:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _kept:
            _kept[key] = make()
        return _kept[key]

    def once(self, name: str, make: Callable[[Workspace], object]) -> object:
        return self._once(name, lambda: make(self))

    # --- batch -----------------------------------------------------------------
    def silver_members(self) -> DataFrame:
        return cleaning.silver_members(self.members_raw())

    def silver_transactions(self) -> DataFrame:
        return cleaning.silver_transactions(self.transactions_raw(1), self.transactions_raw(2))

    def silver_logs(self) -> DataFrame:
        return cleaning.silver_user_logs(self.user_logs_raw())

    def silver_train(self) -> DataFrame:
        return cleaning.silver_train(self.train_raw(1), self.train_raw(2))

    def gold(self, as_of: date | None = None) -> DataFrame:
        return features.gold_features(
            self.silver_train(),
            self.silver_members(),
            self.silver_transactions(),
            self.silver_logs(),
            as_of,
        )

    def baseline(self) -> DataFrame:
        """Gold as of the day before the stream starts, kept."""
        return self._once("baseline", lambda: stored(self.gold(BASELINE_END), "baseline"))

    def config(self) -> dict:
        return self._once("config", lambda: preparation.fit_config(self.baseline()))

    # --- stream, in batch form ---------------------------------------------------
    def day_logs(self) -> DataFrame:
        return self.stream_logs().withColumnRenamed("date", "day")

    def day_transactions(self) -> DataFrame:
        return self.stream_transactions().withColumnRenamed("transaction_date", "day")

    def delta(self) -> DataFrame:
        return features.daily_delta(self.day_logs(), self.day_transactions())

    def cumulative(self) -> DataFrame:
        return features.cumulative_features(self.delta(), tables.baseline_totals(self.baseline()))

    def feature_table(self) -> DataFrame:
        """Daily features as a day-partitioned table, kept."""

        def make() -> str:
            path = scratch(self.spark, "features")
            tables.append_features(self.cumulative().drop("day"), path)
            return path

        return self.spark.read.parquet(self._once("features", make))

    def latest(self) -> DataFrame:
        columns = ["msno", "event_timestamp", *fixed.FEATURES]
        return self._once(
            "latest", lambda: stored(lookup.latest_rows(self.feature_table().select(*columns)), "latest")
        )

    def newest(self, users: DataFrame) -> DataFrame:
        """Newest feature rows of the hash buckets that hold some of the users."""

        def make() -> BucketTable:
            schema = self.latest().schema
            table = BucketTable(self.spark, scratch(self.spark, "newest"), schema, "event_timestamp", buckets=8)
            table.write(self.latest(), 1)
            return table

        return self._once("newest", make).read(1, users)

    def baseline_bins(self) -> DataFrame:
        return self._once("bins", lambda: stored(drift.drift_baseline(self.baseline()), "bins"))

    def drift(self) -> DataFrame:
        return self._once(
            "drift", lambda: stored(drift.drift_table(self.baseline(), self.feature_table()), "drift")
        )

    # --- stream ------------------------------------------------------------------
    def messages(self) -> DataFrame:
        """All stream records as messages with their day."""
        return replay.replay_messages(self.stream_logs(), self.stream_transactions(), STREAM_START)

    def sent(self) -> DataFrame:
        """The messages, kept: jobs that send them read them several times."""
        return self._once("sent", lambda: stored(self.messages(), "messages"))

    def control_messages(self) -> DataFrame:
        """End markers of every day; the last day's transactions marker is missing."""
        days = self.day_logs().select("day").union(self.day_transactions().select("day")).distinct()
        complete = M.markers(days.where(F.col("day") < F.lit(LAST_DAY)))
        return complete.unionByName(
            M.markers(days.where(F.col("day") == F.lit(LAST_DAY)), [fixed.LOG_TOPIC])
        )

    def stream(self) -> FeatureStream:
        """The streaming job over a replay, with late rows and a restart.

        Rows of some users are held back and sent after all days were replayed,
        so they are late for every day but the last, which is still open then.
        """
        return self._once("stream", self.run_stream)

    def message_folder(self) -> str:
        self.stream()
        return self._once("message_folder", lambda: None)

    def run_stream(self) -> FeatureStream:
        root = scratch(self.spark, "stream")
        folder = f"{root}/messages"
        key = (self.spark.sparkContext.applicationId, self.sf_dir, "message_folder")
        _kept[key] = folder
        everything = self.sent()
        held_back = (F.col("key").cast("bigint") + F.dayofmonth("day")) % 23 == 0

        def topics(day: date) -> list[str] | None:
            return [fixed.LOG_TOPIC] if day == LAST_DAY else None

        replay.replay(everything.where(~held_back), replay.to_files(folder), topics)
        job = FeatureStream(
            self.spark, f"{root}/tables", self.baseline(), buckets=8, check_drift=True
        )
        source = M.stream_from_files(self.spark, folder, files_per_trigger=48)
        job.run(source, f"{root}/checkpoint", finalize=False)
        everything.where(held_back).drop("day").write.mode("append").json(folder)
        job.run(source, f"{root}/checkpoint")
        return job

    def small_job(self, name: str, **options) -> FeatureStream:
        """A job of its own over given batches."""
        return FeatureStream(self.spark, scratch(self.spark, name), self.baseline(), buckets=4, **options)

    # --- model -------------------------------------------------------------------
    def parts(self) -> tuple[DataFrame, DataFrame]:
        """Prepared rows of the earlier and the later users."""

        def make() -> tuple[DataFrame, DataFrame]:
            ready = preparation.impute(self.baseline(), self.config(), "zero")
            early, late = preparation.split_by_registration(ready)
            return tuple(preparation.dealt(preparation.feature_matrix(p)) for p in (early, late))

        return self._once("parts", make)

    def candidate(self, name: str) -> Model:
        """A model of the comparison with its stated parameters, fitted once."""
        estimator, balanced = models.candidates()[name]
        return self._once(name, lambda: models.fit(estimator, self.parts()[0], balanced))

    def artefacts(self) -> scoring.Artefacts:
        """The main model with its stated parameters, fitted once."""
        return self._once(
            "model",
            lambda: scoring.train(
                self.spark,
                self.baseline(),
                scratch(self.spark, "model"),
            ),
        )
