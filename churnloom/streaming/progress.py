"""Progress rows of a running query, and a stop after a time without input."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryListener,
)

PROGRESS = "query string, batch bigint, input_rows bigint, at string"


class Progress(StreamingQueryListener):
    """One row for each batch with input of the queries of a name, and the time of the last."""

    def __init__(self, name: str) -> None:
        self.name = name
        self.run_ids: set[str] = set()
        self.rows: list[tuple[str, int, int, str]] = []
        self.last_input = time.monotonic()

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        if event.name == self.name:
            self.run_ids.add(str(event.runId))
            self.last_input = time.monotonic()

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        p = event.progress
        if p.name == self.name and p.numInputRows:
            self.last_input = time.monotonic()
            self.rows.append((p.name, p.batchId, p.numInputRows, p.timestamp))

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        pass

    def table(self, spark: SparkSession) -> DataFrame:
        """A row per batch; a batch that was run again has its last counts."""
        rows = spark.createDataFrame(self.rows, PROGRESS)
        newest = F.max(F.struct("at", "input_rows")).alias("row")
        return rows.groupBy("query", "batch").agg(newest).select("query", "batch", "row.input_rows", "row.at")


def run_until_idle(
    query: StreamingQuery, progress: Progress, idle_seconds: float, poll: float = 0.2
) -> bool:
    """Stop a continuous query when no batch had input for ``idle_seconds``; false if it
    ended by itself. The time a batch with data is worked on is not idle time."""
    busy = time.monotonic()
    while not query.awaitTermination(poll):
        if query.status["isDataAvailable"]:
            busy = time.monotonic()
        if time.monotonic() - max(busy, progress.last_input) >= idle_seconds:
            query.stop()
            return True
    return False
