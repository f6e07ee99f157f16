"""The progress of streaming queries kept as a table.

A listener writes a row for every batch that any query of the session reports: its rows,
durations, offsets and observed counts. A batch that is repeated by a restarted query has a
row of each run; ``read`` takes the last run that read anything, as a sink that has the batch
already may skip it. So it gives one row per query and batch.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = (
    "query string, batch_id bigint, run_id string, started_at string, input_rows bigint, "
    "duration_ms bigint, durations map<string,bigint>, start_offsets array<string>, "
    "end_offsets array<string>, observed string"
)


def _text(offset) -> str | None:
    return offset if offset is None or isinstance(offset, str) else json.dumps(offset)


class ProgressLog(StreamingQueryListener):
    """Writes progress below ``path``; ``add`` it before a query starts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._ended: dict[str, threading.Event] = {}

    def add(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def remove(self) -> None:
        self.spark.streams.removeListener(self)

    def _event(self, query_run: str) -> threading.Event:
        return self._ended.setdefault(str(query_run), threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = (
            progress.name or str(progress.id), progress.batchId, str(progress.runId), progress.timestamp,
            progress.numInputRows, dict(progress.durationMs).get("triggerExecution"),
            dict(progress.durationMs), [_text(s.startOffset) for s in progress.sources],
            [_text(s.endOffset) for s in progress.sources],
            json.dumps({name: row.asDict() for name, row in progress.observedMetrics.items()}, default=str),
        )
        frame = self.spark.createDataFrame([row], PROGRESS).coalesce(1)
        writer = frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("query", "batch_id", "run_id").parquet(self.path)

    def onQueryTerminated(self, event) -> None:
        self._event(event.runId).set()

    def wait_for(self, query, seconds: float = 60) -> None:
        """Until the rows of a query that has ended are written; reports come after it."""
        query.awaitTermination()
        if not self._event(query.runId).wait(seconds):
            raise TimeoutError(f"no report of the end of {query.runId}")

    def read(self) -> DataFrame:
        reports = self.spark.read.schema(PROGRESS).parquet(self.path)
        whole = F.struct(*[F.col(name) for name in reports.columns])
        last = F.max_by(whole, F.struct(F.col("input_rows") > 0, "started_at"))
        return reports.groupBy("query", "batch_id").agg(last.alias("_last")).select("_last.*")


def batch_rates(progress: DataFrame) -> DataFrame:
    """Per query: batches, rows, rows a second and the longest batch."""
    seconds = F.sum("duration_ms") / 1000
    return progress.groupBy("query").agg(
        F.count("*").alias("batches"), F.sum("input_rows").alias("input_rows"),
        (F.sum("input_rows") / seconds).alias("rows_per_second"),
        F.max("duration_ms").alias("longest_ms"),
    )
