"""The run log of streams: one row for each micro-batch, from Spark's own progress events, and one for each end of a query."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS_SCHEMA = (
    "query string, run_id string, batch_id long, status string, batch_started_at timestamp_ntz, duration_ms long, rows_read long, "
    "rows_written long, rows_late long, rows_in_state long, error_message string"
)


class StreamLog(StreamingQueryListener):
    """Keeps a row a micro-batch of the queries of one name and appends them to a table.

    Rows read are those of all sources; late ones are those that stateful operators have dropped behind the watermark; rows written are the sink's, or what ``written`` counts: the
    name of an observed metric (``df.observe(written, count)``), for sinks that report none. A batch without rows has no row.
    """

    def __init__(self, spark: SparkSession, path: str, query: str, written: str | None = None, every: int = 50):
        self._spark, self._path, self._query, self._written, self._every = spark, path, query, written, every
        self._rows: list[tuple] = []
        self._lock, self._ended = threading.Lock(), threading.Event()
        self._runs: set[str] = set()

    def __enter__(self) -> "StreamLog":
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, kind, error, trace) -> bool:
        self._ended.wait(30)  # events come a little after the query has ended
        self._spark.streams.removeListener(self)
        self.flush()
        return False

    def onQueryStarted(self, event) -> None:
        if event.name == self._query:
            self._runs.add(str(event.runId))

    def onQueryIdle(self, event) -> None:
        """Idle triggers are not logged."""

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        if progress.get("name") != self._query or not progress.get("numInputRows"):
            return
        state = progress.get("stateOperators") or []
        seen = (progress.get("observedMetrics") or {}).get(self._written) or {}
        sunk = progress.get("sink", {}).get("numOutputRows", -1)
        written = next(iter(seen.values()), None) if self._written else (sunk if sunk >= 0 else None)
        self._add(
            progress["runId"], progress["batchId"], "success", progress["timestamp"], progress.get("batchDuration"), progress["numInputRows"], written,
            sum(s.get("numRowsDroppedByWatermark", 0) for s in state), sum(s.get("numRowsTotal", 0) for s in state), None,
        )

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self._runs:
            if event.exception:
                self._add(str(event.runId), None, "failed", None, None, None, None, None, None, event.exception[:2000])
            self._ended.set()

    def _add(self, *row) -> None:
        with self._lock:
            self._rows.append((self._query, *row))
            full = len(self._rows) >= self._every
        if full:
            self.flush()

    def flush(self) -> None:
        """Append the rows that are held; called at the end and whenever there are enough for a file."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            made = self._spark.createDataFrame(rows, PROGRESS_SCHEMA.replace("timestamp_ntz", "string"))
            at = F.to_timestamp("batch_started_at").cast("timestamp_ntz")
            made.withColumn("batch_started_at", at).coalesce(1).write.mode("append").parquet(self._path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS_SCHEMA).parquet(path)
