"""Coverage, failures and the log of runs."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newslens.functions.clock import parse_iso
from newslens.schemas import FAILED_WINDOW_SCHEMA, RUN_LOG_SCHEMA

GAP_SECONDS = 1
ERROR_LIMIT = 500


def backfill_coverage(events: DataFrame, ts: str, start: Column, now: Column, window_hours: int = 6) -> DataFrame:
    """Events per backfill window, empty windows included: (window_no, window_start, window_end, event_count).

    Windows are ``window_hours`` long, both ends included; the next starts one second after the last end; the last ends
    at ``now``. ``start`` and ``now`` are single values (literals or scalar subqueries). The windows are evenly
    spaced, so an event's window is computed and counted before it meets the grid: no range join.
    """
    span = window_hours * 3600
    step = span + GAP_SECONDS
    seconds = F.timestamp_diff("SECOND", F.col("_start"), F.col("_now"))
    spark = events.sparkSession
    grid = (
        spark.range(1)
        .select(start.cast("timestamp_ntz").alias("_start"), now.cast("timestamp_ntz").alias("_now"))
        .where(F.col("_start") < F.col("_now"))
        .select("_start", "_now", F.explode(F.sequence(F.lit(0), F.floor((seconds - 1) / step))).alias("window_no"))
        .select(
            F.col("window_no").cast("bigint").alias("window_no"),
            F.timestamp_add("SECOND", F.col("window_no") * step, F.col("_start")).alias("window_start"),
            F.least(
                F.timestamp_add("SECOND", F.col("window_no") * step + span, F.col("_start")), F.col("_now")
            ).alias("window_end"),
        )
    )
    micros = F.timestamp_diff("MICROSECOND", start.cast("timestamp_ntz"), F.col(ts))
    into = F.pmod(F.col("_micros"), F.lit(step * 1_000_000))
    counted = (
        events.where(F.col(ts).between(start.cast("timestamp_ntz"), now.cast("timestamp_ntz")))
        .select(micros.alias("_micros"))
        .where(into <= span * 1_000_000)
        .groupBy(((F.col("_micros") - into) / F.lit(step * 1_000_000)).cast("bigint").alias("window_no"))
        .agg(F.count(F.lit(1)).alias("event_count"))
    )
    return grid.join(counted, "window_no", "left").select(
        "window_no", "window_start", "window_end", F.coalesce("event_count", F.lit(0)).cast("bigint").alias("event_count")
    )


def read_failed_windows(spark: SparkSession, path: str) -> DataFrame:
    """The ledger of failed backfill windows (JSON lines)."""
    return spark.read.schema(FAILED_WINDOW_SCHEMA).json(path)


def failed_window_report(ledger: DataFrame) -> DataFrame:
    """Failures per window and kind of error, with attempts and whether the window was skipped in the end."""
    return (
        ledger.select(
            parse_iso(F.col("window_start")).alias("window_start"),
            parse_iso(F.col("window_end")).alias("window_end"),
            "error_type",
            "attempts",
            "skipped",
            parse_iso(F.col("recorded_at")).alias("recorded_at"),
        )
        .groupBy("window_start", "window_end", "error_type")
        .agg(
            F.count(F.lit(1)).alias("failures"),
            F.sum("attempts").alias("attempts"),
            F.max("skipped").alias("skipped"),
            F.max("recorded_at").alias("last_recorded_at"),
        )
    )


#: How long the log waits for the count of a frame.
WAIT_SECONDS = 5


class RunLog:
    """Metrics of one run, taken while its data passes, appended to a table as one row.

    ``reading`` and ``writing`` attach counters to the DataFrames that the run's own job evaluates, so counting costs no
    extra job. As a context manager it writes the row at the end, whether the run went through or not.
    """

    def __init__(self, spark: SparkSession, path: str, run_id: str, pipeline: str, run_type: str, source_name: str):
        self._spark, self._path = spark, path
        self._identity = (run_id, pipeline, run_type, source_name)
        self._counters: dict[str, Observation] = {}
        self._errors: list[str] = []
        self._started = None

    def _observed(self, name: str, df: DataFrame) -> DataFrame:
        self._counters[name] = Observation()
        return df.observe(self._counters[name], F.count(F.lit(1)).alias("rows"))

    def reading(self, df: DataFrame) -> DataFrame:
        return self._observed("read", df)

    def writing(self, df: DataFrame) -> DataFrame:
        return self._observed("written", df)

    def problem(self, message: str) -> None:
        """Note a failure that did not end the run."""
        self._errors.append(message)

    def __enter__(self) -> "RunLog":
        self._started = self._now()
        return self

    def __exit__(self, kind, error, trace) -> bool:
        counts = self._counts()
        if error is not None:
            row = self._row("failed", str(error), counts)
        else:
            status = "partial_success" if self._errors else "success"
            row = self._row(status, " | ".join(self._errors) or None, counts)
        self._spark.createDataFrame([row], RUN_LOG_SCHEMA).write.mode("append").parquet(self._path)
        return False

    def _counts(self) -> dict[str, int]:
        """Rows of the counted frames. One that no job has evaluated has none and is not waited for longer than WAIT_SECONDS."""
        counts: dict[str, int] = {}
        for name, counter in self._counters.items():
            asked = threading.Thread(target=lambda n=name, c=counter: counts.update({n: c.get["rows"]}), daemon=True)
            asked.start()
            asked.join(WAIT_SECONDS)
        return dict(counts)

    def _row(self, status: str, message: str | None, counts: dict[str, int]) -> tuple:
        message = message[:ERROR_LIMIT] if message else None
        return (
            *self._identity, self._started, self._now(), status,
            counts.get("read", 0), counts.get("written", 0), message,
        )

    def _now(self):
        return self._spark.range(1).select(F.current_timestamp().cast("timestamp_ntz")).first()[0]
