"""What a micro-batch writes: match rows, base rows and the minutes they touch.

Every write is distributed and replaces what an earlier attempt at the same batch has written, so a batch that is
delivered again changes nothing. The row tables are partitioned by publishing day, then batch: a batch lists and rereads
only the days it touches, not a directory of all batches there ever were.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from newslens.functions.sentiment import Scorer
from newslens.operators.marts import minute_mart
from newslens.operators.matching import match_substring
from newslens.schemas import BASE_COLUMNS, MATCH_COLUMNS
from newslens.sources.tables import overwrite_partition, overwrite_touched, path_exists

DAY = "published_date"

TYPES = {
    "published_at_ts": "timestamp_ntz",
    "event_ingested_at_ts": "timestamp_ntz",
    "loaded_at": "timestamp_ntz",
    "company_id": "bigint",
    "sentiment_score": "double",
}
BASE_TYPES = {name: TYPES.get(name, "string") for name in BASE_COLUMNS if name != "ingest_batch_id"}
MATCH_TYPES = {name: TYPES.get(name, "string") for name in MATCH_COLUMNS}


@dataclass(frozen=True)
class RealtimeTables:
    """Where the realtime tables are."""

    root: str

    @property
    def base(self) -> str:
        return f"{self.root}/article_company_match_base"

    @property
    def match(self) -> str:
        return f"{self.root}/article_company_match"

    @property
    def batches(self) -> str:
        """Which days each batch has written to."""
        return f"{self.root}/batch_days"

    @property
    def minute(self) -> str:
        return f"{self.root}/mart_company_sentiment_minute"


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for the jobs of a micro-batch. The session of a stateful stream has it off for the stream's own plan, which is run by then,
    and without it ``rebalance`` is dropped without a word: every task would write a file to every day."""
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def matched_rows(events: DataFrame, aliases: DataFrame, scorer: Scorer) -> DataFrame:
    """One scored row per (event, company) of a batch of normalised events."""
    return match_substring(events, aliases, per_alias_hit=False, scorer=scorer)


def _write_batch(rows: DataFrame, path: str, batch_id: int, gone: set[date]) -> None:
    """Replace the rows of one batch: in the days it has, and by nothing in those only an earlier attempt had.

    ``rebalance`` gives each day few files of even size, splitting a day that holds most of the batch. It needs ``adaptive``.
    """
    overwrite_touched(rows.hint("rebalance", DAY), path, [DAY, "ingest_batch_id"])
    for day in gone:
        overwrite_partition(rows.limit(0).drop(DAY), f"{path}/{DAY}={day}", "ingest_batch_id", batch_id)


def _read(spark: SparkSession, path: str, columns: dict[str, str], days: set[date] | None = None) -> DataFrame:
    """A realtime table, or some days of it: then only their directories are listed, however many batches there are."""
    ddl = ", ".join(f"{name} {kind}" for name, kind in columns.items())
    paths = [path] if days is None else [f"{path}/{DAY}={day}" for day in sorted(days)]
    reader = spark.read.schema(f"{ddl}, {DAY} date, ingest_batch_id string").option("basePath", path)
    return reader.parquet(*paths)


def read_base(spark: SparkSession, tables: RealtimeTables, days: set[date] | None = None) -> DataFrame:
    return _read(spark, tables.base, BASE_TYPES, days).select(*BASE_COLUMNS, DAY)


def read_match(spark: SparkSession, tables: RealtimeTables) -> DataFrame:
    return _read(spark, tables.match, MATCH_TYPES).select(*MATCH_COLUMNS, "ingest_batch_id", DAY)


def read_minutes(spark: SparkSession, tables: RealtimeTables) -> DataFrame:
    ddl = "bucket_minute timestamp_ntz, company_id bigint, article_count bigint, avg_sentiment double, bucket_date date"
    return spark.read.schema(ddl).parquet(tables.minute).drop("bucket_date")


def refresh_minutes(spark: SparkSession, tables: RealtimeTables, days: set[date]) -> None:
    """Recompute the minute mart of the given days from the base rows of those days.

    Averages and distinct counts of two batches do not add up, so a minute that got rows is counted anew. A day that has
    lost its rows (a batch delivered again with fewer) is emptied.
    """
    rows = read_base(spark, tables, days)
    mart = minute_mart(rows, per_alias_hit=True).withColumn("bucket_date", F.col("bucket_minute").cast("date"))
    overwrite_touched(mart.hint("rebalance", "bucket_date"), tables.minute, ["bucket_date"])
    for day in days - _days(rows):
        overwrite_partition(mart.limit(0), tables.minute, "bucket_date", day)


def _days(rows: DataFrame) -> set[date]:
    return {row[0] for row in rows.select(DAY).distinct().collect()}


def _earlier_attempt(spark: SparkSession, tables: RealtimeTables, batch_id: int) -> set[date]:
    """Days that an earlier attempt at this batch may have written to."""
    path = f"{tables.batches}/ingest_batch_id={batch_id}"
    return _days(spark.read.schema(f"{DAY} date").parquet(path)) if path_exists(spark, path) else set()


def _note_attempt(rows: DataFrame, tables: RealtimeTables, batch_id: int, earlier: set[date]) -> None:
    """Note the days before anything is written to them, so that an attempt that dies half-way can be undone."""
    days = rows.select(DAY).distinct()
    if earlier:
        known = ", ".join(f"DATE '{day}'" for day in sorted(earlier))
        days = days.union(rows.sparkSession.sql(f"SELECT explode(array({known}))")).distinct()
    overwrite_partition(days.withColumn("ingest_batch_id", F.lit(batch_id)), tables.batches, "ingest_batch_id", batch_id)


def micro_batch_writer(
    tables: RealtimeTables, aliases: Callable[[SparkSession], DataFrame], scorer: Scorer
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function. Aliases are read anew for each batch, so new ones take effect at once."""

    def write(events: DataFrame, batch_id: int) -> None:
        spark = events.sparkSession
        rows = (
            matched_rows(events, aliases(spark), scorer)
            .withColumn("loaded_at", F.current_timestamp().cast("timestamp_ntz"))
            .withColumn("ingest_batch_id", F.lit(str(batch_id)))
            .withColumn(DAY, F.col("published_at_ts").cast("date"))
            .select(*BASE_COLUMNS, DAY)
            .persist(StorageLevel.MEMORY_AND_DISK)
        )
        try:
            with adaptive(spark):
                days, earlier = _days(rows), _earlier_attempt(spark, tables, batch_id)
                if not days and not earlier:
                    return
                _note_attempt(rows, tables, batch_id, earlier)
                _write_batch(rows, tables.base, batch_id, earlier - days)
                _write_batch(rows.select(*MATCH_COLUMNS, "ingest_batch_id", DAY), tables.match, batch_id, earlier - days)
                refresh_minutes(spark, tables, days | earlier)
        finally:
            rows.unpersist()

    return write
