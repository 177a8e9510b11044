"""The minute mart of a stream kept up by windows with a watermark: open minutes are state, late rows are listed instead of lost.

Spark's own windows drop a late row without a word and cannot count distinct articles. Here a shard of an hour is one keyed state that holds its open minutes: sum and number of
scores and the articles by company. A micro-batch yields the new totals of the minutes it touches (update mode), so its cost grows with its rows, not with the day. A row whose
minute had ended at the watermark is yielded as late. A timer drops the hour once the watermark has passed it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from newslens.functions.clock import time_bucket
from newslens.sources.tables import empty, path_exists

DELAY = "10 minutes"
SHARDS = 16  # by the article's hash, so the articles of two shards are different and counts add up
MINUTE_MS, HOUR_MS = 60_000, 3_600_000
BATCH = "written_batch"
TOTALS_DDL = "minute_ms bigint, company_id bigint, shard bigint, article_count bigint, score_sum decimal(38,12), score_count bigint"
LATE_DDL = "event_id string, company_id bigint, url_hash string, published_ms bigint, sentiment_score double, watermark_ms bigint"
UPDATES_DDL = f"late boolean, {TOTALS_DDL}, event_id string, url_hash string, published_ms bigint, sentiment_score double, watermark_ms bigint"
_NAMES = [field.strip().split(" ")[0] for field in UPDATES_DDL.replace("(38,12)", "").split(",")]


def _update(**values) -> Row:
    return Row(**{name: values.get(name) for name in _NAMES})


class OpenMinutes(StatefulProcessor):
    """One shard of one hour: {minute: {company: [sum, number of scores, articles]}} as text, the sum in decimal digits."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("minutes", "minutes string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        hour, shard = key
        watermark = timerValues.getCurrentWatermarkInMs()
        known = self._state.get()
        minutes = json.loads(known[0]) if known else {}
        touched, seen = set(), {}
        for row in rows:
            minute = row.published_ms - row.published_ms % MINUTE_MS
            if minute + MINUTE_MS <= watermark:
                yield _update(late=True, event_id=row.event_id, company_id=row.company_id, url_hash=row.url_hash, published_ms=row.published_ms,
                              sentiment_score=row.sentiment_score, watermark_ms=watermark)
                continue
            place = (str(minute), json.dumps(row.company_id))
            total = minutes.setdefault(place[0], {}).setdefault(place[1], ["0", 0, []])
            if row.exact_score is not None:
                total[0], total[1] = str(Decimal(total[0]) + row.exact_score), total[1] + 1
            if row.url_hash is not None:
                seen.setdefault(place, set(total[2])).add(row.url_hash)
            touched.add(place)
        for place, articles in seen.items():
            minutes[place[0]][place[1]][2] = sorted(articles)
        for minute, company in sorted(touched):
            score_sum, scores, articles = minutes[minute][company]
            yield _update(late=False, minute_ms=int(minute), company_id=json.loads(company), shard=shard, article_count=len(articles),
                          score_sum=Decimal(score_sum) if scores else None, score_count=scores)
        if touched:
            self._state.update((json.dumps(minutes),))
            self._handle.registerTimer(hour + HOUR_MS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._state.clear()
        return iter(())

    def close(self) -> None:
        """State is closed by Spark."""


def minute_updates(matched: DataFrame, delay: str = DELAY, shards: int = SHARDS) -> DataFrame:
    """Updates of a stream of matched rows, one per (event, company): new totals of touched minutes (``late`` false) and late rows.

    Rows without a time have no window and are left out, as with any window. The watermark is the latest publishing time of earlier micro-batches less ``delay``. Spark itself
    would drop rows behind the watermark before the state sees them, so the state's input carries the time as a number. Needs the disk state store (``use_disk_state``).
    """
    timed = matched.where(F.col("published_at_ts").isNotNull()).withColumn("event_time", F.col("published_at_ts").cast("timestamp"))
    rows = timed.withWatermark("event_time", delay).select(
        F.unix_millis(time_bucket(F.col("published_at_ts"), "hour").cast("timestamp")).alias("hour_ms"),
        F.pmod(F.xxhash64(F.coalesce("url_hash", "event_id")), F.lit(shards)).alias("shard"),
        F.unix_millis(F.col("published_at_ts").cast("timestamp")).alias("published_ms"),
        "event_id", F.col("company_id").cast("bigint").alias("company_id"), "url_hash",
        F.col("sentiment_score").cast("double").alias("sentiment_score"), F.col("sentiment_score").cast("decimal(28,12)").alias("exact_score"),
    )
    return rows.groupBy("hour_ms", "shard").transformWithState(OpenMinutes(), UPDATES_DDL, outputMode="Update", timeMode="EventTime")


def _names(ddl: str) -> list[str]:
    return [name for name in _NAMES if f"{name} " in ddl]


def update_writer(root: str) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: totals and late rows of a batch, each replacing what an earlier attempt at it has written."""

    def write(updates: DataFrame, batch_id: int) -> None:
        updates = updates.persist()
        try:
            for late, table, ddl in ((False, "totals", TOTALS_DDL), (True, "late", LATE_DDL)):
                rows = updates.where(F.col("late") == late).select(*_names(ddl))
                rows.write.mode("overwrite").parquet(f"{root}/{table}/{BATCH}={batch_id}")
        finally:
            updates.unpersist()

    return write


def start(matched: DataFrame, root: str, checkpoint: str, delay: str = DELAY, trigger: str | None = None, shards: int = SHARDS) -> StreamingQuery:
    """Keep up the minute mart at ``root``. ``trigger=None`` works off what is there and stops."""
    writer = minute_updates(matched, delay, shards).writeStream.queryName("minute_windows").outputMode("update")
    writer = writer.option("checkpointLocation", checkpoint).foreachBatch(update_writer(root))
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()


def _read(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    schema = f"{ddl}, {BATCH} bigint"
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else empty(spark, schema)


def _time(ms: str) -> Column:
    return F.timestamp_millis(F.col(ms)).cast("timestamp_ntz")


def read_minutes(spark: SparkSession, root: str) -> DataFrame:
    """The mart: of each minute, company and shard the latest totals, then all shards together."""
    key = ["minute_ms", "company_id", "shard"]
    newest = F.max_by(F.struct("article_count", "score_sum", "score_count"), BATCH).alias("newest")
    totals = _read(spark, f"{root}/totals", TOTALS_DDL).groupBy(*key).agg(newest).select("minute_ms", "company_id", "newest.*")
    mean = F.try_divide(F.sum("score_sum").cast("double"), F.sum("score_count").cast("double"))
    merged = totals.groupBy("minute_ms", "company_id").agg(F.sum("article_count").alias("article_count"), mean.alias("avg_sentiment"))
    return merged.select(_time("minute_ms").alias("bucket_minute"), "company_id", "article_count", "avg_sentiment")


def read_late(spark: SparkSession, root: str) -> DataFrame:
    """Late rows with the watermark they missed."""
    late = _read(spark, f"{root}/late", LATE_DDL)
    return late.select(
        "event_id", "company_id", "url_hash", _time("published_ms").alias("published_at_ts"), "sentiment_score", _time("watermark_ms").alias("watermark")
    )
