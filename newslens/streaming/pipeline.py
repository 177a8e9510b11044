"""Messages to realtime tables: parse, normalise, deduplicate, match, score, write."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from newslens.functions.sentiment import Scorer
from newslens.functions.text import article_text
from newslens.sources.envelope import normalize_events, parse_envelope
from newslens.streaming.dedup import dedup_stream_url, dedup_stream_url_bounded, use_disk_state
from newslens.streaming.sink import RealtimeTables, micro_batch_writer

TRIGGER = "45 seconds"


def clean_events(messages: DataFrame, dedup_within: str | None = None) -> DataFrame:
    """Normalised events, the first per url; ``dedup_within`` bounds the state by time of arrival.

    The joined text is put together again behind the shuffle to the state, or every text would travel twice.
    """
    events = normalize_events(parse_envelope(messages)).drop("article_text")
    first = dedup_stream_url_bounded(events, within=dedup_within) if dedup_within else dedup_stream_url(events)
    return first.withColumn("article_text", article_text("title", "description", "content"))


def start(
    messages: DataFrame,
    tables: RealtimeTables,
    aliases: Callable[[SparkSession], DataFrame],
    scorer: Scorer,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    dedup_within: str | None = None,
) -> StreamingQuery:
    """Start the pipeline. ``trigger=None`` works off what is there and stops (backfills and tests)."""
    use_disk_state(messages.sparkSession)
    writer = (
        clean_events(messages, dedup_within)
        .writeStream.queryName("realtime_mentions")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(micro_batch_writer(tables, aliases, scorer))
    )
    timed = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return timed.start()
