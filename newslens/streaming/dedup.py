"""First event per url in a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_disk_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB instead of the executor's heap; every url ever seen is state."""
    spark.conf.set(STATE_STORE, ROCKSDB)


def dedup_stream_url(events: DataFrame) -> DataFrame:
    """Exact: one event per url_hash over the life of the stream. State grows with the number of urls, on disk."""
    return events.dropDuplicates(["url_hash"])


def dedup_stream_url_bounded(events: DataFrame, arrival: str = "kafka_timestamp", within: str = "1 day") -> DataFrame:
    """Bounded: one event per url_hash within a time span of arrival; what has not been seen for longer may return.

    The watermark is on arrival, never on the publishing time: backfilled history arrives on the same topic and would be
    late as a whole. A url that returns is caught by the latest-row tables downstream.
    """
    return events.withWatermark(arrival, within).dropDuplicatesWithinWatermark(["url_hash"])
