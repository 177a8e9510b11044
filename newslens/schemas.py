"""Fixed schemas: the wire format of an article event and the columns of the tables built from it."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the article event on the topic, all nullable strings.
EVENT_FIELDS = (
    "event_id",
    "provider",
    "provider_article_id",
    "published_at",
    "title",
    "description",
    "content",
    "source_name",
    "url",
    "author",
    "language",
    "country",
    "event_ingested_at",
)

EVENT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in EVENT_FIELDS])

# Columns of the unified mention table, in order.
UNIFIED_COLUMNS = (
    "record_id",
    "provider",
    "source_name",
    "url",
    "canonical_url_hash",
    "published_at_ts",
    "company_id",
    "sentiment_score",
    "sentiment_label",
    "article_text",
    "loaded_at",
    "sentiment_model",
    "ingest_path",
)

# Columns of the append-only realtime base table, in order.
BASE_COLUMNS = (
    "event_id",
    "provider",
    "provider_article_id",
    "url",
    "url_hash",
    "published_at_ts",
    "event_ingested_at_ts",
    "company_id",
    "sentiment_score",
    "source_name",
    "article_text",
    "ingest_batch_id",
    "loaded_at",
)

# Columns of the narrow realtime match table, in order.
MATCH_COLUMNS = (
    "event_id",
    "url_hash",
    "published_at_ts",
    "company_id",
    "sentiment_score",
    "source_name",
    "loaded_at",
)

# Columns a batch article row carries into the upsert.
ARTICLE_COLUMNS = (
    "provider_article_id",
    "source_name",
    "author",
    "title",
    "description",
    "content",
    "url_hash",
    "published_at",
    "language",
    "country",
    "raw_json",
    "load_batch_id",
)

RUN_LOG_SCHEMA = (
    "run_id string, pipeline string, run_type string, source_name string, run_started_at timestamp_ntz, "
    "run_finished_at timestamp_ntz, status string, records_read bigint, records_written bigint, error_message string"
)

FAILED_WINDOW_SCHEMA = (
    "recorded_at string, window_start string, window_end string, attempts bigint, error_type string, error string, "
    "skipped boolean, skipped_count bigint, consecutive_failures bigint"
)
