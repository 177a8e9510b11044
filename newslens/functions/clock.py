"""Timestamps: lenient parsing into UTC without time zone, and bucketing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date patterns the providers send.
COMPACT_PATTERN = "yyyyMMddHHmmss"
COMPACT_ZONED_PATTERN = "yyyyMMdd'T'HHmmssX"
MAIL_PATTERN_NAMED_ZONE = "d MMM yyyy HH:mm:ss z"
MAIL_PATTERN_OFFSET = "d MMM yyyy HH:mm:ss Z"
ZONE_SUFFIX = r"(Z|[+-]\d{2}:?\d{2})\s*$"
MAIL_WEEKDAY = r"^\s*[A-Za-z]{3,9},\s*"


def _utc(ts: Column) -> Column:
    """Instant to UTC wall clock, whatever zone the session is in."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


def parse_iso(text: Column) -> Column:
    """ISO-8601 text, with or without an offset, to UTC; null where it cannot be read."""
    return F.when(text.rlike(ZONE_SUFFIX), _utc(F.try_to_timestamp(text))).otherwise(text.try_cast("timestamp_ntz"))


def parse_compact(text: Column) -> Column:
    """``yyyyMMddHHmmss`` (or its ``T``/``Z`` form) to UTC; null where it cannot be read."""
    plain = F.when(text.rlike(r"^\d{14}$"), F.try_to_timestamp(text, F.lit(COMPACT_PATTERN)).cast("timestamp_ntz"))
    return F.coalesce(plain, _utc(F.try_to_timestamp(text, F.lit(COMPACT_ZONED_PATTERN))))


def parse_mail_date(text: Column) -> Column:
    """Feed date such as ``Wed, 21 Oct 2037 07:28:00 GMT`` to UTC; null where it cannot be read."""
    bare = F.regexp_replace(text, MAIL_WEEKDAY, "")
    return F.coalesce(
        _utc(F.try_to_timestamp(bare, F.lit(MAIL_PATTERN_NAMED_ZONE))),
        _utc(F.try_to_timestamp(bare, F.lit(MAIL_PATTERN_OFFSET))),
    )


def iso_text(ts: Column) -> Column:
    """UTC timestamp as the ISO text carried on the wire, e.g. ``2024-01-02T03:04:05+00:00``."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def or_ingested(parsed: Column, ingested_at: Column) -> tuple[Column, Column]:
    """Parsed time, or the ingestion time where parsing failed, with a flag that says which it is."""
    return F.coalesce(parsed, ingested_at), parsed.isNull()


def time_bucket(ts: Column, unit: str) -> Column:
    """Start of the minute, hour or day as a timestamp without zone."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")
