"""One row per key, and reports on keys that have more.

``keep_first`` is a row number kept at 1. Spark turns that into a group limit that runs before the shuffle as well, so
a key that holds a third of all rows leaves each task as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.functions.text import strip_all


def keep_first(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order. End the order with a unique column, or ties are arbitrary."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") == 1).drop("_rn")


def newest(column: str) -> Column:
    return F.col(column).desc_nulls_last()


def dedup_event_company(matched: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """One row per (event_id, company_id) of a batch."""
    order = order or [F.col("published_at_ts").asc_nulls_last(), F.col("url_hash").asc_nulls_last()]
    return keep_first(matched, ["event_id", "company_id"], order)


def latest_event_company(base: DataFrame) -> DataFrame:
    """Newest load per (event_id, company_id) of the append-only base table."""
    return keep_first(base, ["event_id", "company_id"], [newest("loaded_at"), newest("ingest_batch_id")])


def article_key(url_hash: Column | str, path: Column | str, record_id: Column | str) -> Column:
    """Identity of an article over both paths: its url's hash, else its own record."""
    return F.coalesce(url_hash, F.concat(F.lit("record:"), path, F.lit(":"), record_id))


def latest_url_company(unified: DataFrame) -> DataFrame:
    """Newest load per (canonical_url_hash, company_id) over both paths.

    A row without hash and url is its own article, so it is keyed by its record instead.
    """
    keyed = unified.withColumn("_key", article_key("canonical_url_hash", "ingest_path", "record_id"))
    order = [newest("loaded_at"), newest("record_id"), F.col("ingest_path").asc()]
    return keep_first(keyed, ["_key", "company_id"], order).drop("_key")


def latest_sentiment(sentiment: DataFrame) -> DataFrame:
    """Newest score per (article_id, company_id); of equal times the smallest sentiment_id."""
    return keep_first(sentiment, ["article_id", "company_id"], [newest("scored_at"), F.col("sentiment_id").asc()])


def duplicate_loads(base: DataFrame) -> DataFrame:
    """(event_id, company_id) loaded more than once, with first and last load."""
    return (
        base.groupBy("event_id", "company_id")
        .agg(
            F.count(F.lit(1)).alias("duplicate_count"),
            F.min("loaded_at").alias("first_loaded_at"),
            F.max("loaded_at").alias("last_loaded_at"),
        )
        .where(F.col("duplicate_count") > 1)
    )


def _duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)
    return counted.orderBy(F.desc("row_count"), *keys)


def duplicate_aliases(dim_aliases: DataFrame) -> DataFrame:
    return _duplicate_keys(dim_aliases, "company_id", "alias")


def duplicate_mentions(mentions: DataFrame) -> DataFrame:
    return _duplicate_keys(mentions, "article_id", "company_id")


def dedup_aliases(dim_aliases: DataFrame) -> DataFrame:
    """Smallest alias_id per (company_id, alias)."""
    return keep_first(dim_aliases, ["company_id", "alias"], [F.col("alias_id").asc()])


def dedup_mentions(mentions: DataFrame) -> DataFrame:
    """Newest created_at per (article_id, company_id); of equal times the smallest mention_id."""
    return keep_first(mentions, ["article_id", "company_id"], [newest("created_at"), F.col("mention_id").asc()])


def dedup_url_batch(events: DataFrame, order: list[Column]) -> DataFrame:
    """First event per url of a backfill run. Here the url is stripped of all white space, not of spaces only."""
    keyed = events.withColumn("_key", F.sha2(F.lower(strip_all("url")), 256))
    return keep_first(keyed, ["_key"], order).drop("_key")
