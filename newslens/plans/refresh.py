"""The reporting refresh: the unified table once, then the reports that read it.

The unified table is written before the reports run, which cuts the lineage and lets five reports share one evaluation
of the two paths. ``refresh_incremental`` works out
only the keys that a row of any source table has touched since its mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.operators import late
from newslens.operators.dedup import article_key, latest_event_company, latest_url_company
from newslens.operators.marts import article_volume, daily_trend, sentiment_examples, sentiment_summary, top_sources
from newslens.operators.mentions import (
    BATCH_PATH,
    REALTIME_PATH,
    batch_mentions,
    canonical_hash,
    realtime_mentions,
    unify_paths,
)
from newslens.sources.tables import current, publish, rebuild
from newslens.session import working_path

KEY = ["_key", "company_id"]


def unify(
    articles: DataFrame, mentions: DataFrame, sentiment: DataFrame, base: DataFrame, trust_stored_hash: bool = False
) -> DataFrame:
    """Rows of both paths before the newest per (url, company) is picked."""
    return unify_paths(
        batch_mentions(articles, mentions, sentiment, trust_stored_hash),
        realtime_mentions(latest_event_company(base), trust_stored_hash),
    )


def refresh(rows: DataFrame, companies: DataFrame, root: str) -> dict[str, DataFrame]:
    """Rebuild the unified table from the rows of both paths, and the five reports from it.

    The rows are written once; which of them stay is found from their narrow columns, so texts are in no window and no shuffle after that.
    """
    unified = rebuild(late.latest_url_company(late.stored(rows)), f"{root}/unified")
    return {"unified": unified, **reports(unified, companies, root)}


def reports(unified: DataFrame, companies: DataFrame, root: str) -> dict[str, DataFrame]:
    return {
        "article_volume": rebuild(article_volume(unified, companies), f"{root}/article_volume"),
        "sentiment_summary": rebuild(sentiment_summary(unified, companies), f"{root}/sentiment_summary"),
        "daily_trend": rebuild(daily_trend(unified), f"{root}/daily_trend"),
        "sentiment_examples": rebuild(sentiment_examples(unified, companies), f"{root}/sentiment_examples"),
        "top_sources": rebuild(top_sources(unified), f"{root}/top_sources"),
    }


#: Column of each source table that says when a row came.
MARKED = {"articles": "ingested_at", "mentions": "created_at", "sentiment": "scored_at", "base": "loaded_at"}


def _late(table: DataFrame, name: str, marks: dict[str, Column]) -> DataFrame:
    return table.where(F.col(MARKED[name]) > marks[name])


def refresh_unified_incremental(
    previous: DataFrame, articles: DataFrame, mentions: DataFrame, sentiment: DataFrame, base: DataFrame,
    marks: dict[str, Column],
) -> DataFrame:
    """The unified table after rows later than the marks (one for each table of MARKED) came to any source table.

    The keys (article, company) of late mentions, scores, articles and events are worked out anew from both paths, the others stay. Marks
    are compared before any window, so only late rows are looked at to find the keys. Rows that are committed with a time
    before their table's mark, and deletions, need a full refresh.
    """
    spark, pair, event = previous.sparkSession, ["article_id", "company_id"], ["event_id", "company_id"]
    batch_key = article_key(canonical_hash(F.col("url"), F.col("url_hash"), False), F.lit(BATCH_PATH), F.col("article_id").cast("string"))
    live_key = article_key(canonical_hash(F.col("url"), F.col("url_hash"), False), F.lit(REALTIME_PATH), F.col("event_id"))
    article_keys = articles.select("article_id", batch_key.alias("_key"))
    late_articles = mentions.join(_late(articles, "articles", marks).select("article_id"), "article_id", "left_semi")
    late_pairs = (
        _late(mentions, "mentions", marks).select(*pair)
        .unionByName(_late(sentiment, "sentiment", marks).select(*pair))
        .unionByName(late_articles.select(*pair))
    )
    keyed_base = base.select(*event, live_key.alias("_key"))
    late_events = _late(base, "base", marks).select(*event).distinct()
    live = keyed_base.join(late_events, event, "left_semi").select(*KEY)  # also the keys that an event had before
    path = working_path(spark, "touched")
    late_pairs.join(article_keys, "article_id").select(*KEY).unionByName(live).distinct().write.parquet(path)
    touched = spark.read.parquet(path)
    own_mentions = mentions.join(article_keys, "article_id").join(touched, KEY, "left_semi").drop("_key")
    own_events = keyed_base.join(touched, KEY, "left_semi").select(*event).distinct()
    rows = unify(articles, own_mentions, sentiment, base.join(own_events, event, "left_semi"))
    key = article_key("canonical_url_hash", "ingest_path", "record_id")
    fresh = latest_url_company(rows.withColumn("_key", key).join(touched, KEY, "left_semi").drop("_key"))
    kept = previous.withColumn("_key", key).join(touched, KEY, "left_anti").select(*previous.columns)
    return kept.unionByName(fresh.select(*previous.columns))


def refresh_incremental(
    articles: DataFrame, mentions: DataFrame, sentiment: DataFrame, base: DataFrame, marks: dict[str, Column],
    companies: DataFrame, root: str,
) -> dict[str, DataFrame]:
    """Refresh from what came after the marks; a full refresh if there is no unified table yet."""
    spark: SparkSession = articles.sparkSession
    previous = current(spark, f"{root}/unified")
    if previous is None:
        return refresh(unify(articles, mentions, sentiment, base), companies, root)
    publish(refresh_unified_incremental(previous, articles, mentions, sentiment, base, marks), f"{root}/unified")
    unified = current(spark, f"{root}/unified")
    return {"unified": unified, **reports(unified, companies, root)}
