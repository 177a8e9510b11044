"""Dashboard tiles: sorted or cut views of the reports. Every sort ends in columns that make it total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXAMPLES = 25
SOURCES = 15
PREVIEW = 20


def tile_volume(volume: DataFrame) -> DataFrame:
    return volume.select("ticker", "company_name", "article_count", "refreshed_at").orderBy(
        F.desc("article_count"), "ticker"
    )


def sentiment_stacked(summary: DataFrame) -> DataFrame:
    """(ticker, sentiment_label, cnt, refreshed_at): the three count columns as rows, from one scan."""
    renamed = summary.select(
        "ticker",
        "refreshed_at",
        F.col("positive_count").alias("positive"),
        F.col("neutral_count").alias("neutral"),
        F.col("negative_count").alias("negative"),
    )
    return (
        renamed.unpivot(["ticker", "refreshed_at"], ["positive", "neutral", "negative"], "sentiment_label", "cnt")
        .select("ticker", "sentiment_label", "cnt", "refreshed_at")
        .orderBy("ticker", "sentiment_label")
    )


def tile_avg_sentiment(summary: DataFrame) -> DataFrame:
    return summary.select("ticker", "company_name", "scored_articles", "avg_sentiment", "refreshed_at").orderBy(
        F.col("avg_sentiment").desc_nulls_last(), "ticker"
    )


def tile_daily_trend(trend: DataFrame) -> DataFrame:
    return trend.select("metric_date", "total_articles", "avg_sentiment_across_companies", "refreshed_at").orderBy(
        "metric_date"
    )


def tile_examples(examples: DataFrame, rows: int = EXAMPLES) -> DataFrame:
    """The rows with the strongest scores, newest first among equals."""
    return (
        examples.select(
            "ticker", "sentiment_label", "sentiment_score", "published_at", "source_name", "title", "url"
        )
        .orderBy(
            F.abs("sentiment_score").desc_nulls_last(), F.col("published_at").desc_nulls_last(), "url", "ticker"
        )
        .limit(rows)
    )


def tile_top_sources(sources: DataFrame, rows: int = SOURCES) -> DataFrame:
    return (
        sources.select("source_name", "article_count", "refreshed_at")
        .orderBy(F.desc("article_count"), "source_name")
        .limit(rows)
    )


def preview_volume(volume: DataFrame) -> DataFrame:
    return volume.orderBy(F.desc("article_count"), "ticker")


def preview_summary(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.desc("scored_articles"), "ticker")


def preview_trend(trend: DataFrame) -> DataFrame:
    return trend.orderBy(F.desc("metric_date"))


def preview_examples(examples: DataFrame, rows: int = PREVIEW) -> DataFrame:
    return examples.orderBy(
        F.abs("sentiment_score").desc_nulls_last(), F.col("published_at").desc_nulls_last(), "url", "ticker"
    ).limit(rows)


def preview_scores(sentiment: DataFrame, model_name: str, rows: int = EXAMPLES) -> DataFrame:
    """A few score rows of one model, in a fixed order."""
    return (
        sentiment.where(F.col("model_name") == model_name)
        .select("article_id", "company_id", "model_name", "sentiment_score", "sentiment_label", "reasoning")
        .orderBy("article_id", "company_id")
        .limit(rows)
    )
