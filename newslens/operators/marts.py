"""Counts and averages per company and time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions.text import title_preview
from newslens.functions.aggregates import exact_avg, label_counts, rounded_avg
from newslens.functions.clock import time_bucket
from newslens.operators.mentions import AI_MODEL, source_or_unknown

# --- realtime marts ---------------------------------------------------------------------------------------------------


def bucket_mart(matched: DataFrame, unit: str, per_alias_hit: bool = False) -> DataFrame:
    """(bucket_<unit>, company_id): distinct articles and mean score.

    The rows are one per (event, company), so each article weighs once. Rows that are one per alias hit would weigh an
    article as often as it has aliases; ``per_alias_hit=True`` takes them as they are, otherwise they are reduced to
    one per (event, company) inside the aggregate: the rows of one bucket, company and event are averaged before the
    bucket is. Both levels count on each task first, so a bucket or company with a third of all rows is no hot spot.
    """
    bucket = f"bucket_{unit}"
    keyed = matched.withColumn(bucket, time_bucket(F.col("published_at_ts"), unit))
    if not per_alias_hit:
        keyed = keyed.groupBy(bucket, "company_id", "event_id").agg(
            F.min("url_hash").alias("url_hash"), F.max("sentiment_score").alias("sentiment_score")
        )
    return keyed.groupBy(bucket, "company_id").agg(
        F.count_distinct("url_hash").alias("article_count"), exact_avg(F.col("sentiment_score")).alias("avg_sentiment")
    )


def minute_mart(matched: DataFrame, per_alias_hit: bool = False) -> DataFrame:
    return bucket_mart(matched, "minute", per_alias_hit)


def hour_mart(matched: DataFrame, per_alias_hit: bool = False) -> DataFrame:
    """Hour grain from the base rows; minute averages are not averaged again."""
    return bucket_mart(matched, "hour", per_alias_hit)


# --- reports on the unified table -------------------------------------------------------------------------------------


def with_company(per_company: DataFrame, companies: DataFrame) -> DataFrame:
    """Company names for rows that are one per company: the small table is joined after the aggregate, not before."""
    return companies.select("company_id", "ticker", "company_name").join(per_company, "company_id")


def article_volume(unified: DataFrame, companies: DataFrame) -> DataFrame:
    counted = unified.groupBy("company_id").agg(
        F.count(F.lit(1)).alias("article_count"), F.max("loaded_at").alias("refreshed_at")
    )
    return with_company(counted, companies)


def sentiment_summary(unified: DataFrame, companies: DataFrame) -> DataFrame:
    summed = unified.groupBy("company_id").agg(
        F.count(F.lit(1)).alias("scored_articles"),
        rounded_avg(F.col("sentiment_score")).alias("avg_sentiment"),
        *label_counts(),
        F.max("loaded_at").alias("refreshed_at"),
    )
    return with_company(summed, companies)


def daily_trend(unified: DataFrame) -> DataFrame:
    """Per publishing day: rows and the mean over rows."""
    return unified.groupBy(F.col("published_at_ts").cast("date").alias("metric_date")).agg(
        F.count(F.lit(1)).alias("total_articles"),
        rounded_avg(F.col("sentiment_score")).alias("avg_sentiment_across_companies"),
        F.max("loaded_at").alias("refreshed_at"),
    )


def sentiment_examples(unified: DataFrame, companies: DataFrame) -> DataFrame:
    """Detail rows with their company, the text cut to a preview."""
    return unified.join(companies.select("company_id", "ticker", "company_name"), "company_id").select(
        "ticker",
        "company_name",
        "provider",
        "ingest_path",
        "sentiment_label",
        "sentiment_score",
        F.col("published_at_ts").alias("published_at"),
        "source_name",
        title_preview("article_text").alias("title"),
        "url",
        F.col("sentiment_model").alias("reasoning"),
        F.col("loaded_at").alias("refreshed_at"),
    )


def top_sources(unified: DataFrame) -> DataFrame:
    """(url, company) rows per source."""
    return unified.groupBy(source_or_unknown().alias("source_name")).agg(
        F.count(F.lit(1)).alias("article_count"), F.max("loaded_at").alias("refreshed_at")
    )


def provider_counts(unified: DataFrame) -> DataFrame:
    return unified.groupBy("provider").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), "provider")


# --- batch marts and reports ------------------------------------------------------------------------------------------


def daily_mart(
    articles: DataFrame, mentions: DataFrame, sentiment: DataFrame, as_of: Column, model_name: str | None = AI_MODEL
) -> DataFrame:
    """(metric_date, company_id): distinct articles, mean score and rows per label.

    The model is chosen on the sentiment side before the left join, so mentions without a score of that model stay.
    With ``model_name=None`` every model's rows count.
    """
    keys = ["article_id", "company_id"]
    chosen = sentiment if model_name is None else sentiment.where(F.col("model_name") == model_name)
    dated = articles.where(F.col("published_at").isNotNull()).select(
        "article_id", F.col("published_at").cast("date").alias("metric_date")
    )
    scored = mentions.select(*keys).join(chosen.select(*keys, "sentiment_score", "sentiment_label"), keys, "left")
    return (
        dated.join(scored, "article_id")
        .groupBy("metric_date", "company_id")
        .agg(
            F.count_distinct("article_id").alias("article_count"),
            exact_avg(F.col("sentiment_score")).alias("avg_sentiment"),
            *label_counts(),
        )
        .withColumn("updated_at", as_of)
    )


def article_volume_batch(mentions: DataFrame, companies: DataFrame, as_of: Column) -> DataFrame:
    """Distinct articles per company."""
    counted = mentions.groupBy("company_id").agg(F.count_distinct("article_id").alias("article_count"))
    return with_company(counted, companies).withColumn("refreshed_at", as_of)


def sentiment_summary_batch(
    sentiment: DataFrame, companies: DataFrame, as_of: Column, model_name: str = AI_MODEL
) -> DataFrame:
    summed = (
        sentiment.where(F.col("model_name") == model_name)
        .groupBy("company_id")
        .agg(
            F.count(F.lit(1)).alias("scored_articles"),
            rounded_avg(F.col("sentiment_score")).alias("avg_sentiment"),
            *label_counts(),
        )
    )
    return with_company(summed, companies).withColumn("refreshed_at", as_of)


def daily_trend_batch(mart: DataFrame, as_of: Column) -> DataFrame:
    """Per day: sum of the companies' counts and mean of the companies' means (not the mean over rows)."""
    return (
        mart.groupBy("metric_date")
        .agg(
            F.sum("article_count").alias("total_articles"),
            rounded_avg(F.col("avg_sentiment")).alias("avg_sentiment_across_companies"),
        )
        .withColumn("refreshed_at", as_of)
    )


def sentiment_examples_batch(
    sentiment: DataFrame, companies: DataFrame, articles: DataFrame, as_of: Column, model_name: str = AI_MODEL
) -> DataFrame:
    scored = sentiment.where(F.col("model_name") == model_name).select(
        "article_id", "company_id", "sentiment_label", "sentiment_score", "reasoning"
    )
    return (
        articles.select("article_id", "published_at", "source_name", "title", "url")
        .join(scored, "article_id")
        .join(companies.select("company_id", "ticker", "company_name"), "company_id")
        .select(
            "ticker", "company_name", "sentiment_label", "sentiment_score", "published_at", "source_name", "title",
            "url", "reasoning", as_of.alias("refreshed_at"),
        )
    )


def matching_quality(articles: DataFrame, mentions: DataFrame) -> DataFrame:
    """Articles in all, with a mention, and without.

    Both sides are reduced to distinct ids by the key of the join, which keeps it to one shuffle a side and avoids
    expanding every row for two distinct counts.
    """
    ids = articles.select("article_id").where(F.col("article_id").isNotNull()).distinct()
    mentioned = mentions.select("article_id").distinct().withColumn("_hit", F.lit(True))
    return (
        ids.join(mentioned, "article_id", "left")
        .agg(F.count(F.lit(1)).alias("total_articles"), F.count("_hit").alias("matched_articles"))
        .withColumn("unmatched_articles", F.col("total_articles") - F.col("matched_articles"))
    )


def label_distribution(sentiment: DataFrame, model_name: str = AI_MODEL) -> DataFrame:
    return (
        sentiment.where(F.col("model_name") == model_name)
        .groupBy("sentiment_label")
        .agg(F.count(F.lit(1)).alias("row_count"), rounded_avg(F.col("sentiment_score")).alias("avg_score"))
        .orderBy(F.desc("row_count"), "sentiment_label")
    )


def model_row_count(sentiment: DataFrame, model_name: str = AI_MODEL) -> DataFrame:
    return sentiment.where(F.col("model_name") == model_name).agg(F.count(F.lit(1)).alias("total_ai_rows"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in sorted(tables.items())
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result.orderBy("table_name")
