"""The batch job: landed responses to articles, mentions, scores and the daily mart, all as published tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.functions.sentiment import Scorer
from newslens.operators.marts import daily_mart
from newslens.operators.matching import match_best_alias
from newslens.operators.mentions import score_mentions
from newslens.operators.numbering import number_inserted
from newslens.operators.quality import RunLog
from newslens.operators.upsert import upsert, upsert_articles, upsert_daily_mart, upsert_mentions
from newslens.sources.providers import BATCH_PROVIDER, batch_articles, rejects
from newslens.sources.tables import current, empty, publish, rebuild

BATCH_MODEL = "rule_based_v1"
TABLES = {
    "articles": "article_id bigint, provider string, url string, provider_article_id string, source_name string, author string, title string, "
    "description string, content string, url_hash string, published_at timestamp_ntz, language string, country string, load_batch_id string, "
    "ingested_at timestamp_ntz, is_duplicate boolean",
    "mentions": "mention_id bigint, article_id bigint, company_id bigint, match_method string, confidence double, matched_text string, "
    "mention_context string, created_at timestamp_ntz",
    "sentiment": "sentiment_id bigint, article_id bigint, company_id bigint, model_name string, sentiment_score double, sentiment_label string, "
    "reasoning string, scored_at timestamp_ntz",
    "daily_mart": "metric_date date, company_id bigint, article_count bigint, avg_sentiment double, positive_count bigint, neutral_count bigint, "
    "negative_count bigint, updated_at timestamp_ntz",
}


def stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table as last published, empty before the first run."""
    table = current(spark, f"{root}/{name}")
    return empty(spark, TABLES[name]) if table is None else table


def run_batch(
    payloads: DataFrame, dim_aliases: DataFrame, scorer: Scorer | DataFrame, root: str, run_id: str, loaded_at: Column
) -> dict[str, DataFrame]:
    """One run over landed responses (body, ingested_at). ``loaded_at`` is the time of the run and differs between runs.

    Responses that cannot be used go to ``rejects``. Articles are upserted by (provider, url) and new ones numbered; only the articles of
    this run are matched and scored, and only their days of the mart worked out anew. Every table is published as its next version; a
    run that dies can be repeated: it finds the keys it has inserted and updates them.
    """
    spark = payloads.sparkSession

    def replaced(name: str, made: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return rebuild(made(stored(spark, root, name)), f"{root}/{name}")

    with RunLog(spark, f"{root}/run_log", run_id, "batch", "scheduled", BATCH_PROVIDER) as log:
        usable = batch_articles(log.reading(payloads), F.lit(run_id)).drop("raw_json")
        articles = replaced("articles", lambda old: upsert_articles(old, usable, loaded_at, F.col("sequence")))
        publish(rejects(payloads).withColumn("run_id", F.lit(run_id)), f"{root}/rejects")
        count = current(spark, f"{root}/rejects").count()
        if count:
            log.problem(f"{count} responses could not be used")
        own = articles.where(F.col("ingested_at") == loaded_at)
        mentions = replaced("mentions", lambda old: upsert_mentions(old, match_best_alias(own, dim_aliases), loaded_at))
        touched = mentions.join(own.select("article_id"), "article_id", "left_semi")
        keys = ["article_id", "company_id", "model_name"]
        scores = score_mentions(touched, own, scorer, BATCH_MODEL, loaded_at)

        def rescored(old: DataFrame) -> DataFrame:
            fields = ["sentiment_score", "sentiment_label", "reasoning", "scored_at"]
            return number_inserted(upsert(old, scores, keys, fields), keys, "sentiment_id", old)

        sentiment = replaced("sentiment", rescored)
        day = F.col("published_at").cast("date")
        days = own.select(day.alias("day")).distinct()
        of_days = articles.withColumn("day", day).join(days, "day", "left_semi")
        fresh = daily_mart(of_days, mentions, sentiment, loaded_at, model_name=BATCH_MODEL)
        mart = replaced("daily_mart", lambda old: upsert_daily_mart(old, log.writing(fresh)))
    return {"articles": articles, "mentions": mentions, "sentiment": sentiment, "daily_mart": mart}
