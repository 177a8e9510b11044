"""Mention rows of the batch and the realtime path, brought to one grain and one set of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions.sentiment import Scorer, ai_label_folded, ai_label_score, scored, sentiment_label
from newslens.functions.text import LEGACY_TEXT_LIMIT, article_text, nonblank, url_hash
from newslens.operators.dedup import latest_sentiment
from newslens.schemas import UNIFIED_COLUMNS

# Model and path tags, and the defaults of missing fields.
REALTIME_MODEL = "vader_v1"
AI_MODEL = "ai_sentiment_v1"
RETIRED_MODELS = ("rule_based_v1", "cortex_sentiment_v1", "ai_sentiment_v1")
UNKNOWN_MODEL = "legacy_unknown"
BATCH_PATH = "legacy"
REALTIME_PATH = "realtime"
BATCH_PROVIDER = "newsapi"
REALTIME_PROVIDER = "gdelt"
AI_REASONING = "Overall category of the model result, mapped to the reporting score and label."


def canonical_hash(url: Column, stored: Column, trust_stored: bool) -> Column:
    """Hash that the two paths share.

    The batch path stores a hash of the url as it came, the realtime path one of the trimmed lower-cased url, so stored
    hashes of one article differ across paths when its url has capitals. By default the hash is therefore made from
    the url, the stored one serving where there is no url; ``trust_stored`` prefers the stored one.
    """
    return F.coalesce(stored, url_hash(url)) if trust_stored else F.coalesce(url_hash(url), stored)


def article_enriched(articles: DataFrame, mentions: DataFrame, companies: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Every article with its mentions, their companies and all their scores; articles without any are kept."""
    a, m, c, s = (df.alias(name) for df, name in ((articles, "a"), (mentions, "m"), (companies, "c"), (sentiment, "s")))
    scored = (F.col("m.article_id") == F.col("s.article_id")) & (F.col("m.company_id") == F.col("s.company_id"))
    return (
        a.join(
            m.join(s, scored, "left").join(c, F.col("m.company_id") == F.col("c.company_id"), "left"),
            F.col("a.article_id") == F.col("m.article_id"),
            "left",
        )
        .select(
            "a.article_id",
            "a.provider",
            "a.source_name",
            "a.title",
            "a.description",
            "a.content",
            "a.url",
            "a.published_at",
            "m.company_id",
            "c.ticker",
            "c.company_name",
            "m.match_method",
            "m.confidence",
            "s.model_name",
            "s.sentiment_score",
            "s.sentiment_label",
            "a.ingested_at",
        )
    )


def batch_mentions(
    articles: DataFrame, mentions: DataFrame, sentiment: DataFrame, trust_stored_hash: bool = False,
    text_limit: int | None = LEGACY_TEXT_LIMIT,
) -> DataFrame:
    """Batch articles with a mention, each with its newest score, in the unified columns.

    ``text_limit`` is the length that stored batch texts have in the reports; None keeps whole texts. The text is put together, and cut,
    before the join, so that no other text column is shuffled.
    """
    text = article_text("title", "description", "content")
    narrow = articles.select(
        "article_id", "provider", "source_name", "url", "url_hash", "published_at", "ingested_at",
        (F.left(text, F.lit(text_limit)) if text_limit else text).alias("article_text"),
    )
    keys = ["article_id", "company_id"]
    newest = mentions.select(*keys).join(
        latest_sentiment(sentiment).select(*keys, "sentiment_score", "sentiment_label", "model_name"), keys, "left"
    )
    return (
        narrow.join(newest, "article_id")
        .select(
            F.col("article_id").cast("string").alias("record_id"),
            F.coalesce("provider", F.lit(BATCH_PROVIDER)).alias("provider"),
            "source_name",
            "url",
            canonical_hash(F.col("url"), F.col("url_hash"), trust_stored_hash).alias("canonical_url_hash"),
            F.col("published_at").alias("published_at_ts"),
            "company_id",
            F.coalesce("sentiment_score", F.lit(0.0)).alias("sentiment_score"),
            F.coalesce("sentiment_label", F.lit("neutral")).alias("sentiment_label"),
            "article_text",
            F.col("ingested_at").alias("loaded_at"),
            F.coalesce("model_name", F.lit(UNKNOWN_MODEL)).alias("sentiment_model"),
            F.lit(BATCH_PATH).alias("ingest_path"),
        )
    )


def realtime_mentions(latest_base: DataFrame, trust_stored_hash: bool = False) -> DataFrame:
    """Realtime rows, one per (event, company), in the unified columns."""
    return latest_base.select(
        F.col("event_id").alias("record_id"),
        F.coalesce("provider", F.lit(REALTIME_PROVIDER)).alias("provider"),
        "source_name",
        "url",
        canonical_hash(F.col("url"), F.col("url_hash"), trust_stored_hash).alias("canonical_url_hash"),
        "published_at_ts",
        "company_id",
        F.coalesce("sentiment_score", F.lit(0.0)).alias("sentiment_score"),
        sentiment_label(F.col("sentiment_score")).alias("sentiment_label"),
        "article_text",
        "loaded_at",
        F.lit(REALTIME_MODEL).alias("sentiment_model"),
        F.lit(REALTIME_PATH).alias("ingest_path"),
    )


def unify_paths(batch: DataFrame, realtime: DataFrame) -> DataFrame:
    """All rows of both paths, by column name: a missing or extra column is an error, not a shifted value."""
    return batch.select(*UNIFIED_COLUMNS).unionByName(realtime.select(*UNIFIED_COLUMNS))


def mention_listing(mentions: DataFrame, companies: DataFrame) -> DataFrame:
    """Mentions with their company, newest number first."""
    return (
        mentions.join(companies.select("company_id", "ticker", "company_name"), "company_id")
        .select("mention_id", "article_id", "ticker", "company_name", "match_method", "confidence", "matched_text")
        .orderBy(F.desc("mention_id"))
    )


# --- model results ----------------------------------------------------------------------------------------------------

AI_RESULT = "categories array<struct<name:string,sentiment:string>>"


def ai_sentiment_flatten(results: DataFrame, result: str = "ai_obj") -> DataFrame:
    """Result objects ``{"categories":[{"name","sentiment"},…]}`` to one row per "overall" category.

    The object may be JSON text or a variant. The wanted categories are picked inside the array before anything is
    exploded.
    """
    kind = dict(results.dtypes)[result]
    parsed = F.from_json(F.to_json(result) if kind == "variant" else F.col(result), AI_RESULT)
    overall = F.filter(parsed["categories"], lambda c: F.lower(c["name"]) == "overall")
    others = [name for name in results.columns if name != result]
    return (
        results.select(*others, F.explode(overall).alias("_c"))
        .select(*others, F.lower("_c.sentiment").alias("overall_sentiment"))
    )


def ai_scores(flattened: DataFrame, scored_at: Column) -> DataFrame:
    """Sentiment rows from flattened model results."""
    label = F.col("overall_sentiment")
    return flattened.select(
        "article_id",
        "company_id",
        F.lit(AI_MODEL).alias("model_name"),
        ai_label_score(label).alias("sentiment_score"),
        ai_label_folded(label).alias("sentiment_label"),
        F.lit(AI_REASONING).alias("reasoning"),
        scored_at.alias("scored_at"),
    )


def mention_texts(mentions: DataFrame, articles: DataFrame) -> DataFrame:
    """(article_id, company_id, text_blob) of the mentions whose article has any text."""
    return mentions.select("article_id", "company_id").join(article_texts(articles), "article_id")


def article_texts(articles: DataFrame) -> DataFrame:
    """(article_id, text_blob) of the articles with any text."""
    texts = articles.select("article_id", article_text("title", "description", "content").alias("text_blob"))
    return texts.where(nonblank("text_blob"))


def score_mentions(
    mentions: DataFrame, articles: DataFrame, scorer: "Scorer | DataFrame", model_name: str, scored_at: Column, reasoning: str | None = None
) -> DataFrame:
    """Sentiment rows from a scorer: text column to score column, or a word list of any size.

    A text is scored once per article, where it lies; only (article_id, score) meets the mentions. Dropping articles
    without mention before scoring would save scorer calls but shuffle every text.
    """
    texts = article_texts(articles)
    if isinstance(scorer, DataFrame):
        scores = scored(texts, "text_blob", scorer, "sentiment_score").drop("text_blob")
    else:
        scores = texts.select("article_id", scorer(F.col("text_blob")).alias("sentiment_score"))
    return (
        mentions.select("article_id", "company_id")
        .join(scores, "article_id")
        .select(
            "article_id",
            "company_id",
            F.lit(model_name).alias("model_name"),
            "sentiment_score",
            sentiment_label(F.col("sentiment_score")).alias("sentiment_label"),
            F.lit(reasoning).cast("string").alias("reasoning"),
            scored_at.alias("scored_at"),
        )
    )


def source_or_unknown(source: str = "source_name") -> Column:
    return F.coalesce(F.col(source), F.lit("UNKNOWN"))


