"""The supplied tables seen as the tables of a news pipeline.

Every document is an article of the batch path and an event of the realtime path, so both paths share their urls and
meet in the unified table. All columns come from the document's own row: the view costs no join and no shuffle, and the
whole text is kept (title, description and content are consecutive parts of it). ``plans.oracle`` states the same
view in SQL.
"""

from __future__ import annotations

from functools import cached_property, lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.functions.clock import iso_text
from newslens.functions.sentiment import Lexicon, Scorer
from newslens.functions.text import PREVIEW_LIMIT, article_text, event_id, message_key, title_preview, url_hash
from newslens.operators.dedup import latest_event_company, latest_url_company
from newslens.operators.matching import load_aliases, match_best_alias, match_substring
from newslens.operators.mentions import (
    ai_scores,
    ai_sentiment_flatten,
    batch_mentions,
    realtime_mentions,
    score_mentions,
    unify_paths,
)
from newslens.schemas import BASE_COLUMNS
from newslens.sources.tables import written_once

# A small company dimension, its aliases and a word list that occur in the supplied texts.
COMPANY_NAMES = "Edtion Works|Licence House|Freebest|Mit Group|Apache Lines|Wildcard Co|Queque SA|Silent Ltd".split("|")
COMPANY_ALIASES = (
    (1, "edtion"), (1, "Ingre"), (2, "license"), (3, "free"), (3, "best"), (4, "mit"), (5, "apache"), (6, "l_ch"),
    (7, "queque"),
)
WORD_VALENCES = (
    ("free", 2.3), ("best", 3.2), ("great", 3.1), ("license", -0.6), ("edtion", -1.5), ("ingre", 1.9), ("intion", -2.7),
    ("ating", 1.2), ("that", 0.4), ("with", -0.3), ("from", -0.5), ("this", 0.3),
)
START = "2024-01-01 00:00:00"
AS_OF = "2024-06-01 00:00:00"
SCORED = "2024-03-01 00:00:00"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """The documents, spread over the cores if the file has fewer splits than there are cores.

    Matching and scoring are bound by the processor, and a small file of one split would keep all but one core idle. A
    table with enough splits is left where it lies: at scale there is no shuffle here.
    """
    rows = table(spark, sf, "documents")
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores, "doc_id") if rows.rdd.getNumPartitions() < cores else rows


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def as_of() -> Column:
    return ntz(AS_OF)


def _inline(spark: SparkSession, rows, columns: str) -> DataFrame:
    """A few fixed rows as a local relation, whose size the optimiser knows."""
    values = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}" for v in row) + ")" for row in rows)
    names = [column.split() for column in columns.split(", ")]
    typed = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in names)
    return spark.sql(f"SELECT {typed} FROM VALUES {values} AS t({', '.join(name for name, _ in names)})")


def companies(spark: SparkSession) -> DataFrame:
    rows = [(at, f"C{at}", name) for at, name in enumerate(COMPANY_NAMES, start=1)]
    return _inline(spark, rows, "company_id bigint, ticker string, company_name string")


def dim_aliases(spark: SparkSession) -> DataFrame:
    return _inline(spark, COMPANY_ALIASES, "company_id bigint, alias string")


def word_list(spark: SparkSession) -> DataFrame:
    return _inline(spark, WORD_VALENCES, "token string, valence double")


def _scored_at(hours: Column | int) -> Column:
    return F.timestamp_add("SECOND", F.col("article_id") + F.lit(hours) * 3600, ntz(SCORED))


def _numbered(scores: DataFrame, last_digit: int) -> DataFrame:
    number = (F.col("article_id") * 1000 + F.col("company_id")) * 10 + last_digit
    return scores.select(number.alias("sentiment_id"), "*")


class Corpus:
    """The tables of one directory as pipeline tables. Each is a plan, made when it is first asked for."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    def stored(self, *names: str) -> "Corpus":
        """The same view for one run of a job: the named tables are written to the shared folder, each from those before it, and read from there."""
        own = Corpus(self.spark, self.sf)
        for name in names:
            setattr(own, name, written_once(getattr(own, name)))
        return own

    @cached_property
    def companies(self) -> DataFrame:
        return companies(self.spark)

    @cached_property
    def dim_aliases(self) -> DataFrame:
        return dim_aliases(self.spark)

    @cached_property
    def scorer(self) -> Scorer:
        return Lexicon.load(word_list(self.spark)).core_score

    @cached_property
    def articles(self) -> DataFrame:
        """Batch articles, one per document."""
        text = F.col("text")
        url = F.concat(F.lit("https://news.example.com/"), "lang", F.lit("/"), F.left(F.sha2(text, 256), F.lit(32)))
        published = F.timestamp_add("SECOND", F.col("doc_id") * 7 + F.col("n_chars") * 60, ntz(START))
        provider = (
            F.when(F.col("lang") == "en", "newsapi").when(F.col("lang") == "de", "rss").when(F.col("lang") == "fr", "gdelt")
        )
        return documents(self.spark, self.sf).select(
            F.col("doc_id").alias("article_id"),
            provider.alias("provider"),
            message_key(url).alias("provider_article_id"),
            F.nullif("source", F.lit("src13")).alias("source_name"),
            F.substring(text, 1, 80).alias("title"),
            F.nullif(F.substring(text, 81, 200), F.lit("")).alias("description"),
            F.nullif(F.substring(text, 281, 2147483647), F.lit("")).alias("content"),
            url.alias("url"),
            message_key(url).alias("url_hash"),
            published.alias("published_at"),
            F.col("lang").alias("language"),
            F.timestamp_add("DAY", F.lit(1), published).alias("ingested_at"),
            F.col("n_chars"),
        )

    @cached_property
    def events(self) -> DataFrame:
        """Realtime events, one per document: French ones with padded capital urls, each loaded later the longer it is."""
        sent = F.when(F.col("language") == "fr", F.concat(F.lit("  "), F.upper("url"), F.lit(" "))).otherwise(F.col("url"))
        return (
            self.articles.withColumn("url", sent)
            .withColumn("url_hash", url_hash("url"))
            .withColumn("event_id", event_id("provider", "url", iso_text(F.col("published_at"))))
            .withColumn("article_text", article_text("title", "description", "content"))
            .withColumnRenamed("published_at", "published_at_ts")
            .withColumn("event_ingested_at_ts", F.timestamp_add("MINUTE", F.lit(5), "published_at_ts"))
            .withColumn("loaded_at", F.timestamp_add("MINUTE", F.col("n_chars"), "published_at_ts"))
        )

    def _matched(self, per_alias_hit: bool, scored: bool) -> DataFrame:
        aliases = load_aliases(self.dim_aliases)
        scorer = self.scorer if scored else None
        return match_substring(self.events, aliases, per_alias_hit=per_alias_hit, scorer=scorer)

    @cached_property
    def hits(self) -> DataFrame:
        """Matched events, one row per alias that hits, not scored."""
        return self._matched(per_alias_hit=True, scored=False)

    @cached_property
    def scored_hits(self) -> DataFrame:
        return self._matched(per_alias_hit=True, scored=True)

    @cached_property
    def base(self) -> DataFrame:
        """Append-only realtime rows; the French batch was delivered twice, ten minutes apart."""
        once = F.array(F.struct(F.lit("0").alias("batch"), F.col("loaded_at").alias("at")))
        later = F.timestamp_add("MINUTE", F.lit(10), "loaded_at")
        again = F.array(F.struct(F.lit("1").alias("batch"), later.alias("at")))
        deliveries = F.when(F.col("language") == "fr", F.concat(once, again)).otherwise(once)
        return (
            self._matched(per_alias_hit=False, scored=True)
            .withColumn("_delivery", F.explode(deliveries))
            .withColumn("ingest_batch_id", F.col("_delivery.batch"))
            .withColumn("loaded_at", F.col("_delivery.at"))
            .select(*BASE_COLUMNS)
        )

    @cached_property
    def mentions(self) -> DataFrame:
        found = match_best_alias(self.articles, self.dim_aliases)
        return found.select(
            (F.col("article_id") * 1000 + F.col("company_id")).alias("mention_id"),
            "*",
            F.timestamp_add("SECOND", F.col("article_id"), ntz(SCORED)).alias("created_at"),
        )

    @cached_property
    def pairs(self) -> DataFrame:
        """(article_id, company_id) of the mentions. A query that needs them several times matches once and reuses their exchange: all joins put the same
        conditions on them, as those on nulls are here already, and no join or table is dealt out by both columns with the exchange of another."""
        known = F.col("article_id").isNotNull() & F.col("company_id").isNotNull()
        return self.mentions.select("article_id", "company_id").where(known).repartition("article_id", "company_id")

    @cached_property
    def repeated_mentions(self) -> DataFrame:
        """Mentions as two runs would leave them: company 1 was inserted again with a later number, at the same time for
        short contexts and a day later for full ones."""
        first = F.struct("mention_id", "created_at")
        full = F.length("mention_context") >= 500
        later = F.when(full, F.timestamp_add("DAY", F.lit(1), "created_at")).otherwise(F.col("created_at"))
        second = F.struct((F.col("mention_id") + 500).alias("mention_id"), later.alias("created_at"))
        rows = F.when(F.col("company_id") == 1, F.array(first, second)).otherwise(F.array(first))
        return (
            self.mentions.withColumn("_row", F.explode(rows))
            .withColumn("mention_id", F.col("_row.mention_id"))
            .withColumn("created_at", F.col("_row.created_at"))
            .drop("_row")
        )

    @cached_property
    def model_results(self) -> DataFrame:
        """Model result objects of the mentioned articles that have a label."""
        label = F.when(F.col("toxic") == 1, "Negative").when(F.col("quality") == 1, "positive").otherwise("mixed")
        categories = F.array(
            F.struct(F.lit("Overall").alias("name"), label.alias("sentiment")),
            F.struct(F.lit("price").alias("name"), F.lit("neutral").alias("sentiment")),
        )
        labelled = table(self.spark, self.sf, "labels").select(
            F.col("doc_id").alias("article_id"), F.to_json(F.struct(categories.alias("categories"))).alias("ai_obj")
        )
        return self.pairs.join(labelled, "article_id")

    @cached_property
    def ai_sentiment(self) -> DataFrame:
        return _numbered(ai_scores(ai_sentiment_flatten(self.model_results), _scored_at(0)), 1)

    @cached_property
    def rule_sentiment(self) -> DataFrame:
        """Word-list scores of all mentions: at the model's time for company 1, after it for 3 and 7, before it else."""
        hours = F.when(F.col("company_id") == 1, 0).when(F.col("company_id").isin(3, 7), 1).otherwise(-1)
        scored_at = _scored_at(hours)
        scores = score_mentions(self.pairs, self.articles, self.scorer, "rule_based_v1", scored_at, "word list")
        return _numbered(scores, 2)

    @cached_property
    def sentiment(self) -> DataFrame:
        return self.ai_sentiment.unionByName(self.rule_sentiment)

    @cached_property
    def batch_side(self) -> DataFrame:
        return batch_mentions(self.articles, self.pairs, self.sentiment)

    @cached_property
    def realtime_side(self) -> DataFrame:
        return realtime_mentions(latest_event_company(self.base))

    @cached_property
    def unified_previews(self) -> DataFrame:
        """The unified table with texts cut to previews before anything is sorted or shuffled."""
        base = self.base.withColumn("article_text", title_preview("article_text"))
        batch = batch_mentions(self.articles, self.pairs, self.sentiment, text_limit=PREVIEW_LIMIT)
        return latest_url_company(unify_paths(batch, realtime_mentions(latest_event_company(base))))

    @cached_property
    def unified(self) -> DataFrame:
        """The unified table: both paths, newest row per (url, company)."""
        return latest_url_company(unify_paths(self.batch_side, self.realtime_side))


@lru_cache(maxsize=8)
def corpus(spark: SparkSession, sf: str) -> Corpus:
    """The view of a directory. What is kept between calls are plans; every query still reads and computes its data."""
    return Corpus(spark, sf)
