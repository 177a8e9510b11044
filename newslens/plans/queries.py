"""Every operator as a query over the supplied tables: name to (spark, directory) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.functions import clock, sentiment, text
from newslens.operators import dedup, dimensions, late, marts, matching, mentions, partials, quality, tiles, upsert
from newslens.plans import batch, refresh
from newslens.plans.corpus import as_of, corpus, dim_aliases, ntz, table, word_list
from newslens.schemas import EVENT_FIELDS
from newslens.session import working_path
from newslens.sources import envelope, event_log, providers, staged
from newslens.sources.tables import publish, rebuild, written_once
from newslens.sources.tables import truncate_reload as truncate_reload_table
from newslens.streaming import counted, pipeline, progress, sink, windows
from newslens.streaming import dedup as stream_dedup

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- sources ----------------------------------------------------------------------------------------------------------


def _body(spark: SparkSession, sf: str, *items) -> DataFrame:
    """One response per article, made from its row: the given items as ``articles``."""
    listed = F.array(*[F.to_json(F.struct(*[column.alias(name) for name, column in item.items()])) for item in items])
    return corpus(spark, sf).articles.select(
        F.concat(F.lit('{"status":"ok","articles":['), F.array_join(listed, ","), F.lit("]}")).alias("body"),
        "ingested_at",
    )


@query
def normalize_gdelt(spark, sf):
    seen = F.when(F.col("language") == "es", "bad").otherwise(F.date_format("published_at", "yyyyMMddHHmmss"))
    item = {
        "url": F.col("url"), "seendate": seen, "title": F.col("title"), "socialimage": F.lit(""),
        "excerpt": F.col("content"), "domain": F.col("source_name"), "language": F.col("language"),
    }
    payloads = _body(spark, sf, item, {"title": F.lit("an item without url")})
    return providers.normalize_gdelt(payloads).select(*EVENT_FIELDS, "published_at_inferred")


@query
def normalize_newsapi(spark, sf):
    item = {
        "source": F.struct(F.col("source_name").alias("name")), "author": F.col("provider"), "title": F.col("title"),
        "description": F.col("description"), "content": F.col("content"), "url": F.col("url"),
        "publishedAt": F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    }
    payloads = _body(spark, sf, {"url": F.lit(""), "title": F.col("title")}, item)
    return providers.normalize_newsapi(payloads).select(*EVENT_FIELDS, "published_at_inferred")


def _batch_payloads(spark, sf) -> DataFrame:
    """Responses of one article each; the German ones report an error, the Spanish ones have no readable time."""
    item = {
        "source": F.struct(F.col("source_name").alias("name")), "title": F.col("title"), "content": F.col("content"),
        "description": F.col("description"), "url": F.col("url"),
        "publishedAt": F.when(F.col("language") == "es", "soon").otherwise(F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
    }
    failed = F.replace("body", F.lit('"ok"'), F.lit('"error"'))
    return _body(spark, sf, item).withColumn("body", F.when(F.col("body").contains("example.com/de/"), failed).otherwise(F.col("body")))


@query
def batch_articles(spark, sf):
    """Batch rows from responses; the German ones report an error and are listed instead of loaded."""
    rows = providers.batch_articles(_batch_payloads(spark, sf), F.lit("b1"))
    return rows.select(
        "provider", "provider_article_id", "source_name", "author", "title", "description", "content", "url", "url_hash",
        "published_at", "language", "load_batch_id", F.try_variant_get("raw_json", "$.title", "string").alias("raw_title"),
    )


@query
def normalize_rss(spark, sf):
    def tag(name: str, value) -> Column:
        escaped = F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return F.coalesce(F.concat(F.lit(f"<{name}>"), escaped, F.lit(f"</{name}>")), F.lit(""))

    number = F.when(F.col("language") != "de", F.concat(F.lit("g"), "article_id"))
    item = F.concat(
        tag("link", F.col("url")),
        tag("guid", number),
        tag("title", F.col("title")),
        tag("pubDate", F.date_format("published_at", "EEE, d MMM yyyy HH:mm:ss 'GMT'")),
        tag("description", F.col("content")),
        tag("source", F.col("source_name")),
    )
    feed = F.concat(
        F.lit("<rss><channel>"), tag("title", F.concat(F.lit("Feed of "), "language")), F.lit("<item>"), item,
        F.lit("</item><item><title>no link</title></item></channel></rss>"),
    )
    feeds = corpus(spark, sf).articles.select(feed.alias("body"), "ingested_at")
    return providers.normalize_rss(feeds).select(*EVENT_FIELDS, "published_at_inferred")


def _atom(spark, sf) -> DataFrame:
    """The articles as Atom documents; Spanish ones are torn, those without source are blank."""
    def tag(name: str, value) -> Column:
        escaped = F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return F.concat(F.lit(f"<{name}>"), escaped, F.lit(f"</{name}>"))

    stamp = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    entry = F.concat(
        F.lit('<entry><link rel="self" href="x:/self"/><link href="'), "url", F.lit('"/>'), tag("id", F.col("article_id").cast("string")),
        tag("updated", stamp), tag("title", F.col("title")), tag("summary", F.coalesce("description", F.lit("none"))), F.lit("</entry>"),
    )
    whole = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), tag("title", F.col("language")), entry, F.lit("</feed>"))
    body = F.when(F.col("source_name").isNull(), " ").when(F.col("language") == "es", F.left(whole, F.lit(60))).otherwise(whole)
    return corpus(spark, sf).articles.select("article_id", body.alias("body"), "ingested_at")


@query
def normalize_atom(spark, sf):
    return providers.normalize_rss(_atom(spark, sf)).select(
        "url", "provider_article_id", "published_at", "title", "description", "source_name", "published_at_inferred"
    )


@query
def feed_problems(spark, sf):
    return providers.feed_problems(_atom(spark, sf)).select("article_id", "reason")


def _wire_events(spark, sf) -> DataFrame:
    """Realtime events as they travel: text columns only."""
    return corpus(spark, sf).events.select(
        "event_id", "provider", "provider_article_id", clock.iso_text(F.col("published_at_ts")).alias("published_at"),
        "title", "description", "content", "source_name", "url", F.lit("").alias("author"), "language",
        F.lit("").alias("country"), clock.iso_text(F.col("event_ingested_at_ts")).alias("event_ingested_at"),
    )


def _messages(spark, sf) -> DataFrame:
    """Wire events as messages, each arrived a minute after it was ingested."""
    sent = envelope.event_envelope(_wire_events(spark, sf).withColumn("language", F.nullif("language", F.lit("es"))))
    return sent.withColumn("timestamp", F.to_timestamp(F.get_json_object("value", "$.event_ingested_at")) + F.expr("INTERVAL 1 MINUTE"))


def _parsed(messages: DataFrame) -> DataFrame:
    """All columns of parsed messages, the arrival in UTC."""
    return envelope.parse_envelope(messages).withColumn("kafka_timestamp", F.col("kafka_timestamp").cast("timestamp_ntz"))


@query
def event_envelope(spark, sf):
    """Key and all fields of the value; a null is no field of the JSON text."""
    sent = _messages(spark, sf)
    fields = [F.get_json_object("value", f"$.{name}").alias(name) for name in EVENT_FIELDS]
    return sent.select("key", *fields)


@query
def parse_envelope(spark, sf):
    return _parsed(_messages(spark, sf).withColumn("value", F.col("value").cast("binary")))


@query
def src_article_stream(spark, sf):
    """Messages appended to the log in two turns and read as a stream that is stopped between them: each arrives once."""
    log, out, checkpoint = (working_path(spark, name) for name in ("log", "received", "checkpoint"))
    messages = _messages(spark, sf)
    for turn in (F.get_json_object("value", "$.language") == "en", F.coalesce(F.get_json_object("value", "$.language"), F.lit("")) != "en"):
        event_log.append(messages.where(turn), log)
        received = event_log.log_stream(spark, log, "earliest").writeStream.format("parquet").option("checkpointLocation", checkpoint)
        received.trigger(availableNow=True).start(out).awaitTermination()
    received = spark.read.schema(event_log.SCHEMA).parquet(out)
    gapless = (F.count(F.lit(1)) == F.max("offset") + 1) & (F.min("offset") == 0)
    checked = received.groupBy("partition").agg(gapless.alias("gapless"))  # a row a partition: messages stay where they are
    placed = received.join(F.broadcast(checked), "partition").select("value", "timestamp", F.struct("key", "gapless").alias("place"))
    return _parsed(placed).join(
        placed.select(F.get_json_object(F.col("value").cast("string"), "$.event_id").alias("event_id"), "place.*"), "event_id"
    )


@query
def read_staged_json(spark, sf):
    """Orders staged as JSON lines and read back."""
    path, columns = working_path(spark, "staged"), "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string"
    table(spark, sf, "orders").select(*[c.split()[0] for c in columns.split(", ")]).write.json(path)
    return staged.read_staged_json(spark, path, columns)


@query
def read_staged_csv(spark, sf):
    """Customers staged as CSV and read back; the names of three nations are texts that mean null."""
    path, nation = working_path(spark, "staged"), F.col("c_nationkey")
    name = F.when(nation == 1, "").when(nation == 2, "NULL").when(nation == 3, "null").otherwise(F.concat(F.lit('a "b", '), "c_name"))
    rows = table(spark, sf, "customer").select("c_custkey", name.alias("c_name"), "c_nationkey")
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return staged.read_staged_csv(spark, path, "c_custkey bigint, c_name string, c_nationkey int")


@query
def load_aliases(spark, sf):
    customers = table(spark, sf, "customer")
    return matching.load_aliases(customers.select(F.col("c_custkey").alias("company_id"), F.col("c_name").alias("alias")))


@query
def seed_dimension(spark, sf):
    old = table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 1).alias("company_id"), F.col("s_name").alias("ticker"),
        F.col("s_nationkey").cast("string").alias("country"),
    )
    seeds = table(spark, sf, "customer").select(
        F.replace("c_name", F.lit("Customer"), F.lit("Supplier")).alias("ticker"),
        F.col("c_nationkey").cast("string").alias("country"),
    )
    return dimensions.seed_dimension(old, seeds, ["ticker"], "company_id")


# --- scalars ----------------------------------------------------------------------------------------------------------


@query
def url_hash(spark, sf):
    return corpus(spark, sf).events.select("article_id", "url", text.url_hash("url").alias("url_hash"))


@query
def event_id(spark, sf):
    return corpus(spark, sf).events.select("article_id", "event_id")


@query
def article_text(spark, sf):
    full = text.article_text("title", "description", "content")
    return corpus(spark, sf).articles.select(
        "article_id",
        full.alias("article_text"),
        F.left(full, F.lit(text.LEGACY_TEXT_LIMIT)).alias("stored_text"),
        text.mention_context("title", "description", "content").alias("mention_context"),
    )


@query
def first_nonblank(spark, sf):
    description = F.when(F.col("language") == "de", "").otherwise(F.col("description"))
    chosen = text.first_nonblank(description, "content", "title", default="none")
    return corpus(spark, sf).articles.select("article_id", chosen.alias("chosen"))


@query
def parse_published_at(spark, sf):
    ts, kind = F.col("ts"), F.col("event_type")
    sent = (
        F.when(kind == "click", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
        .when(kind == "signup", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == "view", F.date_format(ts, "yyyyMMddHHmmss"))
        .when(kind == "purchase", "")
        .otherwise("garbage")
    )
    rows = table(spark, sf, "events").select("event_id", "ts", sent.alias("sent"))
    parsed = F.coalesce(clock.parse_compact(F.col("sent")), clock.parse_iso(F.col("sent")))
    published, inferred = clock.or_ingested(parsed, F.timestamp_add("DAY", F.lit(1), "ts"))
    return rows.select("event_id", published.alias("published_at_ts"), inferred.alias("published_at_inferred"))


@query
def drop_incomplete(spark, sf):
    rows = corpus(spark, sf).articles.select(
        "article_id",
        F.when(F.col("language") != "es", F.col("url")).alias("url"),
        F.when(F.col("source_name").isNotNull(), F.col("title")).alias("title"),
    )
    return envelope.drop_incomplete(rows)


def _scored_articles(spark, sf) -> DataFrame:
    full = text.article_text("title", "description", "content")
    return corpus(spark, sf).articles.select("article_id", corpus(spark, sf).scorer(full).alias("sentiment_score"))


@query
def sentiment_label(spark, sf):
    return _scored_articles(spark, sf).withColumn(
        "sentiment_label", sentiment.sentiment_label(F.col("sentiment_score"))
    )


@query
def ai_label_score(spark, sf):
    label = (
        F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").when(F.col("quality") == 0, "mixed")
    )
    rows = table(spark, sf, "documents").select("doc_id")
    rows = rows.join(table(spark, sf, "labels"), "doc_id", "left").select("doc_id", label.alias("label"))
    return rows.select(
        "*",
        sentiment.ai_label_score(F.col("label")).alias("sentiment_score"),
        sentiment.ai_label_folded(F.col("label")).alias("sentiment_label"),
    )


@query
def fill_defaults(spark, sf):
    latest = dedup.latest_sentiment(corpus(spark, sf).sentiment)
    return (
        corpus(spark, sf).articles
        .select("article_id", "provider", "source_name")
        .join(latest.select("article_id", "sentiment_score", "sentiment_label", "model_name"), "article_id", "left")
        .select(
            "article_id",
            F.coalesce("provider", F.lit(mentions.BATCH_PROVIDER)).alias("provider"),
            mentions.source_or_unknown().alias("source_name"),
            F.coalesce("sentiment_score", F.lit(0.0)).alias("sentiment_score"),
            F.coalesce("sentiment_label", F.lit("neutral")).alias("sentiment_label"),
            F.coalesce("model_name", F.lit(mentions.UNKNOWN_MODEL)).alias("sentiment_model"),
            F.lit(mentions.BATCH_PATH).alias("ingest_path"),
        )
    )


@query
def title_preview(spark, sf):
    full = text.article_text("title", "description", "content")
    return corpus(spark, sf).articles.select("article_id", text.title_preview(full).alias("title"))


@query
def time_bucket(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        clock.time_bucket(F.col("ts"), "minute").alias("bucket_minute"),
        clock.time_bucket(F.col("ts"), "hour").alias("bucket_hour"),
        F.col("ts").cast("date").alias("metric_date"),
    )


@query
def parse_raw_json(spark, sf):
    raw = text.raw_variant("props")
    return table(spark, sf, "events").select("event_id", F.try_variant_get(raw, "$.k", "bigint").alias("k"))


@query
def nonblank_text_filter(spark, sf):
    full = text.article_text("title", "description", "content").alias("text_blob")
    return corpus(spark, sf).articles.select("article_id", full).where(text.nonblank("text_blob"))


# --- joins ------------------------------------------------------------------------------------------------------------

MATCH_LIST = ("event_id", "article_id", "provider", "url", "url_hash", "published_at_ts", "company_id", "source_name")


@query
def match_substring(spark, sf):
    return corpus(spark, sf).hits.select(*MATCH_LIST)


def many_aliases(spark, sf) -> DataFrame:
    """Some thousand aliases: the words of three letters or more of the benchmark passages, each of its first passage."""
    words = table(spark, sf, "benchmark").select("item_id", F.explode(sentiment.word_tokens(F.col("text"))).alias("w"))
    return (
        words.where(F.length("w") >= 3)
        .groupBy(F.col("w").alias("alias_norm"))
        .agg(F.min("item_id").alias("company_id"))
    )


@query
def match_substring_many(spark, sf):
    rows = corpus(spark, sf).events.select("article_id", "article_text")
    return matching.match_substring(rows, many_aliases(spark, sf)).select("article_id", "company_id")


@query
def match_substring_by_join(spark, sf):
    """The same rows as ``match_substring`` by the plan for alias tables of any size."""
    names = matching.load_aliases(dim_aliases(spark))
    return matching.match_substring(corpus(spark, sf).events, names, up_to=0).select(*MATCH_LIST)


@query
def match_best_alias_by_join(spark, sf):
    return matching.match_best_alias(corpus(spark, sf).articles, corpus(spark, sf).dim_aliases, up_to=0)


@query
def match_alias_list_by_join(spark, sf):
    return matching.match_alias_list(corpus(spark, sf).articles, corpus(spark, sf).dim_aliases, up_to=0)


@query
def match_best_alias(spark, sf):
    return matching.match_best_alias(corpus(spark, sf).articles, corpus(spark, sf).dim_aliases)


@query
def match_alias_list(spark, sf):
    return matching.match_alias_list(corpus(spark, sf).articles, corpus(spark, sf).dim_aliases)


@query
def article_enriched(spark, sf):
    return mentions.article_enriched(
        corpus(spark, sf).articles, corpus(spark, sf).mentions, corpus(spark, sf).companies, corpus(spark, sf).sentiment
    )


@query
def legacy_mentions(spark, sf):
    return corpus(spark, sf).batch_side


@query
def realtime_mentions(spark, sf):
    return corpus(spark, sf).realtime_side


@query
def sentiment_examples(spark, sf):
    return marts.sentiment_examples(corpus(spark, sf).unified_previews, corpus(spark, sf).companies)


@query
def sentiment_examples_legacy(spark, sf):
    return marts.sentiment_examples_batch(
        corpus(spark, sf).sentiment, corpus(spark, sf).companies, corpus(spark, sf).articles, as_of()
    )


@query
def mention_listing(spark, sf):
    return mentions.mention_listing(corpus(spark, sf).mentions, corpus(spark, sf).companies)


@query
def model_filtered_left_join(spark, sf):
    keys = ["article_id", "company_id"]
    chosen = corpus(spark, sf).sentiment.where(F.col("model_name") == mentions.AI_MODEL)
    scores = chosen.select(*keys, "model_name", "sentiment_score")
    return corpus(spark, sf).pairs.join(scores, keys, "left")


def _order_aliases(spark, sf, finished_only: bool = False) -> DataFrame:
    orders = table(spark, sf, "orders")
    if finished_only:
        orders = orders.where(F.col("o_orderstatus") == "F")
    return orders.select(F.col("o_custkey").alias("company_id"), F.col("o_orderpriority").alias("alias")).distinct()


@query
def anti_join_insert(spark, sf):
    return upsert.missing(_order_aliases(spark, sf, True), _order_aliases(spark, sf), ["company_id", "alias"])


# --- upserts ----------------------------------------------------------------------------------------------------------


@query
def upsert_articles(spark, sf):
    """All articles: English, French and Spanish ones are there, French, German and Spanish ones come (those without provider match nothing)."""
    known = corpus(spark, sf).articles
    keys = ["provider", "url"]
    fields = [*keys, "title", "source_name", "published_at"]
    old = known.where(F.col("language").isin("en", "fr", "es"))
    target = upsert.last_per_key(old, keys, F.col("article_id")).select("article_id", *fields, "ingested_at")
    target = target.withColumn("title", F.lit("old")).withColumn("is_duplicate", F.lit(True))
    source = known.where(F.col("language").isin("fr", "de", "es")).select(*fields, F.col("article_id").alias("sequence"))
    return upsert.upsert_articles(target, source, as_of(), F.col("sequence"))


@query
def upsert_mentions(spark, sf):
    target = corpus(spark, sf).mentions.where(F.col("company_id") <= 3)
    return upsert.upsert_mentions(target, match_alias_list(spark, sf), as_of())


def _daily(spark, sf, refreshed_at, **options) -> DataFrame:
    return marts.daily_mart(
        corpus(spark, sf).articles, corpus(spark, sf).pairs, corpus(spark, sf).sentiment, refreshed_at, **options
    )


@query
def upsert_daily_mart(spark, sf):
    target = _daily(spark, sf, ntz("2024-05-01 00:00:00")).where(F.col("company_id") <= 3)
    source = _daily(spark, sf, as_of(), model_name=None).where(F.col("company_id") >= 3)
    return upsert.upsert_daily_mart(target, source)


@query
def batch_pipeline(spark, sf):
    """Two runs of the batch job over all languages: English and French first, then French again with Spanish and German. The mart after them."""
    payloads, root = written_once(_batch_payloads(spark, sf)), working_path(spark, "batch")  # landed once, read by every step
    scorer = sentiment.Lexicon.load(word_list(spark)).core_score
    of = lambda *languages: F.col("body").rlike(f"example.com/({'|'.join(languages)})/")
    batch.run_batch(payloads.where(of("en", "fr")), dim_aliases(spark), scorer, root, "r1", ntz("2024-06-01 00:00:00"))
    again = payloads.where(of("fr", "es", "de"))
    return batch.run_batch(again, dim_aliases(spark), scorer, root, "r2", ntz("2024-06-02 00:00:00"))["daily_mart"]


@query
def insert_only_merge(spark, sf):
    """The table has finished orders' aliases of every company, and one of its own for each; the source has all orders'."""
    own = table(spark, sf, "customer").select(F.col("c_custkey").alias("company_id"), F.col("c_name").alias("alias"))
    target = _order_aliases(spark, sf, True).unionByName(own).withColumn("kind", F.lit("old"))
    source = _order_aliases(spark, sf).withColumn("kind", F.lit("new"))
    return upsert.insert_missing(target, source, ["company_id", "alias"])


@query
def replace_model_rows(spark, sf):
    """Both models' rows and those of one that stays; the retired ones make way for new scores."""
    stays = corpus(spark, sf).rule_sentiment.withColumn("model_name", F.lit("house_model_v2"))
    fresh = corpus(spark, sf).ai_sentiment
    return upsert.replace_models(corpus(spark, sf).sentiment.unionByName(stays), fresh, list(mentions.RETIRED_MODELS))


# --- dedup ------------------------------------------------------------------------------------------------------------


@query
def dedup_event_company(spark, sf):
    hits = corpus(spark, sf).hits.select("event_id", "company_id", "url_hash", "published_at_ts")
    return dedup.dedup_event_company(hits)


@query
def latest_event_company(spark, sf):
    return dedup.latest_event_company(corpus(spark, sf).base)


@query
def latest_url_company(spark, sf):
    return corpus(spark, sf).unified


@query
def latest_event_company_stored(spark, sf):
    """The same rows from a stored base table, by late materialisation."""
    return late.latest_event_company(late.stored(corpus(spark, sf).base))


@query
def latest_url_company_stored(spark, sf):
    """The unified table from the stored rows of both paths, by late materialisation."""
    own = corpus(spark, sf).stored("pairs")
    base = late.latest_event_company(late.stored(own.base))
    return late.latest_url_company(late.stored(mentions.unify_paths(own.batch_side, mentions.realtime_mentions(base))))


@query
def refresh_incremental(spark, sf):
    """The unified table by a refresh up to marks in every source table, then one from what came after them."""
    own = corpus(spark, sf).stored("articles", "mentions", "sentiment", "base")
    marks = {"articles": "2024-01-04", "mentions": "2024-03-01 00:04:00", "sentiment": "2024-03-01 00:30:00", "base": "2024-01-03"}
    marks = {name: ntz(at) for name, at in marks.items()}
    tables = {"articles": own.articles, "mentions": own.mentions, "sentiment": own.sentiment, "base": own.base}
    before = {name: df.where(F.col(refresh.MARKED[name]) <= marks[name]) for name, df in tables.items()}
    previous = rebuild(dedup.latest_url_company(refresh.unify(*before.values())), working_path(spark, "unified"))
    return refresh.refresh_unified_incremental(previous, **tables, marks=marks)


@query
def latest_sentiment(spark, sf):
    return dedup.latest_sentiment(corpus(spark, sf).sentiment)


@query
def dup_report(spark, sf):
    return dedup.duplicate_loads(corpus(spark, sf).base)


def _alias_table(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("alias_id"), F.col("o_custkey").alias("company_id"), F.col("o_orderpriority").alias("alias")
    )


@query
def dup_alias_report(spark, sf):
    return dedup.duplicate_aliases(_alias_table(spark, sf))


@query
def dup_mention_report(spark, sf):
    return dedup.duplicate_mentions(corpus(spark, sf).repeated_mentions)


@query
def dedup_aliases(spark, sf):
    return dedup.dedup_aliases(_alias_table(spark, sf))


@query
def truncate_reload(spark, sf):
    """An alias table with duplicates, published and replaced by itself without them."""
    path = working_path(spark, "aliases")
    publish(_alias_table(spark, sf), path)
    return truncate_reload_table(spark, path, dedup.dedup_aliases)


@query
def rebuild_report(spark, sf):
    """A report published twice: of finished orders, then of all."""
    path, orders = working_path(spark, "report"), table(spark, sf, "orders")
    report = lambda df: df.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))
    rebuild(report(orders.where(F.col("o_orderstatus") == "F")), path)
    return rebuild(report(orders), path)


@query
def run_log(spark, sf):
    """The log row of a run that reads all events and writes the purchases."""
    path, events = working_path(spark, "run-log"), table(spark, sf, "events")
    with quality.RunLog(spark, path, "r1", "events", "manual", "events") as log:
        kept = log.writing(log.reading(events).where(F.col("event_type") == "purchase"))
        kept.write.format("noop").mode("overwrite").save()
        log.problem("only purchases")
    return spark.read.parquet(path).drop("run_started_at", "run_finished_at")


@query
def failed_window_report(spark, sf):
    """A ledger with one line for each event: its day's window, its kind as the error."""
    day = F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")
    ledger = table(spark, sf, "events").select(
        clock.iso_text(F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")).alias("recorded_at"), clock.iso_text(day).alias("window_start"),
        clock.iso_text(F.timestamp_add("DAY", F.lit(1), day)).alias("window_end"), F.col("user_id").alias("attempts"),
        F.col("event_type").alias("error_type"), (F.col("event_type") == "click").alias("skipped"),
    )
    return quality.failed_window_report(ledger)


@query
def dedup_mentions(spark, sf):
    return dedup.dedup_mentions(corpus(spark, sf).repeated_mentions)


@query
def dedup_url_batch(spark, sf):
    rows = corpus(spark, sf).events.select("event_id", "article_id", "url")
    return dedup.dedup_url_batch(rows, [F.col("article_id").asc()])


# --- sentiment --------------------------------------------------------------------------------------------------------


@query
def lexicon_sentiment(spark, sf):
    return _scored_articles(spark, sf)


@query
def lexicon_sentiment_by_join(spark, sf):
    rows = corpus(spark, sf).events.select("article_id", "article_text")
    return sentiment.lexicon_scores_by_join(rows, "article_id", "article_text", word_list(spark))


@query
def rule_sentiment(spark, sf):
    full = text.article_text("title", "description", "content")
    scorer = sentiment.Lexicon.load(word_list(spark)).rule_score
    return corpus(spark, sf).articles.select("article_id", scorer(full).alias("sentiment_score"))


@query
def ai_sentiment_flatten(spark, sf):
    return mentions.ai_sentiment_flatten(corpus(spark, sf).model_results)


@query
def score_mentions(spark, sf):
    return corpus(spark, sf).rule_sentiment


@query
def ai_scores(spark, sf):
    return corpus(spark, sf).ai_sentiment


# --- aggregates -------------------------------------------------------------------------------------------------------


@query
def minute_mart(spark, sf):
    return marts.minute_mart(corpus(spark, sf).scored_hits)


@query
def minute_mart_per_alias_hit(spark, sf):
    return marts.minute_mart(corpus(spark, sf).scored_hits, per_alias_hit=True)


@query
def hour_mart(spark, sf):
    return marts.hour_mart(corpus(spark, sf).scored_hits)


def _mart_rows(rows: DataFrame) -> DataFrame:
    """What a mart needs of matched rows."""
    return rows.select("event_id", "company_id", "url_hash", "published_at_ts", "sentiment_score")


@query
def hour_mart_from_minutes(spark, sf):
    """Hours merged from minute partials, with the distinct articles of an hour."""
    rows = written_once(_mart_rows(corpus(spark, sf).scored_hits))
    fine = partials.partials(rows, partials.number_articles(rows))
    return partials.finished(partials.coarser(fine, "hour"), "hour")


@query
def day_mart_stored(spark, sf):
    """Days merged from the stored minute partials of four batches, one for each quarter of the day."""
    stored = partials.StoredPartials(working_path(spark, "partials"))
    rows = written_once(_mart_rows(corpus(spark, sf).scored_hits))
    for batch in range(4):
        stored.add(rows.where(F.floor(F.hour("published_at_ts") / 6) == batch), batch)
    return stored.mart(spark, "day")


@query
def article_volume(spark, sf):
    return marts.article_volume(corpus(spark, sf).unified, corpus(spark, sf).companies)


@query
def article_volume_legacy(spark, sf):
    return marts.article_volume_batch(corpus(spark, sf).mentions, corpus(spark, sf).companies, as_of())


@query
def sentiment_summary(spark, sf):
    return marts.sentiment_summary(corpus(spark, sf).unified, corpus(spark, sf).companies)


@query
def sentiment_summary_legacy(spark, sf):
    return marts.sentiment_summary_batch(corpus(spark, sf).sentiment, corpus(spark, sf).companies, as_of())


@query
def daily_trend(spark, sf):
    return marts.daily_trend(corpus(spark, sf).unified)


@query
def daily_trend_legacy(spark, sf):
    return marts.daily_trend_batch(daily_mart(spark, sf), as_of())


@query
def daily_mart(spark, sf):
    return _daily(spark, sf, as_of())


@query
def daily_mart_all_models(spark, sf):
    return _daily(spark, sf, as_of(), model_name=None)


@query
def top_sources(spark, sf):
    return marts.top_sources(corpus(spark, sf).unified)


@query
def matching_quality(spark, sf):
    return marts.matching_quality(corpus(spark, sf).articles, corpus(spark, sf).pairs)


@query
def label_distribution(spark, sf):
    return marts.label_distribution(corpus(spark, sf).sentiment)


@query
def model_row_count(spark, sf):
    return marts.model_row_count(corpus(spark, sf).sentiment)


@query
def provider_counts(spark, sf):
    return marts.provider_counts(corpus(spark, sf).unified)


# --- reshaping and tiles ----------------------------------------------------------------------------------------------


@query
def unify_paths(spark, sf):
    return mentions.unify_paths(corpus(spark, sf).batch_side, corpus(spark, sf).realtime_side)


@query
def sentiment_stacked(spark, sf):
    return tiles.sentiment_stacked(sentiment_summary(spark, sf))


@query
def table_counts(spark, sf):
    return marts.table_counts(
        {
            "raw_articles": corpus(spark, sf).articles,
            "fact_article_company_mentions": corpus(spark, sf).mentions,
            "fact_article_sentiment": corpus(spark, sf).sentiment,
            "mart_company_sentiment_daily": daily_mart(spark, sf),
        }
    )


@query
def tile_volume(spark, sf):
    return tiles.tile_volume(article_volume(spark, sf))


@query
def tile_avg_sentiment(spark, sf):
    return tiles.tile_avg_sentiment(sentiment_summary(spark, sf))


@query
def tile_daily_trend(spark, sf):
    return tiles.tile_daily_trend(daily_trend(spark, sf))


@query
def tile_examples(spark, sf):
    return tiles.tile_examples(sentiment_examples(spark, sf))


@query
def tile_top_sources(spark, sf):
    return tiles.tile_top_sources(top_sources(spark, sf))


@query
def legacy_preview_volume(spark, sf):
    return tiles.preview_volume(article_volume_legacy(spark, sf))


@query
def legacy_preview_summary(spark, sf):
    return tiles.preview_summary(sentiment_summary_legacy(spark, sf))


@query
def legacy_preview_trend(spark, sf):
    return tiles.preview_trend(daily_trend_legacy(spark, sf))


@query
def legacy_preview_examples(spark, sf):
    return tiles.preview_examples(sentiment_examples_legacy(spark, sf))


@query
def legacy_preview_scores(spark, sf):
    return tiles.preview_scores(corpus(spark, sf).sentiment, mentions.AI_MODEL)


# --- streaming and backfill -------------------------------------------------------------------------------------------


def _land(spark, events: DataFrame) -> DataFrame:
    """Events as a stream of messages: written as JSON lines to the shared folder and read back as files land."""
    landed = working_path(spark, "landed")
    envelope.event_envelope(events).select("value").write.text(landed)
    return envelope.landed_stream(spark, landed)


def _run_pipeline(spark, messages: DataFrame) -> sink.RealtimeTables:
    """The whole realtime path, run until the landed messages are worked off."""
    tables = sink.RealtimeTables(working_path(spark, "realtime"))
    run = pipeline.start(
        messages,
        tables,
        aliases=lambda session: matching.load_aliases(dim_aliases(session)),
        scorer=sentiment.Lexicon.load(word_list(spark)).core_score,
        checkpoint=working_path(spark, "checkpoint"),
        trigger=None,
    )
    run.awaitTermination()
    return tables


@query
def stream_pipeline(spark, sf):
    """Base rows of the stream. Of events with one url the first to arrive stays, so only what those share is shown."""
    tables = _run_pipeline(spark, _land(spark, _wire_events(spark, sf)))
    return sink.read_base(spark, tables).select("url_hash", "company_id", "sentiment_score")


def _one_per_url(spark, sf) -> DataFrame:
    """Wire events with one event per url, so that the stream has no choice between them."""
    events = _wire_events(spark, sf)
    return dedup.dedup_url_batch(events, [F.col("published_at").asc(), F.col("event_id").asc()])


@query
def sink_micro_batch(spark, sf):
    tables = _run_pipeline(spark, _land(spark, _one_per_url(spark, sf)))
    columns = ("event_id", "url_hash", "published_at_ts", "company_id", "sentiment_score", "source_name")
    return sink.read_match(spark, tables).select(*columns)


@query
def stream_minute_mart(spark, sf):
    tables = _run_pipeline(spark, _land(spark, _one_per_url(spark, sf)))
    return sink.read_minutes(spark, tables)


@query
def stream_minute_windows(spark, sf):
    """The mart of a stream with a watermark two hours behind: even hours of the first half day come first, so odd ones before it are late."""
    stream_dedup.use_disk_state(spark)
    log, root, checkpoint = (working_path(spark, name) for name in ("log", "windows", "checkpoint"))
    scorer = sentiment.Lexicon.load(word_list(spark)).core_score
    rows = _mart_rows(sink.matched_rows(corpus(spark, sf).events, matching.load_aliases(dim_aliases(spark)), scorer))
    rows = written_once(rows)
    early = (F.col("published_at_ts") < ntz("2024-01-01 12:00:00")) & (F.hour("published_at_ts") % 2 == 0)
    for turn in (early, ~early):
        message = F.to_json(F.struct(*rows.columns)).alias("value")
        event_log.append(rows.where(turn).select(F.col("url_hash").alias("key"), message), log)
        fields = F.from_json(F.col("value").cast("string"), rows.schema).alias("v")
        stream = event_log.log_stream(spark, log, "earliest").select(fields).select("v.*")
        windows.start(stream, root, checkpoint, delay="2 hours").awaitTermination()
    key = ["bucket_minute", "company_id"]
    late = windows.read_late(spark, root).withColumn("bucket_minute", clock.time_bucket(F.col("published_at_ts"), "minute"))
    late = late.groupBy(*key).agg(F.count(F.lit(1)).alias("late_rows"), F.max("watermark").alias("watermark"))
    return windows.read_minutes(spark, root).join(late, key, "full_outer")


@query
def dedup_stream_url(spark, sf):
    stream_dedup.use_disk_state(spark)
    out = working_path(spark, "deduplicated")
    messages = _land(spark, _wire_events(spark, sf))
    events = envelope.normalize_events(envelope.parse_envelope(messages)).select("url_hash")
    run = (
        stream_dedup.dedup_stream_url(events)
        .writeStream.format("parquet")
        .option("checkpointLocation", working_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start(out)
    )
    run.awaitTermination()
    return spark.read.schema("url_hash string").parquet(out)


@query
def dedup_url_bounded(spark, sf):
    """The bounded stream dedup: all messages arrive within its span, so each url stays once."""
    stream_dedup.use_disk_state(spark)
    out = working_path(spark, "deduplicated")
    messages = _land(spark, _wire_events(spark, sf))
    events = envelope.normalize_events(envelope.parse_envelope(messages)).select("url_hash", "kafka_timestamp")
    run = (
        stream_dedup.dedup_stream_url_bounded(events)
        .writeStream.format("parquet")
        .option("checkpointLocation", working_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start(out)
    )
    run.awaitTermination()
    return spark.read.schema("url_hash string").parquet(out)


@query
def dedup_url_counted(spark, sf):
    """Urls in order, and in a second run in opposite order, past a memory of 20 urls for each of 16 shards: forgotten ones return."""
    stream_dedup.use_disk_state(spark)
    log, out, checkpoint = (working_path(spark, name) for name in ("log", "remembered", "checkpoint"))
    urls = corpus(spark, sf).events.select("url_hash")
    for turn, order in enumerate((F.col("url_hash"), F.translate("url_hash", "0123456789abcdef", "fedcba9876543210"))):
        fields = F.struct("url_hash", order.alias("sequence"), F.lit(turn).alias("turn"))
        event_log.append(urls.select(F.col("url_hash").alias("key"), F.to_json(fields).alias("value")), log)
        value = F.from_json(F.col("value").cast("string"), "url_hash string, sequence string, turn int")
        events = event_log.log_stream(spark, log, "earliest").select(value.alias("v")).select("v.*")
        kept = counted.dedup_counted(events, "url_hash", "sequence", remembered=16 * 20, shards=16, shard=F.left("url_hash", F.lit(1)))
        kept.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema("url_hash string, turn int").parquet(out)


@query
def stream_run_log(spark, sf):
    """The log of a stream that reads the messages of each language in a run of its own and keeps the first of each key."""
    stream_dedup.use_disk_state(spark)
    log, runs, checkpoint = (working_path(spark, name) for name in ("log", "runs", "checkpoint"))
    messages = _messages(spark, sf)
    language = F.coalesce(F.get_json_object("value", "$.language"), F.lit("es"))
    for name in ("de", "en", "es", "fr"):
        event_log.append(messages.where(language == name), log)
        kept = event_log.log_stream(spark, log, "earliest").dropDuplicates(["key"]).observe("kept", F.count(F.lit(1)).alias("rows"))
        with progress.StreamLog(spark, runs, "messages", written="kept"):
            writer = kept.writeStream.queryName("messages").format("noop").option("checkpointLocation", checkpoint)
            writer.trigger(availableNow=True).start().awaitTermination()
    return progress.read_log(spark, runs).select("query", "batch_id", "status", "rows_read", "rows_written", "rows_in_state")


@query
def backfill_coverage(spark, sf):
    events = table(spark, sf, "events")
    return quality.backfill_coverage(
        events, "ts", events.agg(F.min("ts")).scalar(), events.agg(F.max("ts")).scalar(), window_hours=6
    )
