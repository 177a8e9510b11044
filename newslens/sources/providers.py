"""Provider payloads to article events.

Each normaliser takes rows with a ``body`` (a landed response) and an ``ingested_at`` timestamp, and gives events in the
columns of the topic plus the raw item as JSON text (``raw_json``) and ``published_at_inferred``. A publishing time that
cannot be read is replaced by the ingestion time, and flagged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions.clock import iso_text, or_ingested, parse_compact, parse_iso, parse_mail_date
from newslens.functions.lookup import bound
from newslens.functions.text import event_id, first_nonblank, joined_hash, raw_variant, strip_all
from newslens.schemas import EVENT_FIELDS

# Fields of the providers' items, and the defaults of missing ones.
GDELT_ITEM = "struct<url:string,seendate:string,title:string,socialimage:string,excerpt:string,domain:string,sourcecountry:string,language:string>"
NEWSAPI_ITEM = "struct<source:struct<name:string>,author:string,title:string,description:string,content:string,url:string,publishedAt:string>"
ATOM_LINK = "array<struct<_href:string,_rel:string>>"
FEED = f"title string, entry array<struct<link:{ATOM_LINK},id:string,title:string,published:string,updated:string,summary:string,content:string,author:struct<name:string>>>, " + "channel struct<title:string,item:array<struct<link:string,id:string,guid:string,title:string,published:string,pubDate:string,summary:string,description:string,author:string,source:string>>>"
DEFAULT_LANGUAGE = "en"
BATCH_PROVIDER = "NEWSAPI"
DEFAULT_NEWSAPI_SOURCE = "unknown"
DEFAULT_GDELT_SOURCE = "gdelt"

EVENT_OUTPUT = (*EVENT_FIELDS, "raw_json", "published_at_inferred")


def _articles_text(body: Column) -> Column:
    """The ``articles`` field of a response as JSON text; null if missing, null or the body cannot be read."""
    return F.from_json(body, "articles string")["articles"]


def payload_problem(body: Column) -> Column:
    """Why a response cannot be used, or null: blank, not JSON, not an object, or ``articles`` that is no list.

    A missing or null ``articles`` is a response without articles, not a problem.
    """
    articles = _articles_text(body)
    return (
        F.when(body.isNull() | ~body.rlike(r"\S"), "blank body")
        .when(articles.startswith("[") & body.rlike(r"^\s*\{"), F.lit(None))
        .when(F.try_parse_json(body).isNull(), "not json")
        .when(~body.rlike(r"^\s*\{"), "not an object")
        .when(articles.isNotNull(), "articles is not a list")
    )


def quarantine(payloads: DataFrame) -> DataFrame:
    """Unusable responses with the reason."""
    return payloads.withColumn("reason", payload_problem(F.col("body"))).where(F.col("reason").isNotNull())


def _items(payloads: DataFrame, item: str) -> DataFrame:
    """One row per article of the usable responses: ``at`` (position), ``item``, ``raw_json``, ``ingested_at``.

    An unusable response has no list to explode, so it needs no filter here.
    """
    usable = F.when(F.col("body").rlike(r"^\s*\{"), _articles_text(F.col("body")))
    listed = bound(usable, lambda text: F.when(text.startswith("["), F.from_json(text, "array<string>")))
    return payloads.select("ingested_at", F.posexplode_outer(listed).alias("at", "raw_json")).select(
        "ingested_at", "at", F.from_json("raw_json", item).alias("item"), "raw_json"
    )


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _events(items: DataFrame, provider: str, url: Column, published: Column, **fields: Column) -> DataFrame:
    """Events from item columns; items without url are skipped."""
    kept = items.where(F.nullif(url, F.lit("")).isNotNull())
    published_at, inferred = or_ingested(published, F.col("ingested_at"))
    return (
        kept.select(
            F.lit(provider).alias("provider"),
            url.alias("url"),
            iso_text(published_at).alias("published_at"),
            inferred.alias("published_at_inferred"),
            iso_text(F.col("ingested_at")).alias("event_ingested_at"),
            *[column.alias(name) for name, column in fields.items()],
        )
        .withColumn("event_id", event_id("provider", "url", "published_at"))
        .select(*EVENT_OUTPUT)
    )


def normalize_gdelt(payloads: DataFrame) -> DataFrame:
    items = _items(payloads, GDELT_ITEM)
    item = F.col("item")
    summary = first_nonblank(item["socialimage"], item["excerpt"], default="")
    return _events(
        items,
        "gdelt",
        url=item["url"],
        published=parse_compact(item["seendate"]),
        provider_article_id=joined_hash(item["url"], item["seendate"]),
        title=_text(item["title"]),
        description=summary,
        content=summary,
        source_name=first_nonblank(item["domain"], item["sourcecountry"], default=DEFAULT_GDELT_SOURCE),
        author=F.lit(""),
        language=first_nonblank(item["language"], default=DEFAULT_LANGUAGE),
        country=_text(item["sourcecountry"]),
        raw_json=F.col("raw_json"),
    )


def normalize_newsapi(payloads: DataFrame) -> DataFrame:
    items = _items(payloads, NEWSAPI_ITEM)
    item = F.col("item")
    return _events(
        items,
        "newsapi",
        url=item["url"],
        published=parse_iso(item["publishedAt"]),
        provider_article_id=F.concat(F.lit("newsapi-"), F.col("at"), F.lit("-"), _text(item["publishedAt"])),
        title=_text(item["title"]),
        description=_text(item["description"]),
        content=_text(item["content"]),
        source_name=F.coalesce(item["source"]["name"], F.lit(DEFAULT_NEWSAPI_SOURCE)),
        author=_text(item["author"]),
        language=F.lit(DEFAULT_LANGUAGE),
        country=F.lit(""),
        raw_json=F.col("raw_json"),
    )


def batch_articles(payloads: DataFrame, load_batch_id: Column) -> DataFrame:
    """NewsAPI responses to rows for the upsert of batch articles, with ``sequence`` giving their order of arrival.

    Here missing fields stay null, the hash is of the url as it came, and a time that cannot be read is null. A response
    whose ``status`` is not "ok" has no articles to load; ``response_problems`` lists it.
    """
    ok = payloads.where(F.get_json_object("body", "$.status").eqNullSafe("ok"))
    items = _items(ok, NEWSAPI_ITEM).where(F.nullif(F.col("item.url"), F.lit("")).isNotNull())
    hashed = F.sha2("item.url", 256)
    return items.select(
        F.lit(BATCH_PROVIDER).alias("provider"),
        hashed.alias("provider_article_id"),
        F.col("item.source.name").alias("source_name"),
        "item.author",
        "item.title",
        "item.description",
        "item.content",
        "item.url",
        hashed.alias("url_hash"),
        parse_iso(F.col("item.publishedAt")).alias("published_at"),
        F.lit(DEFAULT_LANGUAGE).alias("language"),
        F.lit(None).cast("string").alias("country"),
        raw_variant("raw_json").alias("raw_json"),
        load_batch_id.alias("load_batch_id"),
        F.struct("ingested_at", "at").alias("sequence"),
    )


def response_problems(payloads: DataFrame) -> DataFrame:
    """NewsAPI responses that report a failure: (body, error_message of at most 300 characters of the response)."""
    failed = ~F.get_json_object("body", "$.status").eqNullSafe("ok")
    return payloads.where(failed).select("body", F.left("body", F.lit(300)).alias("error_message"))


def rejects(payloads: DataFrame) -> DataFrame:
    """Responses that give no articles to load, each once, in one pass: (body, reason), unusable ones before those that report a failure."""
    failure = F.when(~F.get_json_object("body", "$.status").eqNullSafe("ok"), F.left("body", F.lit(300)))
    reason = F.coalesce(payload_problem(F.col("body")), failure)
    # explode_outer and a filter behind it: a plain filter would find the reason a second time
    return payloads.select("body", F.explode_outer(F.array(reason)).alias("reason")).where(F.col("reason").isNotNull())


def feed_problems(feeds: DataFrame) -> DataFrame:
    """Feed documents that cannot be read, with the reason: blank, or neither RSS nor Atom (torn documents included)."""
    feed = F.from_xml("body", FEED)
    blank = F.col("body").isNull() | (strip_all("body") == "")
    unreadable = feed["channel"].isNull() & feed["entry"].isNull() & ~F.col("body").rlike(r"(?s)<feed[\s>].*</feed>\s*$")
    reason = F.when(blank, "blank body").when(F.coalesce(unreadable, F.lit(True)), "not a feed")
    return feeds.withColumn("reason", reason).where(F.col("reason").isNotNull())


def _feed_items(feeds: DataFrame) -> DataFrame:
    """One row per item of RSS and Atom documents, in common fields; an unreadable document has none (see ``feed_problems``)."""
    feed = F.from_xml("body", FEED)
    rss = F.transform(
        feed["channel"]["item"],
        lambda item: F.struct(
            item["link"].alias("link"), first_nonblank(item["id"], item["guid"]).alias("id"), item["title"].alias("title"),
            first_nonblank(item["published"], item["pubDate"]).alias("published"),
            first_nonblank(item["summary"], item["description"], default="").alias("summary"),
            item["author"].alias("author"), item["source"].alias("source"), F.to_json(item).alias("raw_json"),
        ),
    )

    def page(links: Column) -> Column:
        """The link to the page itself: of kind alternate or of no kind."""
        own = F.filter(links, lambda link: F.coalesce(link["_rel"], F.lit("alternate")) == "alternate")
        return F.get(F.coalesce(F.when(F.size(own) > 0, own), links), F.lit(0))["_href"]

    atom = F.transform(
        feed["entry"],
        lambda item: F.struct(
            page(item["link"]).alias("link"), item["id"].alias("id"), item["title"].alias("title"),
            first_nonblank(item["published"], item["updated"]).alias("published"),
            first_nonblank(item["summary"], item["content"], default="").alias("summary"),
            item["author"]["name"].alias("author"), F.lit(None).cast("string").alias("source"), F.to_json(item).alias("raw_json"),
        ),
    )
    title = F.coalesce(feed["channel"]["title"], feed["title"])
    return feeds.select("ingested_at", title.alias("feed"), F.posexplode(F.coalesce(rss, atom)).alias("at", "item"))


def normalize_rss(feeds: DataFrame, provider: str = "rss") -> DataFrame:
    """Feed documents (RSS or Atom) to events. An item without ``source`` takes the feed's title, else the provider's name."""
    items = _feed_items(feeds).withColumn("raw_json", F.col("item.raw_json"))
    item = F.col("item")
    return _events(
        items,
        provider,
        url=item["link"],
        published=F.coalesce(parse_mail_date(item["published"]), parse_iso(item["published"])),
        provider_article_id=F.coalesce(item["id"], F.sha2(item["link"], 256)),
        title=_text(item["title"]),
        description=item["summary"],
        content=item["summary"],
        source_name=F.coalesce(item["source"], F.col("feed"), F.lit(provider)),
        author=_text(item["author"]),
        language=F.lit(DEFAULT_LANGUAGE),
        country=F.lit(""),
        raw_json=F.col("raw_json"),
    )
