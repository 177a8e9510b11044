import hashlib
import json
from datetime import date, datetime

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from newslens.sources import envelope, providers, staged, tables

NOW = datetime(2026, 5, 1, 12, 0, 0)


@pytest.fixture
def payloads(rows):
    def make(*bodies):
        texts = [b if b is None or isinstance(b, str) else json.dumps(b) for b in bodies]
        return rows([(t, NOW) for t in texts], "body string, ingested_at timestamp_ntz")

    return make


def test_gdelt(payloads):
    article = {"url": "http://a", "seendate": "20260401101112", "title": "T", "socialimage": None, "excerpt": "",
               "domain": "", "sourcecountry": "US", "extra": 1}
    got = providers.normalize_gdelt(payloads({"articles": [article, {"title": "no url"}, {"url": ""}]})).collect()
    assert len(got) == 1
    row = got[0]
    assert row.provider_article_id == hashlib.sha256(b"http://a|20260401101112").hexdigest()
    assert row.published_at == "2026-04-01T10:11:12+00:00" and not row.published_at_inferred
    assert row.event_id == hashlib.sha256(b"gdelt|http://a|2026-04-01T10:11:12+00:00").hexdigest()
    assert (row.description, row.content, row.source_name, row.language, row.country) == ("", "", "US", "en", "US")
    assert json.loads(row.raw_json)["extra"] == 1


def test_gdelt_time_that_cannot_be_read_is_inferred(payloads):
    row = providers.normalize_gdelt(payloads({"articles": [{"url": "u", "seendate": "bad"}]})).first()
    assert row.published_at == "2026-05-01T12:00:00+00:00" and row.published_at_inferred
    assert row.source_name == "gdelt"


def test_payload_rules(payloads):
    good = payloads({"status": "ok"}, {"articles": None}, {"articles": []})
    assert providers.normalize_gdelt(good).count() == 0
    assert providers.quarantine(good).count() == 0
    bad = payloads({"articles": {"bad": True}}, {"articles": "x"}, {"articles": 3}, "", "  \n", None, "[1]", '"x"', "{broken",
                   '[{"articles": []}]')
    assert providers.normalize_gdelt(bad).count() == 0
    reasons = [r["reason"] for r in providers.quarantine(bad).collect()]
    assert reasons == ["articles is not a list"] * 3 + ["blank body"] * 3 + ["not an object"] * 2 + ["not json", "not an object"]


def test_newsapi_positions_count_skipped_items(payloads):
    body = {"status": "ok", "articles": [
        {"url": None, "title": "skipped"},
        {"url": "u", "publishedAt": "2026-04-01T10:00:00Z", "source": {"name": "S"}, "title": None},
        {"url": "v", "source": None},
    ]}
    got = {r.url: r for r in providers.normalize_newsapi(payloads(body)).collect()}
    assert got["u"].provider_article_id == "newsapi-1-2026-04-01T10:00:00Z" and got["u"].source_name == "S"
    assert got["u"].title == "" and got["u"].published_at == "2026-04-01T10:00:00+00:00"
    assert got["v"].provider_article_id == "newsapi-2-" and got["v"].source_name == "unknown"
    assert got["v"].published_at_inferred


def test_batch_articles(payloads):
    body = {"status": "ok", "articles": [{"url": "http://A", "publishedAt": "soon", "title": "T", "extra": 5}, {"title": "x"}]}
    responses = payloads(body, {"status": "error", "code": "rateLimited", "articles": [{"url": "lost"}]}, "")
    row = providers.batch_articles(responses, F.lit("b")).select("*", F.try_variant_get("raw_json", "$.extra", "int").alias("e"))
    (got,) = row.drop("raw_json").collect()
    assert got.url_hash == got.provider_article_id == hashlib.sha256(b"http://A").hexdigest()
    assert (got.provider, got.published_at, got.description, got.source_name, got.e) == ("NEWSAPI", None, None, None, 5)
    assert got.sequence.at == 0
    assert providers.response_problems(responses).count() == 2


def test_rss_files(spark, tmp_path):
    feed = """<rss><channel><title>The Feed</title>
      <item><link>http://a</link><guid isPermaLink="false">g1</guid><title>A &amp; B</title>
        <pubDate>Wed, 21 Oct 2037 07:28:00 GMT</pubDate><description>d</description><source url="x">Src</source></item>
      <item><link>http://b</link><title>second</title></item>
      <item><title>no link</title></item></channel></rss>"""
    (tmp_path / "feed.xml").write_text(feed)
    (tmp_path / "broken.xml").write_text("not a feed")
    bodies = staged.read_payloads(spark, str(tmp_path)).withColumn("ingested_at", F.lit(NOW).cast("timestamp_ntz"))
    got = {r.url: r for r in providers.normalize_rss(bodies).collect()}
    assert set(got) == {"http://a", "http://b"}
    a, b = got["http://a"], got["http://b"]
    assert (a.provider_article_id, a.title, a.published_at, a.description, a.source_name) == (
        "g1", "A & B", "2037-10-21T07:28:00+00:00", "d", "Src",
    )
    assert b.provider_article_id == hashlib.sha256(b"http://b").hexdigest() and b.source_name == "The Feed"
    assert b.published_at_inferred and b.description == ""


def test_staged_csv(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b,c\n"x, y",NULL,1\n"",null,2\n"say ""hi""",NULLS,3\n')
    got = staged.read_staged_csv(spark, str(tmp_path / "f.csv"), "a string, b string, c bigint")
    assert tuples(got, "c") == [("x, y", None, 1), (None, None, 2), ('say "hi"', "NULLS", 3)]


def test_staged_json(spark, tmp_path):
    (tmp_path / "f.json").write_text('{"a": 1}\n{"a": 2, "b": "x"}\n')
    assert tuples(staged.read_staged_json(spark, str(tmp_path), "a bigint, b string"), "a") == [(1, None), (2, "x")]


def messages(rows, *values):
    return rows([(v, NOW) for v in values], "value string, timestamp timestamp")


def event(**fields):
    base = {"event_id": "e", "provider": "gdelt", "title": "T", "url": "http://a", "published_at": "2026-04-01T10:00:00+02:00",
            "event_ingested_at": "2026-04-01T11:00:00+00:00"}
    return json.dumps({**base, **fields})


def test_envelope_round_trip(rows):
    df = rows([("e", "http://A", "T")], "event_id string, url string, title string")
    sent = envelope.event_envelope(df).first()
    assert sent["key"] == hashlib.sha256(b"http://A").hexdigest()
    parsed = envelope.parse_envelope(messages(rows, sent["value"])).first()
    assert (parsed.event_id, parsed.url, parsed.title, parsed.kafka_timestamp) == ("e", "http://A", "T", NOW)


def test_normalised_events(rows):
    got = envelope.normalize_events(
        envelope.parse_envelope(
            messages(rows, event(), event(url=None), event(title=None), event(title="", event_id="empty"), "{broken",
                     event(event_id="late", published_at="garbage"),
                     event(event_id="later", published_at="", event_ingested_at="garbage"))
        )
    )
    kept = {r.event_id: r for r in got.collect()}
    assert set(kept) == {"e", "empty", "late", "later"}
    assert kept["e"].published_at_ts == datetime(2026, 4, 1, 8) and not kept["e"].published_at_inferred
    assert kept["late"].published_at_ts == datetime(2026, 4, 1, 11) and kept["late"].published_at_inferred
    assert kept["later"].published_at_ts == NOW
    assert kept["e"].url_hash == hashlib.sha256(b"http://a").hexdigest()


def test_smoke_event_names_two_companies(spark):
    from newslens.functions.text import article_text
    from newslens.operators.dimensions import alias_seeds
    from newslens.operators.matching import match_substring

    smoke = envelope.smoke_event(spark, "1").withColumn("article_text", article_text("title", "description", "content"))
    aliases = alias_seeds(spark).selectExpr("hash(ticker) AS company_id", "lower(alias) AS alias_norm")
    assert match_substring(smoke, aliases).select("company_id").distinct().count() == 2


def test_published_versions_replace_each_other(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    assert tables.current(spark, path) is None
    tables.publish(rows([(1,), (1,)], "a int"), path)
    before = tables.current(spark, path)
    assert tables.truncate_reload(spark, path, lambda df: df.distinct()).count() == 1
    assert before.count() == 2  # a reader of the old version is not disturbed
    (tmp_path / "t" / "version=9").mkdir()  # a run that died before its commit
    assert tables.current(spark, path).count() == 1
    assert tables.publish(rows([(5,)], "a int"), path) == 10
    tables.remove_old_versions(spark, path, keep=1)
    assert tables.current(spark, path).count() == 1 and not (tmp_path / "t" / "version=1").exists()


def test_feeds_of_both_kinds(rows):
    rss = "<rss><channel><title>R</title><item><link>http://a</link><title>t</title><pubDate>Mon, 01 Jan 2024 10:00:00 GMT</pubDate></item></channel></rss>"
    atom = (
        '<feed xmlns="http://www.w3.org/2005/Atom"><title>A</title><entry><link rel="self" href="http://s"/><link href="http://b"/>'
        "<id>1</id><title>u</title><updated>2024-01-02T10:00:00Z</updated><content>c</content><author><name>n</name></author></entry></feed>"
    )
    bodies = [rss, atom, rss[:60], atom[:90], "", None, "<html></html>", '<feed xmlns="http://www.w3.org/2005/Atom"></feed>']
    feeds = rows([(b, NOW) for b in bodies], "body string, ingested_at timestamp_ntz")
    got = {r.url: r for r in providers.normalize_rss(feeds).collect()}
    assert set(got) == {"http://a", "http://b"} and got["http://b"].author == "n" and got["http://b"].content == "c"
    assert got["http://b"].published_at.startswith("2024-01-02T10:00:00") and got["http://a"].source_name == "R"
    problems = sorted(map(str, ((r.body, r.reason) for r in providers.feed_problems(feeds).collect())))
    assert problems == sorted(map(str, [(b, "not a feed") for b in (rss[:60], atom[:90], "<html></html>")] + [("", "blank body"), (None, "blank body")]))


def test_touched_partitions_only(spark, rows, tmp_path):
    path, ddl = str(tmp_path / "m"), "d date, n int"
    one, two = date(2024, 1, 1), date(2024, 1, 2)
    tables.overwrite_touched(rows([(one, 1), (two, 2)], ddl), path, ["d"])
    tables.overwrite_touched(rows([(two, 3)], ddl), path, ["d"])
    assert tuples(spark.read.parquet(path).select("d", "n"), "d") == [(one, 1), (two, 3)]
    tables.overwrite_partition(rows([], ddl), path, "d", one)
    assert tuples(spark.read.schema(ddl).parquet(path).select("d", "n")) == [(two, 3)]


def test_retired_models_are_emptied(spark, rows, tmp_path):
    path, ddl = str(tmp_path / "s"), "article_id bigint, model_name string"
    tables.overwrite_touched(rows([(1, "rule_based_v1"), (2, "ai_sentiment_v1"), (3, "x")], ddl), path, ["model_name"])
    tables.replace_model_partitions(
        rows([(9, "ai_sentiment_v1"), (8, "second")], ddl), path, ["rule_based_v1", "ai_sentiment_v1", "never_there"]
    )
    got = spark.read.schema(ddl).parquet(path)
    assert tuples(got.select("article_id", "model_name"), "article_id") == [(3, "x"), (8, "second"), (9, "ai_sentiment_v1")]
