from datetime import date, datetime

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from newslens.functions.text import message_key, url_hash
from newslens.operators import marts, mentions, tiles

T1, T2 = datetime(2024, 1, 1, 10, 0, 5), datetime(2024, 1, 1, 10, 0, 50)
MATCHED = "event_id string, url_hash string, company_id bigint, published_at_ts timestamp_ntz, sentiment_score double"
SCORES = "article_id bigint, company_id bigint, model_name string, sentiment_score double, sentiment_label string"


@pytest.fixture
def double_hit(rows):
    """An article that names company 1 by two aliases, and another that names it once, in one minute."""
    return rows([("a", "ha", 1, T1, 1.0), ("a", "ha", 1, T1, 1.0), ("b", "hb", 1, T2, 0.0)], MATCHED)


def test_minute_mart_weighs_an_article_once(double_hit):
    assert tuples(marts.minute_mart(double_hit)) == [(datetime(2024, 1, 1, 10), 1, 2, 0.5)]


def test_minute_mart_per_alias_hit(double_hit):
    bucket, company, count, mean = tuples(marts.minute_mart(double_hit, per_alias_hit=True))[0]
    assert (count, round(mean, 3)) == (2, 0.667)


def test_hour_mart(double_hit):
    assert tuples(marts.hour_mart(double_hit)) == [(datetime(2024, 1, 1, 10), 1, 2, 0.5)]


def test_daily_mart_keeps_unscored_mentions_and_drops_undated(rows):
    articles = rows([(1, T1), (2, T1), (3, None)], "article_id bigint, published_at timestamp_ntz")
    found = rows([(1, 1), (2, 1), (3, 1)], "article_id bigint, company_id bigint")
    scores = rows([(1, 1, "ai_sentiment_v1", 1.0, "positive"), (1, 1, "x", -1.0, "negative"), (2, 1, "x", -1.0, "negative")],
                  SCORES)
    as_of = F.lit(T2).cast("timestamp_ntz")
    one = marts.daily_mart(articles, found, scores, as_of).drop("updated_at")
    assert tuples(one) == [(date(2024, 1, 1), 1, 2, 1.0, 1, 0, 0)]
    all_models = marts.daily_mart(articles, found, scores, as_of, model_name=None).drop("updated_at")
    assert [(r[2], round(r[3], 4), *r[4:]) for r in tuples(all_models)] == [(2, -0.3333, 1, 0, 2)]


def test_trend_over_rows_differs_from_trend_over_companies(rows):
    unified = rows([(T1, 1, 1.0, T1), (T1, 1, 1.0, T1), (T1, 2, 0.0, T1)],
                   "published_at_ts timestamp_ntz, company_id bigint, sentiment_score double, loaded_at timestamp_ntz")
    assert tuples(marts.daily_trend(unified))[0][1:3] == (3, 0.667)
    mart = rows([(date(2024, 1, 1), 2, 1.0), (date(2024, 1, 1), 1, 0.0)],
                "metric_date date, article_count bigint, avg_sentiment double")
    assert tuples(marts.daily_trend_batch(mart, F.lit(None)))[0][1:3] == (3, 0.5)


def test_canonical_hash_joins_paths_that_stored_different_hashes(rows):
    df = rows([("HTTP://A ",)], "url string")
    stored = message_key("url")
    made = df.select(
        mentions.canonical_hash(F.col("url"), stored, False).alias("m"),
        mentions.canonical_hash(F.col("url"), stored, True).alias("t"),
        stored.alias("s"),
        url_hash("url").alias("u"),
    ).first()
    assert made["m"] == made["u"] != made["s"] == made["t"]
    missing = rows([(None,)], "url string").select(mentions.canonical_hash(F.col("url"), F.lit("kept"), False))
    assert missing.first()[0] == "kept"


def test_realtime_defaults(rows):
    ddl = ("event_id string, provider string, source_name string, url string, url_hash string, published_at_ts "
           "timestamp_ntz, company_id bigint, sentiment_score double, article_text string, loaded_at timestamp_ntz")  # fmt: skip
    row = mentions.realtime_mentions(rows([("e", None, None, "u", None, T1, 1, None, "t", T2)], ddl)).first()
    assert (row.provider, row.sentiment_score, row.sentiment_label) == ("gdelt", 0.0, "neutral")
    assert (row.sentiment_model, row.ingest_path) == ("vader_v1", "realtime")


def test_unify_refuses_drifted_columns(rows):
    from newslens.schemas import UNIFIED_COLUMNS

    good = rows([], ", ".join(f"{c} string" for c in UNIFIED_COLUMNS))
    with pytest.raises(Exception, match="url"):
        mentions.unify_paths(good, good.drop("url")).count()


@pytest.mark.parametrize("as_variant", [False, True])
def test_flatten_takes_the_overall_category(rows, as_variant):
    objects = [
        (1, '{"categories":[{"name":"Overall","sentiment":"Positive"},{"name":"price","sentiment":"negative"}]}'),
        (2, '{"categories":[]}'),
        (3, "{}"),
        (4, None),
    ]
    df = rows(objects, "article_id bigint, ai_obj string")
    if as_variant:
        df = df.withColumn("ai_obj", F.parse_json("ai_obj"))
    assert tuples(mentions.ai_sentiment_flatten(df)) == [(1, "positive")]


def test_blank_texts_are_not_scored(rows):
    articles = rows([(1, "a", None, None), (2, None, " ", "")],
                    "article_id bigint, title string, description string, content string")
    found = rows([(1, 1), (1, 2), (2, 1)], "article_id bigint, company_id bigint")
    scored = mentions.score_mentions(found, articles, lambda t: F.lit(0.3), "m", F.lit(T1).cast("timestamp_ntz"))
    assert tuples(scored.select("article_id", "company_id", "sentiment_label"), "company_id") == [
        (1, 1, "positive"), (1, 2, "positive"),
    ]
    assert mentions.mention_texts(found, articles).count() == 2


def test_reports_leave_out_companies_without_rows(rows):
    companies = rows([(1, "A", "a"), (8, "H", "h")], "company_id bigint, ticker string, company_name string")
    unified = rows([(1, T1), (1, T2)], "company_id bigint, loaded_at timestamp_ntz")
    assert tuples(marts.article_volume(unified, companies)) == [(1, "A", "a", 2, T2)]


def test_null_source_is_unknown(rows):
    df = rows([(None, T1), ("s", T1), (None, T2)], "source_name string, loaded_at timestamp_ntz")
    assert tuples(tiles.tile_top_sources(marts.top_sources(df))) == [("UNKNOWN", 2, T2), ("s", 1, T1)]


def test_matching_quality(rows):
    articles = rows([(1,), (2,), (2,), (3,)], "article_id bigint")
    found = rows([(1, 1), (1, 2), (9, 1)], "article_id bigint, company_id bigint")
    assert tuples(marts.matching_quality(articles, found)) == [(3, 1, 2)]


def test_stacked_tile_is_one_scan(rows):
    summary = rows([("A", 3, 2, 1, T1)],
                   "ticker string, positive_count bigint, neutral_count bigint, negative_count bigint, refreshed_at timestamp_ntz")
    assert tuples(tiles.sentiment_stacked(summary).drop("refreshed_at")) == [
        ("A", "negative", 1), ("A", "neutral", 2), ("A", "positive", 3),
    ]


def test_tile_ties_are_settled(rows):
    data = [(f"T{i}", "positive", 0.9, T1, "s", "t", f"u{i}") for i in range(40)] + [("N", "neutral", None, T1, "s", "t", "u")]
    ddl = ("ticker string, sentiment_label string, sentiment_score double, published_at timestamp_ntz, source_name "
           "string, title string, url string")  # fmt: skip
    got = [r["url"] for r in tiles.tile_examples(rows(data, ddl)).collect()]
    assert got == sorted(f"u{i}" for i in range(40))[:25]
