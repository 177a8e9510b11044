from datetime import date, datetime

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from newslens.operators import dedup, dimensions, upsert
from newslens.sources import tables

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
SENTIMENT = "sentiment_id bigint, article_id bigint, company_id bigint, scored_at timestamp_ntz"
UNIFIED = "record_id string, canonical_url_hash string, company_id bigint, loaded_at timestamp_ntz, ingest_path string"


def test_latest_sentiment_breaks_ties_by_id(rows):
    df = rows([(7, 1, 1, T2), (3, 1, 1, T2), (1, 1, 1, T1), (9, 2, 1, None)], SENTIMENT)
    assert tuples(dedup.latest_sentiment(df).select("sentiment_id"), "sentiment_id") == [(3,), (9,)]


def test_rows_without_hash_are_their_own_article(rows):
    df = rows([("a", None, 1, T1, "legacy"), ("b", None, 1, T2, "legacy"), ("a", None, 1, T2, "realtime"),
               ("c", "h", 1, T1, "legacy"), ("d", "h", 1, T2, "realtime")], UNIFIED)
    kept = dedup.latest_url_company(df)
    assert sorted(tuples(kept.select("record_id", "ingest_path"))) == [
        ("a", "legacy"), ("a", "realtime"), ("b", "legacy"), ("d", "realtime"),
    ]
    assert kept.columns == df.columns


def test_hot_key_is_reduced_before_the_shuffle(spark):
    events = spark.range(1000).select(
        (F.col("id") % 1).cast("string").alias("event_id"), F.lit(1).alias("company_id"), F.lit(T1).cast("timestamp_ntz").alias("loaded_at"),
        F.col("id").cast("string").alias("ingest_batch_id"),
    )
    latest = dedup.latest_event_company(events)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert plan.index("WindowGroupLimit", exchange) > exchange  # the partial limit sits below the exchange
    assert tuples(latest.select("ingest_batch_id")) == [("999",)]


def test_duplicate_reports(rows):
    base = rows([("e", 1, T1), ("e", 1, T2), ("f", 1, T1)], "event_id string, company_id bigint, loaded_at timestamp_ntz")
    assert tuples(dedup.duplicate_loads(base)) == [("e", 1, 2, T1, T2)]
    aliases = rows([(1, 1, "a"), (2, 1, "a"), (3, 2, "a")], "alias_id bigint, company_id bigint, alias string")
    assert tuples(dedup.duplicate_aliases(aliases)) == [(1, "a", 2)]
    assert tuples(dedup.dedup_aliases(aliases).select("alias_id"), "alias_id") == [(1,), (3,)]


def test_one_survivor_per_url_of_a_run(rows):
    df = rows([(1, "http://a"), (2, "HTTP://A "), (3, "\thttp://a\n"), (4, "http://b")], "n bigint, url string")
    assert tuples(dedup.dedup_url_batch(df, [F.col("n").asc()]).select("n"), "n") == [(1,), (4,)]


def test_upsert_keeps_inserts_and_updates(rows):
    ddl = "provider string, url string, title string, ingested_at timestamp_ntz, is_duplicate boolean"
    target = rows([("p", "kept", "old", T1, True), ("p", "both", "old", T1, True), ("p", None, "old", T1, True)], ddl)
    source = rows([("p", "both", "first", 1), ("p", "both", "last", 2), ("p", "new", "n", 3), ("p", None, "z", 4)],
                  "provider string, url string, title string, seq int")
    got = upsert.upsert_articles(target, source, F.lit(T2).cast("timestamp_ntz"), F.col("seq"))
    assert sorted(tuples(got), key=str) == sorted(
        [("p", "kept", "old", T1, True), ("p", "both", "last", T2, False), ("p", "new", "n", T2, False),
         ("p", None, "old", T1, True), ("p", None, "z", T2, False)], key=str)


@pytest.mark.parametrize("small_source", [False, True])
def test_both_upsert_plans_give_the_same_rows(rows, small_source):
    target = rows([(1, "a", "x"), (2, "b", "x"), (None, "c", "x")], "k bigint, v string, note string")
    source = rows([(2, "B"), (3, "C"), (None, "N")], "k bigint, v string")
    got = upsert.upsert(target, source, ["k"], ["v"], {"note": F.lit("upd")}, {"note": F.lit("new")}, small_source)
    assert sorted(tuples(got), key=str) == sorted(
        [(1, "a", "x"), (2, "B", "upd"), (3, "C", "new"), (None, "c", "x"), (None, "N", "new")], key=str
    )


def test_merge_reads_and_rewrites_touched_days_only(spark, rows, tmp_path):
    ddl, path = "metric_date date, company_id bigint, article_count bigint", str(tmp_path / "mart")
    one, two = date(2024, 1, 1), date(2024, 1, 2)
    tables.merge_touched(rows([(one, 1, 1), (two, 1, 1), (two, 2, 1)], ddl), path, "metric_date", upsert.upsert_daily_mart)
    untouched = {f.name for f in (tmp_path / "mart" / "metric_date=2024-01-01").iterdir()}
    tables.merge_touched(rows([(two, 2, 7), (two, 3, 9)], ddl), path, "metric_date", upsert.upsert_daily_mart)
    tables.merge_touched(rows([], ddl), path, "metric_date", upsert.upsert_daily_mart)
    assert {f.name for f in (tmp_path / "mart" / "metric_date=2024-01-01").iterdir()} == untouched
    got = spark.read.parquet(path).select("metric_date", "company_id", "article_count")
    assert tuples(got, "metric_date", "company_id") == [(one, 1, 1), (two, 1, 1), (two, 2, 7), (two, 3, 9)]


def test_merge_keeps_the_columns_of_the_table(spark, rows, tmp_path):
    path = str(tmp_path / "mentions")
    tables.overwrite_touched(rows([(1, 1, 7, "old", "a")], "article_id int, company_id int, mention_id int, matched_text string, day string"), path, ["day"])

    def merge(target, source):
        return upsert.upsert(target, source, ["article_id", "company_id"], ["matched_text"])

    tables.merge_touched(rows([(1, 1, "new", "a"), (2, 1, "x", "a")], "article_id int, company_id int, matched_text string, day string"), path, "day", merge)
    got = spark.read.parquet(path).select("article_id", "mention_id", "matched_text")
    assert tuples(got, "article_id") == [(1, 7, "new"), (2, None, "x")]
    with pytest.raises(ValueError):
        tables.merge_touched(rows([(1, "a", 1)], "article_id int, day string, other int"), path, "day", merge)


def test_a_failed_merge_loses_nothing(spark, rows, tmp_path):
    path, ddl = str(tmp_path / "m"), "day string, n int"
    tables.overwrite_touched(rows([("a", 1)], ddl), path, ["day"])
    with pytest.raises(Exception, match="stop"):
        tables.merge_touched(rows([("a", 2)], ddl), path, "day", lambda t, s: t.unionByName(s).selectExpr("day", "raise_error('stop')::int AS n"))
    assert tuples(spark.read.parquet(path).select("day", "n")) == [("a", 1)]


def test_inserted_rows_are_numbered(rows):
    target = rows([(1, 1, 5, "x", T1)], "article_id bigint, company_id bigint, mention_id bigint, matched_text string, created_at timestamp_ntz")
    source = rows([(1, 1, "y"), (2, 1, "z"), (3, 1, "z")], "article_id bigint, company_id bigint, matched_text string")
    for small in (False, True):
        got = upsert.upsert_mentions(target, source, F.lit(T2).cast("timestamp_ntz"), small)
        assert sorted(r.mention_id for r in got.collect()) == [5, 6, 7]


def test_upsert_daily_mart(rows):
    ddl = "metric_date date, company_id bigint, article_count bigint, avg_sentiment double"
    day = date(2024, 1, 1)
    target = rows([(day, 1, 1, 0.5), (day, 2, 1, 0.5)], ddl)
    source = rows([(day, 2, 5, None), (day, 3, 1, 0.1)], ddl)
    got = upsert.upsert_daily_mart(target, source)
    assert tuples(got, "company_id") == [(day, 1, 1, 0.5), (day, 2, 5, None), (day, 3, 1, 0.1)]


def test_insert_only_merge_changes_nothing_known(rows):
    target = rows([(1, "a", "old")], "company_id bigint, alias string, kind string")
    source = rows([(1, "a", "new"), (2, "b", "new")], "company_id bigint, alias string, kind string")
    got = upsert.insert_missing(target, source, ["company_id", "alias"])
    assert tuples(got, "company_id") == [(1, "a", "old"), (2, "b", "new")]


def test_replace_models(rows):
    ddl = "article_id bigint, model_name string"
    existing = rows([(1, "rule_based_v1"), (2, "ai_sentiment_v1"), (3, "other")], ddl)
    got = upsert.replace_models(existing, rows([(9, "ai_sentiment_v1")], ddl), ["rule_based_v1", "ai_sentiment_v1"])
    assert tuples(got, "article_id") == [(3, "other"), (9, "ai_sentiment_v1")]


def test_numbers_are_dense_and_start_after_the_largest(spark, rows):
    df = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    old = rows([(41,)], "n bigint")
    got = dimensions.number_new_rows(df, ["key"], "n", old)
    assert sorted(r["n"] for r in got.collect()) == list(range(42, 3042))
    again = dimensions.number_new_rows(df.repartition(5), ["key"], "n", old)
    assert got.exceptAll(again.select(*got.columns)).isEmpty()


def test_seeding_twice_adds_nothing(spark, rows):
    columns = "ticker string, company_name string, exchange string, sector string, industry string, country string"
    empty = rows([], f"company_id bigint, {columns}")
    once = dimensions.seed_dimension(empty, dimensions.company_seeds(spark), ["ticker"], "company_id")
    twice = dimensions.seed_dimension(once, dimensions.company_seeds(spark), ["ticker"], "company_id")
    assert once.count() == 12 and twice.exceptAll(once).isEmpty() and twice.count() == 12
    aliases = dimensions.resolve_aliases(once, dimensions.alias_seeds(spark))
    nothing = rows([], "alias_id bigint, company_id bigint, alias string, alias_type string")
    seeded = dimensions.seed_dimension(nothing, aliases, ["company_id", "alias"], "alias_id")
    assert sorted(r["alias_id"] for r in seeded.collect()) == list(range(1, 17))
