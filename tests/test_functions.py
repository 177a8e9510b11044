import hashlib
from datetime import datetime

from pyspark.sql import functions as F

from newslens.functions import clock, text
from newslens.functions.aggregates import exact_avg, rounded_avg
from newslens.functions.lookup import HashedMap, key_hash


def one(df, column):
    return df.select(column.alias("x")).first()["x"]


def test_url_hash_ignores_case_and_outer_spaces(rows):
    df = rows([("http://a",), ("HTTP://A ",), (" http://A",)], "url string")
    assert df.select(text.url_hash("url")).distinct().count() == 1
    assert one(df.limit(1), text.url_hash("url")) == hashlib.sha256(b"http://a").hexdigest()
    assert one(rows([(None,)], "url string"), text.url_hash("url")) is None


def test_event_id_counts_null_as_empty(rows):
    df = rows([("gdelt", "u", None)], "p string, u string, t string")
    assert one(df, text.event_id("p", "u", "t")) == hashlib.sha256(b"gdelt|u|").hexdigest()


def test_article_text_keeps_inner_spaces(rows):
    df = rows([("a", None, "c")], "title string, description string, content string")
    assert one(df, text.article_text("title", "description", "content")) == "a  c"
    df = rows([("", "", "")], "title string, description string, content string")
    assert one(df, text.article_text("title", "description", "content")) == ""


def test_first_nonblank_takes_empty_text_as_missing(rows):
    df = rows([("", None, "x")], "a string, b string, c string")
    assert one(df, text.first_nonblank("a", "b", "c", default="d")) == "x"
    assert one(df, text.first_nonblank("a", "b", default="d")) == "d"


def test_strip_all_takes_tabs(rows):
    df = rows([("\t http://a \n",)], "u string")
    assert one(df, text.strip_all("u")) == "http://a"
    assert one(df, F.trim("u")) == "\t http://a \n"


def test_parse_iso(rows):
    cases = {
        "garbage": None,
        "": None,
        None: None,
        "2024-03-01T12:00:00+02:00": datetime(2024, 3, 1, 10),
        "2024-03-01T12:00:00Z": datetime(2024, 3, 1, 12),
        "2024-03-01T12:00:00.250000+00:00": datetime(2024, 3, 1, 12, 0, 0, 250000),
        "2024-03-01 12:00:00": datetime(2024, 3, 1, 12),
        "2024-03-01": datetime(2024, 3, 1),
    }
    df = rows([(k,) for k in cases], "t string").select("t", clock.parse_iso(F.col("t")).alias("x"))
    assert {r["t"]: r["x"] for r in df.collect()} == cases


def test_parsing_does_not_depend_on_the_session_zone(spark, rows):
    df = rows([("2024-03-01T12:00:00+02:00", "20260401101112", "Wed, 21 Oct 2037 07:28:00 GMT")], "a string, b string, c string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = df.select(
            clock.parse_iso(F.col("a")), clock.parse_compact(F.col("b")), clock.parse_mail_date(F.col("c"))
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(got) == (datetime(2024, 3, 1, 10), datetime(2026, 4, 1, 10, 11, 12), datetime(2037, 10, 21, 7, 28))


def test_parse_compact(rows):
    cases = {
        "20260401101112": datetime(2026, 4, 1, 10, 11, 12),
        "20260401T101112Z": datetime(2026, 4, 1, 10, 11, 12),
        "bad": None,
        "20269901101112": None,
    }
    df = rows([(k,) for k in cases], "t string").select("t", clock.parse_compact(F.col("t")).alias("x"))
    assert {r["t"]: r["x"] for r in df.collect()} == cases


def test_parse_mail_date(rows):
    cases = {
        "Wed, 21 Oct 2037 07:28:00 GMT": datetime(2037, 10, 21, 7, 28),
        "Thu, 1 Oct 2037 07:28:00 +0200": datetime(2037, 10, 1, 5, 28),
        "21 Oct 2037 07:28:00 GMT": datetime(2037, 10, 21, 7, 28),
        "yesterday": None,
    }
    df = rows([(k,) for k in cases], "t string").select("t", clock.parse_mail_date(F.col("t")).alias("x"))
    assert {r["t"]: r["x"] for r in df.collect()} == cases


def test_exact_avg_of_nothing_is_null(rows):
    df = rows([(None,), (None,)], "s double")
    assert df.agg(exact_avg(F.col("s")).alias("x")).first()["x"] is None


def test_rounded_avg_rounds_the_true_mean(rows):
    df = rows([(0.1405,), (0.1404,), (0.1406,)], "s double")  # the quotient is 0.14049999999999999 as a double
    assert df.agg(rounded_avg(F.col("s")).alias("x")).first()["x"] == 0.141


def test_hashed_map_finds_every_key_and_nothing_else(spark, rows):
    keys = [f"key{i}" for i in range(500)] + ["", "ü", "汉字"]
    hashed = rows([(k,) for k in keys], "k string").select("k", key_hash("k").alias("h")).collect()
    table = HashedMap.build(((r["k"], r["h"], len(r["k"])) for r in hashed), "int")
    df = rows([(k,) for k in keys + ["absent", "KEY1"]], "k string").select("k", table.get(F.col("k")).alias("x"))
    got = {r["k"]: r["x"] for r in df.collect()}
    assert all(got[k] == len(k) for k in keys)
    assert got["absent"] is None and got["KEY1"] is None
