from datetime import date, datetime, timedelta

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from newslens.operators import quality
from newslens.plans import refresh
from newslens.schemas import UNIFIED_COLUMNS
from newslens.session import working_path, working_root

START = datetime(2024, 1, 1)


def ntz(value):
    return F.lit(value).cast("timestamp_ntz")


def test_coverage_against_a_plain_loop(rows):
    now = START + timedelta(hours=31)
    moments = [START + timedelta(seconds=s) for s in (0, 21600, 21601, 43201, 43202, 50000, 111600, 111601, -1)]
    moments.append(START + timedelta(seconds=21600, microseconds=500_000))  # between two windows
    windows, at, number = [], START, 0
    while at < now:
        end = min(at + timedelta(hours=6), now)
        windows.append((number, at, end, sum(at <= m <= end for m in moments)))
        at, number = end + timedelta(seconds=1), number + 1
    got = quality.backfill_coverage(rows([(m,) for m in moments], "ts timestamp_ntz"), "ts", ntz(START), ntz(now))
    assert tuples(got, "window_no") == windows


@pytest.mark.parametrize("seconds", [0, 1, 21600, 21601, 21602])
def test_coverage_ends_with_now(rows, seconds):
    now = START + timedelta(seconds=seconds)
    got = tuples(quality.backfill_coverage(rows([], "ts timestamp_ntz"), "ts", ntz(START), ntz(now)), "window_no")
    windows, at = [], START
    while at < now:
        windows.append((len(windows), at, min(at + timedelta(hours=6), now), 0))
        at = windows[-1][2] + timedelta(seconds=1)
    assert got == windows


def test_failed_windows(spark, tmp_path):
    line = ('{{"recorded_at":"2024-01-01T0{0}:00:00+00:00","window_start":"2024-01-01T00:00:00+00:00","window_end":'
            '"2024-01-01T06:00:00+00:00","attempts":{0},"error_type":"{1}","error":"x","skipped":{2},"skipped_count":0,'
            '"consecutive_failures":1}}\n')  # fmt: skip
    (tmp_path / "l.jsonl").write_text(line.format(1, "A", "false") + line.format(2, "A", "true") + line.format(3, "B", "false"))
    got = quality.failed_window_report(quality.read_failed_windows(spark, str(tmp_path)))
    end = START + timedelta(hours=6)
    assert tuples(got, "error_type") == [
        (START, end, "A", 2, 3, True, datetime(2024, 1, 1, 2)), (START, end, "B", 1, 3, False, datetime(2024, 1, 1, 3)),
    ]


def read_log(spark, path):
    return {r.run_id: r for r in spark.read.parquet(path).collect()}


def test_run_log(spark, rows, tmp_path):
    path = str(tmp_path / "log")
    source = rows([(1,), (2,), (3,)], "a int")
    with quality.RunLog(spark, path, "r1", "p", "scheduled", "NEWSAPI") as log:
        log.writing(log.reading(source).where("a > 1")).write.format("noop").mode("overwrite").save()
    with quality.RunLog(spark, path, "r2", "p", "scheduled", "NEWSAPI") as log:
        log.reading(source).write.format("noop").mode("overwrite").save()
        log.problem("first")
        log.problem("y" * 600)
    quality.WAIT_SECONDS = 1
    with quality.RunLog(spark, path, "r4", "p", "scheduled", "NEWSAPI") as log:
        log.reading(source)  # never evaluated: not waited for
    with pytest.raises(ValueError), quality.RunLog(spark, path, "r3", "p", "scheduled", "NEWSAPI"):
        raise ValueError("broken")
    got = read_log(spark, path)
    assert (got["r1"].status, got["r1"].records_read, got["r1"].records_written) == ("success", 3, 2)
    assert got["r1"].run_finished_at >= got["r1"].run_started_at and got["r1"].error_message is None
    assert got["r2"].status == "partial_success" and len(got["r2"].error_message) == 500
    assert (got["r3"].status, got["r3"].error_message, got["r3"].records_read) == ("failed", "broken", 0)


def test_incremental_refresh_equals_full_refresh(spark, rows, tmp_path):
    """Late mentions, scores, articles and events, one of which moves to another url, change what a full refresh changes."""
    at = lambda days: START + timedelta(days=days)
    companies = rows([(1, "A", "a"), (2, "B", "b")], "company_id bigint, ticker string, company_name string")
    article = "article_id bigint, provider string, source_name string, url string, url_hash string, published_at timestamp_ntz, title string, description string, content string, ingested_at timestamp_ntz"
    articles = [(k, "p", "s", f"u{k}" if k != 4 else None, None, START, "t", None, "c", at(0 if k < 5 else 3)) for k in range(1, 6)]
    mentions = [(k, 1, at(0)) for k in (1, 3, 4)] + [(2, 2, at(2)), (5, 1, at(0))]
    scores = [(1, 1, 1, 0.0, "neutral", "m", at(0)), (2, 1, 1, 0.9, "positive", "m", at(2)), (3, 3, 1, 0.1, "positive", "m", at(0))]
    event = ["event_id", "provider", "url", "url_hash", "published_at_ts", "company_id", "sentiment_score", "source_name", "article_text", "ingest_batch_id", "loaded_at"]
    base = [("e1", "g", "u3", None, START, 1, 0.5, "s", "x", "0", at(1)), ("e1", "g", "v9", None, START, 1, 0.7, "s", "x", "1", at(2)),
            ("e2", "g", None, None, START, 2, 0.2, "s", "x", "0", at(0))]
    types = {"company_id": "bigint", "sentiment_score": "double", "published_at_ts": "timestamp_ntz", "loaded_at": "timestamp_ntz"}
    tables = [
        rows(articles, article),
        rows(mentions, "article_id bigint, company_id bigint, created_at timestamp_ntz"),
        rows(scores, "sentiment_id bigint, article_id bigint, company_id bigint, sentiment_score double, sentiment_label string, model_name string, scored_at timestamp_ntz"),
        rows(base, ", ".join(f"{c} {types.get(c, 'string')}" for c in event)),
    ]
    marks = dict.fromkeys(refresh.MARKED, ntz(at(1).strftime("%Y-%m-%d %H:%M:%S")))
    old = [df.where(F.col(column) <= marks[name]) for df, (name, column) in zip(tables, refresh.MARKED.items(), strict=True)]
    step, full = str(tmp_path / "step"), str(tmp_path / "full")
    refresh.refresh_incremental(*old, marks, companies, step)
    after = refresh.refresh_incremental(*tables, marks, companies, step)
    expected = refresh.refresh(refresh.unify(*tables), companies, full)
    assert set(after) == set(expected) and len(after) == 6
    for name in expected:
        assert sorted(map(str, tuples(after[name]))) == sorted(map(str, tuples(expected[name]))), name
    assert {(r.record_id, r.sentiment_score) for r in after["unified"].collect()} >= {("1", 0.9), ("2", 0.0), ("e1", 0.7)}


def test_late_rows_are_found_before_any_window(spark):
    base = spark.range(10).selectExpr("cast(id as string) event_id", "id company_id", "current_date()::timestamp_ntz loaded_at")
    late = refresh._late(base, "base", {"base": ntz("2024-01-01 00:00:00")})
    assert "Window" not in late._jdf.queryExecution().optimizedPlan().toString()


def test_working_folder_is_shared_within_the_session(spark):
    first, second = working_path(spark, "x"), working_path(spark, "x")
    assert first != second and first.startswith(working_root(spark) + "/x-")


def test_working_folder_comes_from_the_session_setting():
    class Conf:
        def get(self, key, default):
            return {"spark.checkpoint.dir": "hdfs://shared/"}.get(key, default)

    class Session:
        conf = Conf()

    assert working_root(Session()) == "hdfs://shared"
