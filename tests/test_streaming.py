"""The realtime path as a stream: equals the batch result, survives restarts and repeated batches."""

import json
from datetime import datetime
from pathlib import Path

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from newslens.operators.marts import minute_mart
from newslens.operators.matching import match_substring
from newslens.sources.envelope import landed_stream, normalize_events, parse_envelope
from newslens.streaming import pipeline, sink
from newslens.streaming.dedup import dedup_stream_url_bounded

ALIASES = [(1, "apple"), (1, "cupertino"), (2, "tesla")]


def score(text):
    return F.round(F.length(text) / 100.0, 4)


@pytest.fixture
def aliases(rows):
    return lambda spark: rows(ALIASES, "company_id bigint, alias_norm string")


def event(n, url, title, published="2026-04-01T10:00:{:02d}+00:00"):
    return {"event_id": f"e{n}", "provider": "gdelt", "provider_article_id": str(n), "title": title, "description": "",
            "content": "", "url": url, "source_name": "s", "published_at": published.format(n % 60),
            "event_ingested_at": "2026-04-01T11:00:00+00:00"}


def land(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(e) + "\n" for e in events))


FIRST = [event(1, "http://a", "apple of cupertino"), event(2, "http://b", "tesla"), event(3, "http://c", "nothing")]
SECOND = [event(4, "HTTP://A ", "apple again"), event(5, "http://d", "tesla and apple"), event(6, None, "apple")]


def run(spark, folder, tables, aliases, checkpoint):
    query = pipeline.start(landed_stream(spark, str(folder), 1), tables, aliases, score, str(checkpoint), trigger=None)
    query.awaitTermination()
    assert query.exception() is None


@pytest.fixture
def place(tmp_path):
    return tmp_path / "in", sink.RealtimeTables(str(tmp_path / "out")), tmp_path / "checkpoint"


def test_stream_equals_batch_across_a_restart(spark, place, aliases, rows):
    folder, tables, checkpoint = place
    land(folder, "1.json", FIRST)
    run(spark, folder, tables, aliases, checkpoint)
    land(folder, "2.json", SECOND)
    run(spark, folder, tables, aliases, checkpoint)
    landed = rows([(json.dumps(e), datetime(2026, 5, 1)) for e in FIRST + SECOND], "value string, timestamp timestamp")
    events = normalize_events(parse_envelope(landed)).where(F.col("event_id") != "e4")  # the url came before
    expected = match_substring(events, aliases(spark), per_alias_hit=False, scorer=score)
    columns = ["event_id", "url_hash", "published_at_ts", "company_id", "sentiment_score", "source_name"]
    assert tuples(sink.read_match(spark, tables).select(*columns), "event_id", "company_id") == tuples(
        expected.select(*columns), "event_id", "company_id"
    )
    assert tuples(sink.read_base(spark, tables).select("event_id", "company_id"), "event_id", "company_id") == [
        ("e1", 1), ("e2", 2), ("e5", 1), ("e5", 2),
    ]
    minutes = sink.read_minutes(spark, tables)
    assert tuples(minutes, "company_id") == tuples(minute_mart(expected), "company_id")
    assert minutes.count() == 2  # one row per (minute, company) although two batches touched the minute


def normalised(rows, events):
    return normalize_events(
        parse_envelope(rows([(json.dumps(e), datetime(2026, 5, 1)) for e in events], "value string, timestamp timestamp"))
    )


def test_a_repeated_batch_changes_nothing(spark, place, aliases, rows):
    _, tables, _ = place
    write = sink.micro_batch_writer(tables, aliases, score)
    for batch_id, events in ((0, FIRST), (1, SECOND), (1, SECOND)):
        write(normalised(rows, events), batch_id)
    assert sink.read_base(spark, tables).groupBy("event_id", "company_id").count().where("count > 1").isEmpty()
    assert sink.read_base(spark, tables).count() == 5
    assert sink.read_match(spark, tables).count() == 5


def test_a_batch_repeated_with_nothing_loses_its_rows(spark, place, aliases, rows):
    _, tables, _ = place
    write = sink.micro_batch_writer(tables, aliases, score)
    other_day = [event(9, "http://z", "tesla", "2026-04-02T10:00:{:02d}+00:00")]
    write(normalised(rows, FIRST), 0)
    write(normalised(rows, other_day), 1)
    assert sink.read_minutes(spark, tables).count() == 3
    write(normalised(rows, []), 1)
    assert tuples(sink.read_base(spark, tables).select("event_id"), "event_id") == [("e1",), ("e2",)]
    assert sink.read_match(spark, tables).count() == 2
    assert sink.read_minutes(spark, tables).count() == 2


def test_an_empty_batch_writes_nothing(place, aliases, rows, tmp_path):
    _, tables, _ = place
    sink.micro_batch_writer(tables, aliases, score)(normalised(rows, [event(3, "http://c", "nothing")]), 0)
    assert not (tmp_path / "out").exists()


def test_new_aliases_count_from_the_next_batch(spark, place, rows):
    _, tables, _ = place
    known = [(1, "apple")]
    write = sink.micro_batch_writer(tables, lambda s: rows(known, "company_id bigint, alias_norm string"), score)
    write(normalised(rows, FIRST), 0)
    known.append((2, "tesla"))
    write(normalised(rows, SECOND), 1)
    assert tuples(sink.read_base(spark, tables).select("event_id", "company_id"), "event_id", "company_id") == [
        ("e1", 1), ("e4", 1), ("e5", 1), ("e5", 2),
    ]


def test_bounded_dedup_lets_a_url_return_after_the_span(spark, tmp_path):
    folder = tmp_path / "in"
    land(folder, "1.json", [{"url_hash": "a", "at": "2026-01-01T00:00:00Z"}, {"url_hash": "a", "at": "2026-01-01T00:10:00Z"}])
    land(folder, "2.json", [{"url_hash": "b", "at": "2026-01-05T00:00:00Z"}])
    land(folder, "3.json", [{"url_hash": "c", "at": "2026-01-05T00:05:00Z"}])
    land(folder, "4.json", [{"url_hash": "a", "at": "2026-01-05T00:10:00Z"}])
    stream = spark.readStream.schema("url_hash string, at timestamp").option("maxFilesPerTrigger", 1).json(str(folder))
    out = str(tmp_path / "out")
    deduplicated = dedup_stream_url_bounded(stream, "at", "1 hour").writeStream.format("parquet")
    deduplicated.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(out).awaitTermination()
    got = spark.read.parquet(out).groupBy("url_hash").count()
    assert tuples(got, "url_hash") == [("a", 2), ("b", 1), ("c", 1)]


def test_a_batch_writes_few_files_to_a_day(spark, place, aliases):
    """Adaptive execution is off in a stateful stream, and a rebalance without it is none: each task wrote to each day."""
    folder, tables, checkpoint = place
    land(folder, "1.json", [event(n, f"http://{n}", "tesla", f"2026-04-0{1 + n % 3}T10:00:{{:02d}}+00:00") for n in range(60)])
    run(spark, folder, tables, aliases, checkpoint)
    for table in (tables.base, tables.match, tables.minute):
        folders = [file.parent for file in Path(table).rglob("*.parquet")]
        assert len(folders) == len(set(folders)) == 3, table
    assert sink.read_match(spark, tables).count() == 60
