"""Minute windows with a watermark against plain rules: rows in time make the mart, late ones are listed, also over restarts."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from newslens.operators.marts import bucket_mart
from newslens.sources import event_log
from newslens.streaming import windows
from newslens.streaming.dedup import use_disk_state

DDL = "event_id string, company_id bigint, url_hash string, published_at_ts timestamp_ntz, sentiment_score double"
START = datetime(2024, 1, 1, 10)
LEAST = datetime(1970, 1, 1)


@pytest.fixture
def stream(spark, rows, tmp_path):
    use_disk_state(spark)
    log, root = str(tmp_path / "log"), str(tmp_path / "mart")

    def run(batch):
        made = rows(batch, DDL)
        event_log.append(made.select(F.lit("k").alias("key"), F.to_json(F.struct(*made.columns)).alias("value")), log)
        read = event_log.log_stream(spark, log, "earliest").select(F.from_json(F.col("value").cast("string"), DDL).alias("v")).select("v.*")
        windows.start(read, root, str(tmp_path / "checkpoint"), shards=3).awaitTermination()
        return root

    return run


def split(batches, delay=timedelta(minutes=10)):
    """Rows in time and (event, watermark) of late ones: a run's batch sees the watermark of the runs before it."""
    mark, timely, late = LEAST, [], []
    for batch in batches:
        for row in batch:
            if row[3] is None:
                continue
            ended = row[3].replace(second=0, microsecond=0) + timedelta(minutes=1) <= mark
            late.append((row[0], mark)) if ended else timely.append(row)
        mark = max([mark, *(row[3] - delay for row in batch if row[3] is not None)])
    return timely, late


def check(spark, rows, root, batches):
    timely, late = split(batches)
    keys = ["bucket_minute", "company_id"]
    assert tuples(windows.read_minutes(spark, root), *keys) == tuples(bucket_mart(rows(timely, DDL), "minute", per_alias_hit=True), *keys)
    assert sorted(tuples(windows.read_late(spark, root).select("event_id", "watermark"))) == sorted(late)
    return len(late)


def test_random_rows_over_restarts(spark, rows, stream):
    rng = random.Random(4)

    def one(n, k):
        at = START + timedelta(minutes=25 * n) + timedelta(seconds=rng.randrange(-1800, 1800), milliseconds=rng.randrange(1000))
        company, url = rng.choice([1, 1, 2, None]), rng.choice([None, *(f"u{u}" for u in range(12))])
        return f"{n}-{k}", company, url, rng.choice([at, at, at, at, None]), rng.choice([None, 1 / 3, -0.25])

    batches = [[one(n, k) for k in range(120)] for n in range(4)]
    for batch in batches:
        root = stream(batch)
    assert check(spark, rows, root, batches) > 20


def test_edge_of_the_watermark(spark, rows, stream):
    """At a mark of 10:05:00 the minute of 10:04 has ended, that of 10:05 has not; a minute goes on growing while it is open."""
    first = [("a", 1, "u", START + timedelta(minutes=15), 1.0), ("b", 1, "v", START + timedelta(minutes=5), 0.5)]
    second = [("c", 1, "w", START + timedelta(minutes=4, seconds=59), 1.0), ("d", 1, "x", START + timedelta(minutes=5), 1.0),
              ("e", 1, "v", START + timedelta(minutes=5, seconds=59), None)]
    stream(first)
    root = stream(second)
    assert check(spark, rows, root, [first, second]) == 1
    assert (START + timedelta(minutes=5), 1, 2, 0.75) in tuples(windows.read_minutes(spark, root))


def test_batch_delivered_again(spark, rows, tmp_path):
    write, root = windows.update_writer(str(tmp_path)), str(tmp_path)
    late = rows([], windows.UPDATES_DDL)
    one = "late boolean, minute_ms bigint, company_id bigint, shard bigint, article_count bigint, score_count bigint"
    updates = late.unionByName(rows([(False, 60000, 1, 0, 2, 0)], one), allowMissingColumns=True)
    write(updates, 0)
    write(updates, 0)
    write(updates.withColumn("article_count", F.lit(5).cast("bigint")), 1)
    assert tuples(windows.read_minutes(spark, root)) == [(datetime(1970, 1, 1, 0, 1), 1, 5, None)]


def test_nothing_yet(spark, tmp_path):
    assert windows.read_minutes(spark, str(tmp_path)).count() == 0 and windows.read_late(spark, str(tmp_path)).count() == 0
