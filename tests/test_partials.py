"""Marts from stored partial aggregates equal those from base rows, however rows come in."""

import random
from datetime import datetime, timedelta

from conftest import tuples
from pyspark.sql import functions as F

from newslens.operators import partials
from newslens.operators.marts import bucket_mart

DDL = "event_id string, company_id bigint, url_hash string, published_at_ts timestamp_ntz, sentiment_score double"
START = datetime(2024, 1, 1, 22, 50)


def made(seed, n, urls, minutes):
    rng = random.Random(seed)
    for k in range(n):
        url = rng.choice([None, *(f"u{u}" for u in range(urls))])
        at = None if rng.random() < 0.05 else START + timedelta(seconds=rng.randrange(minutes * 60))
        score = rng.choice([None, 0.1, -0.7, 1 / 3, rng.random()])
        for company in {rng.choice([1, 1, 1, 2, None]) for _ in range(2)}:
            yield f"{seed}-{k}", company, url, at, score


def check(stored, spark, base, unit):
    keys = [f"bucket_{unit}", "company_id"]
    assert tuples(stored.mart(spark, unit), *keys) == tuples(bucket_mart(base, unit), *keys)


def test_batches_add_up_at_every_grain(spark, rows, tmp_path):
    stored, every = partials.StoredPartials(str(tmp_path / "p")), []
    for batch in range(3):  # urls return in later batches and other minutes
        more = list(made(batch, 150, 40, 130))
        stored.add(rows(more, DDL), batch)
        every += more
    for unit in ("minute", "hour", "day"):
        check(stored, spark, rows(every, DDL), unit)


def test_batch_added_again_replaces_itself(spark, rows, tmp_path):
    stored, first = partials.StoredPartials(str(tmp_path / "p")), list(made(1, 60, 30, 1500))
    stored.add(rows(first, DDL), 0)
    stored.add(rows(list(made(2, 60, 50, 1500)), DDL), 1)
    second = list(made(3, 20, 50, 60))  # the second attempt has fewer rows and days
    stored.add(rows(second, DDL), 1)
    check(stored, spark, rows(first + second, DDL), "hour")
    stored.add(rows([], DDL), 1)
    check(stored, spark, rows(first, DDL), "day")


def test_numbers_are_gapless_and_go_on(spark, rows):
    base = rows([(str(k), 1, f"u{k % 700}", START + timedelta(minutes=k % 3), 0.0) for k in range(1400)], DDL)
    known = partials.number_articles(base.where("cast(event_id as int) < 300"))
    fresh = partials.number_articles(base, known)
    places = {}
    for url, home, place in tuples(known.union(fresh)):
        places.setdefault(home, []).append(place)
    assert sum(map(len, places.values())) == 700
    assert all(sorted(p) == list(range(1, len(p) + 1)) for p in places.values())


def test_minute_beyond_one_bitmap(spark):
    """One minute with 70,000 articles: three chunks; the bitmap of a quiet minute is one byte."""
    base = spark.range(70_003).select(
        F.col("id").cast("string").alias("event_id"), F.lit(1).cast("bigint").alias("company_id"), F.col("id").cast("string").alias("url_hash"),
        F.when(F.col("id") < 70_000, F.lit(START)).otherwise(F.lit(START + timedelta(minutes=1))).cast("timestamp_ntz").alias("published_at_ts"),
        F.lit(0.5).alias("sentiment_score"),
    )
    fine = partials.partials(base, partials.number_articles(base)).cache()
    assert tuples(fine.select("chunk", F.octet_length("url_bits")), "bucket", "chunk") == [(1, 4096), (2, 4096), (3, 558), (1, 1)]
    assert tuples(partials.finished(partials.coarser(fine, "hour"), "hour")) == [(datetime(2024, 1, 1, 22), 1, 70_003, 0.5)]
    fine.unpersist()


def test_empty(spark, rows, tmp_path):
    stored = partials.StoredPartials(str(tmp_path / "p"))
    stored.add(rows([], DDL), 0)
    assert tuples(stored.mart(spark, "hour")) == []


def test_first_batch_starts_no_worker_for_an_empty_table(spark, rows, tmp_path):
    stored = partials.StoredPartials(str(tmp_path))._stored(spark, "numbers", partials.NUMBERS_DDL)
    assert stored.isEmpty() and stored.schema == spark.createDataFrame([], f"{partials.NUMBERS_DDL}, {partials.BATCH} bigint").schema
    assert "Scan ExistingRDD" not in stored._jdf.queryExecution().executedPlan().toString()
