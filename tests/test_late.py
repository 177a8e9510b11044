"""Late materialisation gives the rows that a window over whole rows gives."""

import random

import pytest
from conftest import tuples

from newslens.operators import dedup, late

BASE = "event_id string, company_id bigint, loaded_at timestamp_ntz, ingest_batch_id string, article_text string, key_0 int, file string, at int, row int"


def base_rows(rows, count=3000):
    from datetime import datetime, timedelta

    rng = random.Random(1)
    data = []
    for k in range(count):  # a third of all rows are one key; some keys are null, some rows are repeated
        event = "hot" if k % 3 == 0 else rng.choice([None, f"e{rng.randrange(400)}"])
        when = rng.choice([None, datetime(2026, 1, 1) + timedelta(minutes=rng.randrange(50))])
        data.append((event, rng.choice([1, 2, None]), when, f"b{rng.randrange(10**6)}", f"text {k} " * 20, k, "f", k, k))
    return rows(data, BASE)


@pytest.mark.parametrize("most", [late.BROADCAST_BYTES, 0], ids=["broadcast", "joined"])
def test_stored_equals_window(rows, tmp_path, spark, monkeypatch, most):
    monkeypatch.setattr(late, "BROADCAST_BYTES", most)
    monkeypatch.setattr(late, "PIECE", 192)
    base_rows(rows).repartition(5).write.parquet(str(tmp_path / "base"))
    stored = spark.read.parquet(str(tmp_path / "base"))
    got = late.latest_event_company(stored)
    assert got.columns == stored.columns
    assert sorted(tuples(got), key=str) == sorted(tuples(dedup.latest_event_company(stored)), key=str)


def test_one_of_repeated_rows_stays(rows, tmp_path, spark):
    one = base_rows(rows, 1)
    one.union(one).union(one).coalesce(1).write.parquet(str(tmp_path / "base"))
    assert late.latest_event_company(spark.read.parquet(str(tmp_path / "base"))).count() == 1
    empty = late.stored(one.limit(0))
    assert late.latest_event_company(empty).count() == 0


def test_texts_are_in_no_window_and_no_exchange(rows, tmp_path, spark, monkeypatch):
    seen = []
    monkeypatch.setattr(late, "bit_maps", lambda places, own=late.bit_maps: seen.append(places) or own(places))
    base_rows(rows, 50).write.parquet(str(tmp_path / "base"))
    fetched = late.latest_event_company(spark.read.parquet(str(tmp_path / "base")))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan(seen[0]) and "article_text" not in plan(seen[0])
    assert "article_text" in plan(fetched) and "BroadcastHashJoin" in plan(fetched)
    assert not any(word in plan(fetched) for word in ("Window", "SortMergeJoin", "Exchange hashpartitioning"))
