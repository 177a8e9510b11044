"""The log and its source: offsets, caps, restarts."""

import collections
import time

import pytest
from pyspark.errors import StreamingQueryException

from newslens.sources import event_log


def messages(rows, numbers):
    return rows([(f"k{n % 7}" if n % 11 else None, f"m{n}") for n in numbers], "key string, value string")


def run(stream, out, checkpoint, each=None, once=True):
    seen = []

    def write(batch, number):
        if each:
            each(number)
        found = [(r.partition, r.offset, r.value.decode()) for r in batch.collect()]
        seen.append(found)
        out[number] = found

    writer = stream.writeStream.option("checkpointLocation", str(checkpoint)).foreachBatch(write)
    query = (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="0 seconds")).start()
    return query, seen


def test_all_messages_once_in_order_over_restarts(spark, rows, tmp_path):
    path, out = str(tmp_path / "log"), {}
    event_log.append(messages(rows, range(50)), path)
    stream = lambda: event_log.log_stream(spark, f"file://{path}", "earliest")
    run(stream(), out, tmp_path / "c")[0].awaitTermination()
    ends = event_log.append(messages(rows, range(50, 80)), path)

    def fails(number):
        raise RuntimeError("the batch dies")

    query, _ = run(stream(), {}, tmp_path / "c", each=fails)
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
    run(stream(), out, tmp_path / "c")[0].awaitTermination()
    found = [row for batch in out.values() for row in batch]
    assert sorted(value for _, _, value in found) == sorted(f"m{n}" for n in range(80))
    places = collections.defaultdict(list)
    for partition, offset, _ in found:
        places[partition].append(offset)
    assert {p: sorted(o) for p, o in places.items()} == {p: list(range(end)) for p, end in ends.items()}
    assert event_log.append(messages(rows, range(0)), path) == ends
    key_of = {f"m{n}": f"k{n % 7}" for n in range(80) if n % 11}
    homes = {(key_of[v], p) for p, _, v in found if v in key_of}
    assert len(homes) == len({k for k, _ in homes})  # a key has one partition


def test_latest_and_given_offsets(spark, rows, tmp_path):
    path = str(tmp_path / "log")
    ends = event_log.append(messages(rows, range(40)), path)
    for start, expected in (("latest", 0), ('{"0": 2}', sum(ends.values()) - min(2, ends[0])), ("earliest", 40)):
        out = {}
        run(event_log.log_stream(spark, path, start), out, tmp_path / f"c{expected}")[0].awaitTermination()
        assert sum(map(len, out.values())) == expected


def test_capped_batches_over_a_restart(spark, rows, tmp_path):
    path, out = str(tmp_path / "log"), {}
    event_log.append(messages(rows, range(60)), path)
    stream = event_log.log_stream(spark, path, "earliest", max_offsets_per_trigger=10, reader="test")
    query, seen = run(stream, out, tmp_path / "c", once=False)
    deadline = time.monotonic() + 60
    while not any(seen) and time.monotonic() < deadline:  # stopped after the first batches, then started anew
        time.sleep(0.05)
    query.stop()
    stream = event_log.log_stream(spark, path, "earliest", max_offsets_per_trigger=10, reader="test")
    query, _ = run(stream, out, tmp_path / "c", once=False)
    query.processAllAvailable()
    query.stop()
    assert sorted(v for b in out.values() for _, _, v in b) == sorted(f"m{n}" for n in range(60))
    assert max(map(len, out.values())) <= 10 and len(out) >= 6


def test_shares_of_the_cap():
    reader = event_log.EventLogReader({"path": "/nowhere", "maxOffsetsPerTrigger": "10", "reader": "r"})
    reader.at, reader._ends = {"0": 5, "1": 0, "2": 7}, lambda: {"0": 100, "1": 2, "2": 7}
    assert reader.latestOffset() == {"0": 13, "1": 2, "2": 7}
    reader.most = 1
    assert sum(reader.latestOffset().values()) == 13


def test_an_empty_log(spark, tmp_path):
    out = {}
    run(event_log.log_stream(spark, str(tmp_path / "none"), "earliest"), out, tmp_path / "c")[0].awaitTermination()
    assert not any(out.values())


def test_a_task_reads_a_bounded_stretch_of_a_file_a_little_at_a_time(tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet

    values = [f"m{n}".encode() for n in range(5000)]
    stamps = pa.array(range(5000), pa.timestamp("us", "UTC"))
    table = pa.table({"key": [v.decode() for v in values], "value": values, "timestamp": stamps})
    pyarrow.parquet.write_table(table, tmp_path / "file", row_group_size=700)
    reader = event_log.EventLogReader({"path": str(tmp_path)})
    reader._log = lambda: [{"ends": {"0": 5100}, "files": [{"partition": 0, "file": "file", "first": 100, "count": 5000, "bytes": 3 * event_log.TASK_BYTES}]}]
    segments = reader.partitions({"0": 150}, {"0": 5100})
    assert len(segments) == 3 and max(s.end - s.begin for s in segments) == 1666
    batches = [list(reader.read(segment)) for segment in segments]
    assert max(batch.num_rows for each in batches for batch in each) <= event_log.HELD_ROWS
    found = [pair for each in batches for batch in each for pair in zip(batch["offset"].to_pylist(), batch["value"].to_pylist(), strict=True)]
    assert found == [(100 + n, values[n]) for n in range(50, 5000)]


def test_messages_are_not_gathered_by_partition(spark):
    from newslens.plans.queries import src_article_stream

    plan = src_article_stream(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
