"""The log of a stream's micro-batches: counts, late rows, failures."""

import json
import os

from pyspark.sql import functions as F

from newslens.streaming.progress import StreamLog, read_log


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
    at = int(name.partition(".")[0])  # files are taken in the order of their times
    os.utime(folder / name, (1_700_000_000 + at, 1_700_000_000 + at))


def test_batches_late_rows_and_failures(spark, tmp_path):
    land(tmp_path / "in", "1.json", [{"k": "a", "at": "2026-01-01T10:00:00Z"}, {"k": "b", "at": "2026-01-01T12:00:00Z"}])
    land(tmp_path / "in", "2.json", [{"k": "c", "at": "2026-01-01T12:30:00Z"}])
    land(tmp_path / "in", "3.json", [{"k": "d", "at": "2026-01-01T09:00:00Z"}, {"k": "e", "at": "2026-01-01T12:40:00Z"}])
    stream = spark.readStream.schema("k string, at timestamp").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    counted = stream.observe("read", F.count(F.lit(1)).alias("rows")).withWatermark("at", "10 minutes").dropDuplicatesWithinWatermark(["k"])
    log = str(tmp_path / "log")

    def start(name, write, checkpoint):
        writer = counted.writeStream.queryName(name).option("checkpointLocation", str(tmp_path / checkpoint)).foreachBatch(write)
        return writer.trigger(availableNow=True).start()

    with StreamLog(spark, log, "good", written="read"):
        start("other", lambda df, _: df.count(), "c0").awaitTermination()
        start("good", lambda df, _: df.count(), "c1").awaitTermination()
    rows = {r.batch_id: r for r in read_log(spark, log).collect()}
    assert [rows[k].rows_read for k in (0, 1, 2)] == [2, 1, 2] and {r.query for r in rows.values()} == {"good"}
    assert [rows[k].rows_written for k in (0, 1, 2)] == [2, 1, 2] and [rows[k].rows_late for k in (0, 1, 2)] == [0, 0, 1]
    assert all(r.status == "success" and r.batch_started_at and r.duration_ms >= 0 for r in rows.values())

    def dies(df, number):
        raise RuntimeError("no space")

    with StreamLog(spark, log, "bad"):
        query = start("bad", dies, "c2")
        while query.isActive:
            try:
                query.awaitTermination(1)
            except Exception:
                break
    (failed,) = read_log(spark, log).where("query = 'bad'").collect()
    assert failed.status == "failed" and failed.error_message
