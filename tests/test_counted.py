"""A memory of counted keys against plain Python, over restarts."""

import random

from newslens.sources import event_log
from newslens.streaming.counted import dedup_counted
from newslens.streaming.dedup import use_disk_state


def plain(numbered, bound):
    """(key, number) of what passes one shard."""
    memory, passed = [], []
    for key, number in numbered:
        if key in memory:
            continue
        passed.append((key, number))
        if key is not None:
            memory.append(key)
            if len(memory) > bound:
                del memory[: max(1, bound // 10)]
    return passed


def test_against_plain_python(spark, rows, tmp_path):
    from pyspark.sql import functions as F

    use_disk_state(spark)
    rng = random.Random(8)
    batches = [[rng.choice([None, *(f"{s}{k}" for s in "ab" for k in range(60))]) for _ in range(150)] for _ in range(3)]
    path, number, every = str(tmp_path / "log"), 0, []
    for batch in batches:  # a run for each: the memory outlives them
        numbered = [(key, number + k) for k, key in enumerate(batch)]
        every, number = every + numbered, number + len(batch)
        event_log.append(rows([(key, str(n)) for key, n in numbered], "key string, value string"), path)
        stream = event_log.log_stream(spark, path, "earliest").select("key", F.col("value").cast("string").cast("long").alias("number"))
        kept = dedup_counted(stream, "key", "number", remembered=40, shards=2, shard=F.coalesce(F.left("key", F.lit(1)), F.lit("n")))
        kept.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    got = {(r.key, r.number) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    expected = set()
    for shard in ("a", "b", None):
        expected |= set(plain([e for e in every if (e[0] or [None])[0] == shard], 20))
    assert got == expected
    assert len({k for k, _ in got}) < len([k for k, _ in got if k])  # some keys came back
