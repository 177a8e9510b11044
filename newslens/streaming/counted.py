"""Duplicates of a stream within a memory of counted keys, as state of our own.

The publishing side remembers a fixed number of urls and forgets the oldest tenth when it is full. Time-bounded dedup cannot say that: how long a url is remembered
depends on how many others come. Here the memory is keyed state on disk, split into shards by the key so that it scales and no task holds it all:
each shard remembers its share of the keys in the order in which they came. A shard's memory is one value, whose size is bounded, and is read and written once
a micro-batch: a call for each key would cost more than all else.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Keys that are remembered in all, and the part of them that is forgotten at once.
REMEMBERED, FORGOTTEN_PART = 200_000, 10
SHARDS = 64
SHARD = "_shard"


class CountedMemory(StatefulProcessor):
    """One shard: a key passes if it is not remembered; of over ``bound`` keys the oldest tenth (one at least) is forgotten."""

    def __init__(self, key: str, order: str, bound: int, columns: list[str]):
        self._key, self._order, self._bound, self._columns = key, order, bound, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._memory = handle.getValueState("memory", "keys array<string>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self._memory.get()
        memory = dict.fromkeys(known[0] if known else ())  # in the order in which they came
        for row in sorted(rows, key=lambda r: (r[self._order] is None, r[self._order])):
            own = row[self._key]
            if own is not None:
                if own in memory:
                    continue
                memory[own] = None
                if len(memory) > self._bound:
                    for oldest in list(islice(memory, max(1, self._bound // FORGOTTEN_PART))):
                        del memory[oldest]
            yield Row(**{c: row[c] for c in self._columns})
        self._memory.update((list(memory),))

    def close(self) -> None:
        """State is closed by Spark."""


def dedup_counted(
    events: DataFrame, key: str = "url_hash", order: str = "kafka_timestamp", remembered: int = REMEMBERED, shards: int = SHARDS, shard: Column | None = None
) -> DataFrame:
    """Events of a stream whose key is not among the last keys remembered: ``remembered / shards`` in each shard of the keys.

    Within a micro-batch events are taken by ``order``, nulls last; make it total (the offset in a log), or which of two stays is arbitrary. Events with a null key all
    pass. A key that has been forgotten passes again; the latest-row tables downstream catch it. Needs the disk state store (``use_disk_state``).
    """
    columns = events.columns
    own = shard if shard is not None else F.pmod(F.xxhash64(F.col(key)), F.lit(shards))
    if SHARD in columns:
        raise ValueError(f"the events have a column {SHARD}")
    memory = CountedMemory(key, order, max(1, remembered // shards), columns)
    grouped = events.withColumn(SHARD, own.cast("string")).groupBy(SHARD)
    return grouped.transformWithState(memory, events.schema, outputMode="Append", timeMode="None")
