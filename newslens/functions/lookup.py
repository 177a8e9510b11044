"""Small dimensions as literals inside an expression.

Matching and scoring look words up once per token of every text. A join would explode the texts and shuffle them back
together; a literal keeps the text where it is, in one stage. It travels with the task, so its size is checked before
it is made, and the callers have a join for what is larger.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

MAX_LITERAL_ROWS = 200_000
MAX_LITERAL_BYTES = 16 * 1024 * 1024
#: Size of a filter over the keys of a table, whatever the table holds. A fuller filter lets more pass, never fewer.
FILTER_BITS = 1 << 22


def bounded_rows(df: DataFrame) -> list[Row] | None:
    """The rows of a small table of texts and numbers, or None if it is too large to travel as a literal.

    One job that fetches at most one row more than the limit.
    """
    rows = df.limit(MAX_LITERAL_ROWS + 1).collect()
    size = sum(len(value.encode()) for row in rows for value in row if isinstance(value, str))
    return rows if len(rows) <= MAX_LITERAL_ROWS and size <= MAX_LITERAL_BYTES else None


def literal(value: object, ddl: str) -> Column:
    """A nested value as one foldable expression (a literal after optimisation)."""
    return F.from_json(F.lit(json.dumps(value)), ddl)


def bound(value: Column, body) -> Column:
    """``let`` for expressions: evaluate ``value`` once and hand it to ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def key_hash(key: Column | str) -> Column:
    return F.xxhash64(key)


def key_filter(keys: DataFrame, name: str) -> Callable[[Column], Column]:
    """Whether a key may be in the column ``name`` of a table of any size: bits at the keys' hashes, of which there are FILTER_BITS at most."""

    def slot(key: Column) -> Column:
        return F.pmod(key_hash(key), F.lit(FILTER_BITS))

    def bit(at: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))

    slots = keys.select(slot(F.col(name)).alias("slot")).distinct()
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit(F.col("slot"))).alias("bits")).collect()
    bits = [0] * (FILTER_BITS // 64)
    for row in words:
        bits[row["word"]] = row["bits"]
    shared = literal(bits, "array<bigint>")

    def passes(key: Column) -> Column:
        return bound(slot(key), lambda at: F.get(shared, F.shiftright(at, 6).cast("int")).bitwiseAND(bit(at)) != 0)

    return passes


class HashedMap:
    """String-keyed lookup in constant time.

    ``element_at`` on a map compares the keys one after the other, which for a word list of thousands of entries costs
    more than everything else together. The entries are therefore spread over an array of small maps addressed by
    the hash of the key; Spark computes the same hash when the table is built and when a word is looked up.
    """

    def __init__(self, buckets: list, value_ddl: str):
        self._size = len(buckets)
        self._array = literal(buckets, f"array<map<string,{value_ddl}>>")

    @classmethod
    def build(cls, entries: Iterable[tuple[str, int, object]], value_ddl: str) -> "HashedMap":
        """From (key, ``key_hash`` of the key, value) with unique keys."""
        entries = list(entries)
        buckets: list[dict] = [{} for _ in range(max(1, 2 * len(entries)))]
        for key, hashed, value in entries:
            buckets[hashed % len(buckets)][key] = value
        return cls(buckets, value_ddl)

    def get(self, key: Column) -> Column:
        slot = F.pmod(key_hash(key), F.lit(self._size)).cast("int")
        return F.try_element_at(F.get(self._array, slot), key)
