"""Numpy and Arrow helpers that the operators share."""

from __future__ import annotations

import contextlib
import ctypes
import weakref
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of text that are turned into arrays at once. Texts are never cut: a longer one is a block of its own.
BLOCK_CHARS = 400_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def blocks(texts: list[str], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about ``limit`` characters in all; one long text can be more."""
    begin, size = 0, 0
    for at, text in enumerate(texts):
        if at > begin and size + len(text) > limit:
            yield begin, at
            begin, size = at, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def column_texts(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column as Python texts; null is the empty text."""
    return [text or "" for text in batch.column(name).to_pylist()]


def ragged(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``pool[s : s + n]`` of all (s, n), one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * _MIX
    return values ^ (values >> np.uint64(31))


class Powers:
    """Powers of an odd number and of its inverse, modulo 2^64, grown when longer texts come."""

    def __init__(self):
        self._up = self._down = np.ones(1, np.uint64)

    @staticmethod
    def _grown(factor: np.uint64, size: int) -> np.ndarray:
        powers = np.full(size, factor, np.uint64)
        powers[0] = 1
        return np.multiply.accumulate(powers)

    def upto(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if size > len(self._up):
            self._up, self._down = self._grown(_ODD, size), self._grown(_INVERSE, size)
        return self._up, self._down


_POWERS = Powers()


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    """Prefix sums whose differences, scaled by ``span_hashes``, are hashes of spans of the symbols."""
    up, _ = _POWERS.upto(len(symbols) + 1)
    sums = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(mixed((symbols.astype(np.uint64) + np.uint64(1)) * _ODD) * up[: len(symbols)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end): equal for equal spans at any place, never 0."""
    _, down = _POWERS.upto(len(sums))
    hashes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _MIX)
    hashes[hashes == 0] = 1
    return hashes


class HashIndex:
    """Open-addressing table from 64-bit hashes (not 0) to running numbers, looked up and filled for whole arrays."""

    def __init__(self, bits: int = 16):
        self._keys, self._values, self.size = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32), 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Their numbers, -1 for unknown ones."""
        mask = np.uint64(len(self._keys) - 1)
        found = np.full(len(hashes), -1, np.int32)
        slots = (hashes & mask).astype(np.int64)
        keys = self._keys[slots]
        hit = keys == hashes
        found[hit] = self._values[slots[hit]]
        rest = np.flatnonzero(~hit & (keys != 0))
        while len(rest):
            slots = (slots if len(slots) == len(rest) else slots[rest]) + 1
            slots &= int(mask)
            keys = self._keys[slots]
            hit = keys == hashes[rest]
            found[rest[hit]] = self._values[slots[hit]]
            on = ~hit & (keys != 0)
            rest, slots = rest[on], slots[on]
        return found

    def add(self, hashes: np.ndarray) -> np.ndarray:
        """Number hashes that are new and different from each other."""
        numbers = np.arange(self.size, self.size + len(hashes), dtype=np.int32)
        if 2 * (self.size + len(hashes)) > len(self._keys):
            keep = self._keys != 0
            old, values = self._keys[keep], self._values[keep]
            bits = int(2 * (self.size + len(hashes))).bit_length()
            self._keys, self._values = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
            self._put(old, values)
        self._put(hashes, numbers)
        self.size += len(hashes)
        return numbers

    def _put(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        mask = len(self._keys) - 1
        slots = (hashes & np.uint64(mask)).astype(np.int64)
        while len(hashes):
            free = self._keys[slots] == 0
            self._keys[slots[free]] = hashes[free]
            won = self._keys[slots] == hashes
            self._values[slots[won]] = numbers[won]
            hashes, numbers, slots = hashes[~won], numbers[~won], (slots[~won] + 1) & mask


_caches: weakref.WeakSet[WordCache] = weakref.WeakSet()


def release_words() -> None:
    """Empty the caches of words that earlier stages have left in this process, and give the memory back."""
    if any(cache.filled() for cache in _caches):
        for cache in _caches:
            cache.clear()
        with contextlib.suppress(OSError, AttributeError):  # not every platform has it
            ctypes.CDLL(None).malloc_trim(0)


class WordCache:
    """Lists of numbers for words, worked out once per process and word.

    ``work(words)`` gives (all numbers one after the other, how many each word has) for new words. A word is known by
    a 64-bit hash over its code points and length. The cache is emptied before it holds over ``limit`` numbers.
    """

    def __init__(self, work: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 1_500_000):
        self._work, self._limit = work, limit
        self.clear()
        _caches.add(self)

    def clear(self) -> None:
        self._index, self._used = HashIndex(), 0
        self._pool, self._starts, self._lengths = np.zeros(1 << 16, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def filled(self) -> bool:
        return self._used > 0

    def look(self, hashes: np.ndarray, text_of: Callable[[int], str]) -> tuple[np.ndarray, np.ndarray]:
        """(start in the pool, length) for each word; ``text_of(i)`` is the text of word i."""
        if self._used > self._limit:
            self.clear()
        found = self._index.find(hashes)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            fresh, first, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            values, lengths = self._work([text_of(at) for at in missing[first].tolist()])
            while self._used + len(values) > len(self._pool):
                self._pool = np.concatenate([self._pool, np.zeros_like(self._pool)])
            self._pool[self._used : self._used + len(values)] = values
            starts = self._used + np.cumsum(lengths) - lengths
            self._starts = np.concatenate([self._starts, starts])
            self._lengths = np.concatenate([self._lengths, lengths.astype(np.int32)])
            self._used += len(values)
            found[missing] = self._index.add(fresh)[back]
        return self._starts[found], self._lengths[found]

    def numbers(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return ragged(self._pool, starts, lengths)


#: Stands between texts that are laid one after the other; no UTF-8 text holds it.
BREAK = 0xD800


def code_points(texts: list[str]) -> tuple[str, np.ndarray]:
    """The texts, each followed by BREAK, as one text and as an array of code points."""
    joined = "".join(text + "\ud800" for text in texts)
    return joined, np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)


def utf8(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts one after the other, and the offset of each text (and of the end)."""
    encoded = [text.encode() for text in texts]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(e) for e in encoded], out=offsets[1:])
    return np.frombuffer(b"".join(encoded), np.uint8), offsets


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch]], schema: str,
    words: bool = False,
) -> DataFrame:
    """``df`` batch by batch through ``work``, in the order of its rows. ``words``: the work needs the caches of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not words:
            release_words()
        for batch in batches:
            if batch.num_rows:
                made = work(batch)
                yield from [made] if isinstance(made, pa.RecordBatch) else made

    return df.mapInArrow(run, schema)


def document_key(doc_id: str = "doc_id", text: str = "text"):
    """What tells documents apart: the id and a hash of the text, both as numbers that are never null.

    The key can be worked out again from the row alone, so a table can be read twice and joined with itself; rows
    with the same id and the same text are one document.
    """
    return F.xxhash64(F.lit(1), F.col(doc_id), F.sha2(F.coalesce(text, F.lit("")), 256))


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a table to the shared folder and read it: cuts the lineage, and its tasks are not run again."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
