"""Listed words of whole batches of texts, as array operations.

A word is a run of letters and marks of any script with apostrophes within it, as ``sentiment.WORD`` says; what is a letter or a mark is asked of Spark's
own patterns, so both ways find the same words. Texts are lower-cased before. Only words whose length and first bytes
are those of a listed one are compared in full.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from newslens.functions.patterns import spread

CODE_POINTS, SURROGATES = 0x110000, (0xD800, 0xDFFF)
SLOT_BITS = 20
#: Bytes of texts that are looked at in one step, whole texts always.
STEP = 1 << 20


@lru_cache(maxsize=4)
def letters(application: str, pattern: str) -> np.ndarray:
    """Whether each code point matches a pattern of one character, packed into bits; one small job an application."""
    point = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    bit = F.call_function("shiftleft", F.lit(1), F.col("id").bitwiseAND(F.lit(7)).cast("int"))
    points = SparkSession.active().range(CODE_POINTS).where(~F.col("id").between(*SURROGATES)).where(point.rlike(pattern))
    packed = np.zeros(CODE_POINTS // 8, np.uint8)
    for row in points.groupBy(F.shiftright("id", 3).alias("byte")).agg(F.bit_or(bit).alias("bits")).collect():
        packed[row["byte"]] = row["bits"]
    return packed


def _code_points(data: np.ndarray, lead: np.ndarray, size: int) -> np.ndarray:
    """Code points of the characters of ``size`` bytes that begin at ``lead``."""
    points = (data[lead] & (0x7F >> size)).astype(np.int64)
    for k in range(1, size):
        points = points << 6 | data[lead + k] & 0x3F
    return points


class ListedWords:
    """Different words, lower-cased, each with a whole number."""

    def __init__(self, units: dict[str, int], packed_letters: np.ndarray):
        self._packed = packed_letters
        self._words = pa.array([word.encode() for word in units], pa.large_binary())
        self._units = np.array([*units.values(), 0], np.int64)  # the last one is that of no word
        self._slots = np.zeros(1 << SLOT_BITS, bool)
        joined = np.frombuffer(b"".join(word.encode() for word in units), np.uint8)
        lengths = np.array([len(word.encode()) for word in units], np.int64)
        self._slots[self._slot(joined, np.cumsum(lengths) - lengths, lengths)] = True
        self._letters: np.ndarray | None = None

    @staticmethod
    def _slot(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        eight = np.ndarray(len(data), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
        bits = np.uint64(8) * np.clip(lengths, 1, 8).astype(np.uint64)
        heads = (eight[starts] & (np.uint64(2**64 - 1) >> (np.uint64(64) - bits))) + lengths.astype(np.uint64)
        return ((heads * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def _in_words(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Whether each byte is part of a word; ``begins`` tells which bytes begin a text."""
        if self._letters is None:
            self._letters = np.unpackbits(self._packed, bitorder="little").astype(bool)
        inside = self._letters[:256][data]
        wide = np.flatnonzero(data >= 0x80)
        if len(wide):
            inside[wide] = False
            heads = data[wide]
            for size, first, last in ((2, 0xC0, 0xDF), (3, 0xE0, 0xEF), (4, 0xF0, 0xF7)):
                lead = wide[(heads >= first) & (heads <= last)]
                lead = lead[self._letters[_code_points(data, lead, size)]]
                for k in range(size):
                    inside[lead + k] = True
        quotes = np.flatnonzero(data == 0x27)
        quotes = quotes[(quotes > 0) & (quotes < len(data) - 1)]
        joins = inside[quotes - 1] & inside[quotes + 1] & ~begins[quotes] & ~begins[quotes + 1]
        inside[quotes[joins]] = True
        return inside

    def totals(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The sum of the numbers of all listed words in each text ``data[offsets[k] : offsets[k + 1]]``."""
        made, first = [], 0
        while first < len(offsets) - 1:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + STEP, side="right")) - 1)
            own = offsets[first : last + 1]
            made.append(self._step(data[own[0] : own[-1]], own - own[0]))
            first = last
        return np.concatenate(made) if made else np.zeros(0, np.int64)

    def _step(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not len(data) or not len(self._words):
            return np.zeros(len(offsets) - 1, np.int64)
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets] = True
        inside = self._in_words(data, begins)
        starts = np.flatnonzero(inside & (begins[:-1] | ~np.concatenate([[False], inside[:-1]])))
        ends = np.flatnonzero(inside & (begins[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
        near = self._slots[self._slot(data, starts, ends - starts)]
        starts, lengths = starts[near], (ends - starts)[near]
        places = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        found = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data[spread(starts, lengths)]))]
        )
        which = pc.index_in(found, value_set=self._words).fill_null(len(self._words)).to_numpy()
        sums = np.concatenate([[0], np.cumsum(self._units[which])])
        bounds = np.searchsorted(starts, offsets)
        return sums[bounds[1:]] - sums[bounds[:-1]]
