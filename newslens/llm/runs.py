"""Runs (maximal repetitions) of word sequences from Lyndon arrays, by the grouping phase of Baier's suffix sorter.

Phase one of that sorter (Baier 2016) takes groups of suffixes from the highest down and moves the nearest lower suffix before each member into a
group of its own, behind its old one. A group's context is then the longest Lyndon word at its members, so phase one yields the Lyndon array directly
(Franek, Paracha & Smyth 2017); phase two, the suffix array, is never made. Every run has a root that is the longest Lyndon word at its place under the
order of the words or under the opposite one (Bannai et al. 2017), so the roots of both arrays, extended to both sides by longest common
extensions (LCE), give all runs. LCE are exact: stretches of 1, 2, 4, … words have a number each, which is the same for equal ones.

A document is one unit of work, whole; time is in proportion to its words (a logarithm more for LCE). Documents never meet, so nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm import arrays

#: A run is reported from so many words on.
LEAST = 12

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lyndon_array(symbols: Sequence[int]) -> np.ndarray:
    """Length of the longest Lyndon word that begins at each place, by grouping (phase one of Baier's sorter)."""
    n = len(symbols)
    places = defaultdict(list)
    for at, symbol in enumerate(symbols):
        places[symbol].append(at)
    members = [places[symbol] for symbol in sorted(places)]  # of each group; who has moved on since is told by ``group``
    context = [1] * len(members)
    below, above = list(range(-1, len(members) - 1)), [*range(1, len(members)), -1]  # groups in order, as a list linked both ways
    group = [0] * n
    for number, own in enumerate(members):
        for at in own:
            group[at] = number
    found = np.ones(n, np.int64)
    lower = list(range(-1, n))  # lower[at + 1] = at while the group of ``at`` is lower than the present one, else a place before it
    now = len(members) - 1
    while now >= 0:
        own = [at for at in members[now] if group[at] == now]
        length = context[now]
        if length > 1:
            found[own] = length
        for at in own:
            lower[at + 1] = at - 1
        pointed: dict[int, int] = {}
        for at in own:
            step = at - 1
            on = lower[step + 1]
            while on != step:
                lower[step + 1] = step = lower[on + 1]
                on = lower[step + 1]
            if step >= 0:
                pointed[step] = pointed.get(step, 0) + 1
        moved = defaultdict(list)
        for at, times in pointed.items():
            moved[times, group[at]].append(at)
        for key in sorted(moved, reverse=True):  # those pointed at more often are higher; each new group goes right behind its old one
            times, old = key
            new = len(members)
            members.append(moved[key])
            context.append(context[old] + times * length)
            below.append(old)
            above.append(above[old])
            below[above[old]] = new  # there is always a group above: the present one at least
            above[old] = new
            for at in moved[key]:
                group[at] = new
        now = below[now]
    return found


class Extensions:
    """Longest common extensions of places of a sequence, for whole arrays of pairs."""

    def __init__(self, symbols: np.ndarray):
        self.size = len(symbols)
        _, numbers = np.unique(symbols, return_inverse=True)
        self.numbers = [numbers]  # [k][i]: equal for equal stretches of 2^k symbols from i
        half = 1
        while 2 * half <= self.size and int(numbers.max()) + 1 < len(numbers):  # all different: no longer ones are equal
            _, numbers = np.unique(numbers[:-half] * np.int64(self.size) + numbers[half:], return_inverse=True)
            self.numbers.append(numbers)
            half *= 2

    def right(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many symbols from ``one`` on equal those from ``two`` on; one < two."""
        far = np.zeros(len(one), np.int64)
        for k in range(len(self.numbers) - 1, -1, -1):
            inside = np.flatnonzero(two + far + (1 << k) <= self.size)
            same = self.numbers[k][one[inside] + far[inside]] == self.numbers[k][two[inside] + far[inside]]
            far[inside[same]] += 1 << k
        return far

    def left(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many symbols before ``one`` equal those before ``two``; one < two."""
        far = np.zeros(len(one), np.int64)
        for k in range(len(self.numbers) - 1, -1, -1):
            inside = np.flatnonzero(one - far - (1 << k) >= 0)
            same = self.numbers[k][one[inside] - far[inside] - (1 << k)] == self.numbers[k][two[inside] - far[inside] - (1 << k)]
            far[inside[same]] += 1 << k
        return far


def runs(symbols: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs of at least ``least`` and two periods, by start and period."""
    if len(symbols) < 2:
        return np.zeros((0, 3), np.int64)
    listed = symbols.tolist()
    places = np.arange(len(symbols))
    roots = [np.stack([places, lyndon_array(part)]) for part in (listed, [-s for s in listed])]
    start, period = np.unique(np.concatenate(roots, axis=1), axis=1)
    inside = start + period < len(symbols)
    start, period = start[inside], period[inside]
    lce = Extensions(symbols)
    before, behind = lce.left(start, start + period), lce.right(start, start + period)
    length = before + period + behind
    long = length >= np.maximum(least, 2 * period)
    found = np.stack([start - before, length, period], axis=1)[long]
    return np.unique(found[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


def repeating(symbols: np.ndarray, doc: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Stretches [begin, end) outside which no run of ``least`` symbols can lie, each within one document.

    A run of length n >= max(least, 2 q) and period q equals itself q places on, over n - q >= least / 2 symbols; the two copies cover it.
    So all its symbols lie in windows of half of ``least`` symbols that occur twice in the document.
    """
    width = -(-least // 2)
    if len(symbols) < least:
        return []
    n = len(symbols) - width + 1
    hashes = doc[:n].astype(np.uint64)
    for k in range(width):
        hashes = arrays.mixed(hashes * np.uint64(31) + symbols[k : k + n].astype(np.uint64) + np.uint64(k + 1))
    hashes[doc[width - 1 :] != doc[:n]] = np.uint64(0)  # across a border
    order = np.argsort(hashes, kind="stable")
    same = np.flatnonzero((hashes[order[1:]] == hashes[order[:-1]]) & (hashes[order[1:]] != 0))
    twice = np.zeros(n, bool)
    twice[order[same]] = twice[order[same + 1]] = True
    at = np.flatnonzero(twice)
    if not len(at):
        return []
    opens = np.concatenate([[True], (at[1:] > at[:-1] + width) | (doc[at[1:]] != doc[at[:-1]])])
    begins, ends = at[opens], at[np.concatenate([opens[1:], [True]])] + width
    return [(int(b), int(e)) for b, e in zip(begins, ends, strict=True) if e - b >= least]


def text_runs(sequences: list[list[bytes]], least: int = LEAST) -> list[np.ndarray]:
    """``runs`` of each sequence of words."""
    index: dict[bytes, int] = {}
    symbols = np.fromiter((index.setdefault(word, len(index)) for words in sequences for word in words), np.int64)
    sizes = np.array([len(words) for words in sequences], np.int64)
    doc = np.repeat(np.arange(len(sequences)), sizes)
    first = np.cumsum(sizes) - sizes
    found = [[] for _ in sequences]
    for begin, end in repeating(symbols, doc, least):
        own = runs(symbols[begin:end], least)
        if len(own):
            own[:, 0] += begin - first[doc[begin]]
            found[doc[begin]].append(own)
    return [np.concatenate(parts) if parts else np.zeros((0, 3), np.int64) for parts in found]


def collapsed(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """The words that lie in no run behind its first period."""
    if not len(found):
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    start, length, period = found.T
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    return [words[at] for at in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def word_runs(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: int = LEAST,
    rewritten: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """(id, runs array<struct<start,length,period>>, collapsed string) of every row of ``docs``.

    Words are what blanks (space, tab to carriage return) separate. ``runs`` are all runs of at least ``least`` words and two periods, by start
    and period, in word numbers from 0; ``collapsed`` has the words that stand in no run behind its first period, joined by one space.
    ``rewritten(id, words)`` may change the words first. Null and blank texts have no words: no runs and an empty text. Null ids stay null,
    repeated rows are each worked out, other columns are not read, an empty table gives an empty one. Texts are whole, whatever their length.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"))

    def work(batch: pa.RecordBatch):
        texts = batch.column("text").to_pylist()
        ids = batch.column("id").to_pylist()
        for begin, end in arrays.blocks(texts):
            words = [t.split() for t in texts[begin:end]]
            if rewritten:
                words = [rewritten(i, w) for i, w in zip(ids[begin:end], words, strict=True)]
            found = text_runs(words, least)
            kept = [b" ".join(collapsed(w, f)) for w, f in zip(words, found, strict=True)]
            flat = np.concatenate(found)
            offsets = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(c) for c in flat.T], fields=list(_RUN)))
            columns = [batch.column("id").slice(begin, end - begin), lists, pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "runs", "collapsed"])

    kind = rows.schema["id"].dataType.simpleString()
    made = arrays.map_batches(rows, work, f"id {kind}, runs {RUNS}, collapsed string")
    return made.withColumnRenamed("id", id_column)


def digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of the rows of ``word_runs``.

    The four numbers are those of the longest run (ties: smallest start, then period), null without any.
    """
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    rows = found.select(id_column, "runs", best.alias("best"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select(
        id_column,
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )
