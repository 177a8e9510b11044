"""Packing documents into sequences: linear grouping of lengths, few-size configurations, then best fit.

Only the histogram of lengths (at most ``capacity`` numbers, whatever the corpus) goes to the driver. There large lengths are
cut into groups with equally many documents, each rounded up to its longest; the linear programme of configurations of these few
sizes is solved by column generation; every slot then gets real lengths of its group, and all that is left (small lengths and what
rounding left over) goes where it fits best. The plan is a short list of runs of alike sequences; documents find
their places by their number within their length, which is counted where they lie.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newslens.llm import arrays
from newslens.llm.tokens import id_type, library_encode

GROUPS, LARGE_SHARE, MAX_COLUMNS = 192, 1 / 4, 600
#: A configuration is used while its documents leave at most this part of the sequence empty.
LEAST_FILL = 128


def grouped(counts: np.ndarray, groups: int) -> list[tuple[int, list[list[int]]]]:
    """Lengths, longest first, in groups of equal cardinality: (size of the group, [[length, how many], ...])."""
    total = int(counts.sum())
    share = max(1, -(-total // groups))
    made, room = [], 0
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            if not room:
                room = share
                if not made or made[-1][0] != length:  # groups of one size are one
                    made.append((length, []))
            take = min(left, room)
            made[-1][1].append([length, take])
            left, room = left - take, room - take
    return made


def best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable set of sizes within the capacity (each as often as it fits)."""
    best = np.zeros(capacity + 1)
    steps = []
    for size, value in zip(sizes.tolist(), values.tolist(), strict=True):
        for _ in range(capacity // size if value > 1e-12 else 0):
            put = best[:-size] + value
            better = put > best[size:] + 1e-12
            if not better.any():
                break
            best[size:][better] = put[better]
            steps.append((len(steps), size, better, value))
    at, pattern = capacity, np.zeros(len(sizes))
    where = {}
    for k, (size, value) in enumerate(zip(sizes.tolist(), values.tolist(), strict=True)):
        where.setdefault((size, value), k)
    for _, size, better, value in reversed(steps):
        if at >= size and better[at - size]:
            pattern[where[size, value]] += 1
            at -= size
    return float(best[capacity]), pattern


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, most: int = MAX_COLUMNS) -> list[tuple[np.ndarray, float]]:
    """A nearly optimal fractional use of configurations that covers the demand: revised simplex with generated columns."""
    k = len(sizes)
    columns = [np.eye(k)[i] * (capacity // sizes[i]) for i in range(k)]
    inverse = np.diag([1.0 / c[i] for i, c in enumerate(columns)])
    amount = inverse @ demand
    for _ in range(most):
        duals = inverse.sum(axis=0)
        value, pattern = best_pattern(sizes, np.maximum(duals, 0), capacity)
        if value <= 1 + 1e-7:
            break
        direction = inverse @ pattern
        ratios = np.full(k, np.inf)
        up = direction > 1e-9
        ratios[up] = np.maximum(amount[up], 0) / direction[up]
        leaves = int(ratios.argmin())
        step = ratios[leaves]
        amount = amount - step * direction
        amount[leaves] = step
        row = inverse[leaves] / direction[leaves]
        inverse = inverse - np.outer(direction, row)
        inverse[leaves] = row
        columns[leaves] = pattern
    return [(c.astype(int), float(x)) for c, x in zip(columns, amount, strict=True) if x > 1e-9]


@dataclass
class Plan:
    """Runs of alike sequences. ``places``: (length, first number, how many, first sequence, documents in each, offset)."""

    capacity: int
    sequences: int = 0
    places: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    taken: dict[int, int] = field(default_factory=lambda: defaultdict(int))

    def put(self, length: int, how_many: int, sequence: int, each: int, offset: int) -> None:
        self.places.append((length, self.taken[length], how_many, sequence, each, offset))
        self.taken[length] += how_many

    def open(self, how_many: int) -> int:
        self.sequences += how_many
        return self.sequences - how_many


def plan_lengths(counts: np.ndarray, groups: int = GROUPS, large_share: float = LARGE_SHARE) -> Plan:
    """Places for ``counts[length]`` documents of each length from 1 to the capacity (the last index)."""
    counts = counts.astype(np.int64).copy()
    capacity = len(counts) - 1
    plan = Plan(capacity)
    if counts[capacity]:
        plan.put(capacity, int(counts[capacity]), plan.open(int(counts[capacity])), 1, 0)
        counts[capacity] = 0
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs (first sequence, how many)
    large = np.where(np.arange(capacity + 1) > capacity * large_share, counts, 0)
    made = grouped(large, groups)
    if made:
        sizes = np.array([size for size, _ in made])
        demand = np.array([sum(n for _, n in members) for _, members in made], float)
        used = [(np.repeat(sizes, pattern).tolist(), int(amount + 1e-6)) for pattern, amount in configurations(sizes, demand, capacity)]
        for slots, copies in sorted(used, reverse=True):
            _substitute(plan, gaps, large, slots, copies)
        counts = np.where(np.arange(capacity + 1) > capacity * large_share, large, counts)
    for length in np.flatnonzero(counts)[::-1].tolist():
        _best_fit(plan, gaps, length, int(counts[length]))
    return plan


def _substitute(plan: Plan, gaps: dict, counts: np.ndarray, sizes: list[int], copies: int) -> None:
    """Give ``copies`` sequences of the configuration real documents, as long as there are any.

    A slot takes the longest length that its size and the room that earlier slots have left over allow.
    """
    while copies > 0:
        chosen, spare = [], plan.capacity - sum(sizes)
        for size in sizes:
            length = size + spare
            while length and counts[length] <= chosen.count(length):
                length -= 1
            if not length:
                break
            chosen.append(length)
            spare += size - length
        if not chosen or spare > plan.capacity // LEAST_FILL:
            return  # the rest of these documents fit better one by one
        sequences = min([copies, *(int(counts[length]) // chosen.count(length) for length in chosen)])
        first, offset = plan.open(sequences), 0
        for length in chosen:
            plan.put(length, sequences, first, 1, offset)
            counts[length] -= sequences
            offset += length
        if offset < plan.capacity:
            gaps[plan.capacity - offset].append((first, sequences))
        copies -= sequences


def _best_fit(plan: Plan, gaps: dict, length: int, left: int) -> None:
    """Put documents of one length where the least room is left over, then into new sequences."""
    while left:
        fitting = [gap for gap, runs in gaps.items() if gap >= length and runs]
        if fitting:
            gap = min(fitting)
            first, sequences = gaps[gap].pop()
        else:
            gap = plan.capacity
            sequences = -(-left // (gap // length))
            first = plan.open(sequences)
        each, offset = gap // length, plan.capacity - gap
        full = min(sequences, left // each)
        if full:
            plan.put(length, full * each, first, each, offset)
            gaps[gap - each * length].append((first, full))
            left -= full * each
        if full < sequences:
            if left:
                plan.put(length, left, first + full, left, offset)
                gaps[gap - left * length].append((first + full, 1))
                full, left = full + 1, 0
            if full < sequences:
                gaps[gap].append((first + full, sequences - full))


def cut(size: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else a shorter first piece and full ones."""
    if size <= capacity:
        return [(0, size)]
    first = size % capacity
    return ([(0, first)] if first else []) + [(at, capacity) for at in range(first, size, capacity)]


def pieces(docs: DataFrame, vocabulary_path: str, end_id: int, capacity: int) -> DataFrame:
    """(part, nth, doc_id, piece, start, length, ids, ids_crc32) of all documents; ``ids`` are packed numbers.

    ``nth`` numbers the pieces of one length within one task (``part``); write the table before using the numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, part, kind = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId(), id_type(vocabulary_path)
        for batch in batches:
            texts, doc_ids = arrays.column_texts(batch, "text"), batch.column("doc_id").to_pylist()
            for begin, end in arrays.blocks(texts):
                ids, counts = library_encode(vocabulary_path, texts[begin:end])
                ids = np.insert(ids, np.cumsum(counts), end_id)
                whole, packed = memoryview(ids.astype("<u4").tobytes()), memoryview(ids.astype(kind).tobytes())
                wide, rows, at = np.dtype(kind).itemsize, [], 0
                for doc_id, size in zip(doc_ids[begin:end], (counts + 1).tolist(), strict=True):
                    for piece, (start, length) in enumerate(cut(size, capacity)):
                        a, b = at + start, at + start + length
                        rows.append((int(seen[length]), doc_id, piece, start, length, packed[wide * a : wide * b], zlib.crc32(whole[4 * a : 4 * b])))
                        seen[length] += 1
                    at += size
                nth, doc, piece, start, length, data, crc = zip(*rows, strict=True)
                longs = [pa.array(x, pa.int64()) for x in (nth, doc)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(rows), pa.int32()), *longs, pa.array(piece, pa.int32()), pa.array(start, pa.int64())]
                    + [pa.array(length, pa.int64()), pa.array([bytes(d) for d in data], pa.binary()), pa.array(crc, pa.int64())],
                    ["part", "nth", "doc_id", "piece", "start", "length", "ids", "ids_crc32"],
                )

    schema = "part int, nth long, doc_id long, piece int, start long, length long, ids binary, ids_crc32 long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def placed(written: DataFrame, capacity: int, groups: int = GROUPS) -> DataFrame:
    """(part, nth, doc_id, piece, start, length, ids_crc32, sequence_id, offset) of written pieces; ``ids`` stay where they are.

    Small rows only are shuffled: by (part, length), so that no length, however common, meets in one task.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for row in written.groupBy("length").count().collect():  # at most one row for each length
        counts[row["length"]] = row["count"]
    plan = plan_lengths(counts, groups)
    runs = np.array(sorted(plan.places), np.int64).reshape(-1, 6)
    firsts = runs[:, 0] << 44 | runs[:, 1]

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
        run = runs[np.searchsorted(firsts, length << 44 | number, side="right") - 1]
        at = number - run[:, 1]
        found = {"sequence_id": run[:, 3] + at // run[:, 4], "offset": run[:, 5] + at % run[:, 4] * length}
        return pa.RecordBatch.from_arrays(
            [batch.column(c) for c in keep] + [pa.array(found[c], pa.int64()) for c in ("sequence_id", "offset")],
            [*keep, "sequence_id", "offset"],
        )

    keep = ["part", "nth", "doc_id", "piece", "start", "length", "ids_crc32"]
    per_part = written.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = per_part.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    numbered = written.select(*keep).join(shifts, ["part", "length"]).withColumn("number", F.col("before") + F.col("nth"))
    schema = "part int, nth long, doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return arrays.map_batches(numbered.select(*keep, "number"), find, schema)


def pack(docs: DataFrame, vocabulary_path: str, path: str, end_id: int, capacity: int = 1024) -> tuple[DataFrame, DataFrame]:
    """(pieces with their token ids, places of all pieces) of whole documents with ``end_id`` after each.

    Null texts are empty: one token, the end. Repeated rows and null ids are packed like any other; other columns are not read; no
    documents: no pieces. A piece is told by (part, nth, length) in both tables.
    """
    made = arrays.written(pieces(docs, vocabulary_path, end_id, capacity), f"{path}/pieces")
    return made, placed(made, capacity)


def sequences(made: DataFrame, places: DataFrame) -> DataFrame:
    """(sequence_id, pieces array of (offset, doc_id, piece, ids)) in order of offset: the packed sequences themselves."""
    rows = places.select("part", "nth", "length", "sequence_id", "offset").join(made, ["part", "nth", "length"])
    piece = F.struct("offset", "doc_id", "piece", "ids")
    return rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
