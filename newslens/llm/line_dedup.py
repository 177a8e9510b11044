"""Line deduplication by sorted hashes; documents get keep bitmaps, texts do not travel.

Lines go out as a 128-bit hash of their key with document and position, are split into ranges of (hash, document, position) and
sorted. So even one line of a third of all documents is spread over many tasks. Each task streams its range and says which lines
go; a key that crosses the border of two ranges is settled from the summaries of the first and last key of every task.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm import arrays

BLANKS = b" \t\n\x0b\x0c\r"
KEY = ["h1", "h2"]
DOC = ["doc_id", "text_hash"]
NO_ID = -(2**63)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text): id and hash tell documents apart, in every reading; rows equal in both are one document."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def line_hashes(docs: DataFrame, least_points: int) -> DataFrame:
    """(h1, h2, doc_id, text_hash, pos): one row for each line whose key has enough code points."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, doc, pos = bytearray(), [], []
        for at, text in enumerate(batch.column("text").to_pylist()):
            for k, line in enumerate(text.encode().lower().split(b"\n")):  # bytes: A-Z only
                key = line.strip(BLANKS)
                if key and (least_points <= 1 or len(key.decode()) >= least_points):
                    hashes += xxhash.xxh3_128_digest(key)
                    doc.append(at)
                    pos.append(k)
        halves = np.frombuffer(bytes(hashes), "<i8").reshape(-1, 2)
        at = np.array(doc, np.int64)
        columns = [pa.array(halves[:, 0]), pa.array(halves[:, 1])]
        columns += [pa.array(batch.column(c).to_numpy()[at]) for c in DOC] + [pa.array(np.array(pos, np.int32))]
        return pa.RecordBatch.from_arrays(columns, [*KEY, *DOC, "pos"])

    return arrays.map_batches(docs, work, "h1 long, h2 long, doc_id long, text_hash long, pos int")


class _Stream:
    """Reads the sorted lines of a task. A run is the lines of one key; the last run stays open until the next batch.

    Lines of runs of at least ``least_docs`` documents go, with ``keep_first`` all but the first. What cannot be said in this
    task alone is given out as pending: lines of its first and last run, and the first line of its first run. Never more than
    the lines of ``least_docs`` documents of one key are held.
    """

    def __init__(self, part: int, least_docs: int, keep_first: bool):
        self.part, self.least, self.keep_first = part, least_docs, keep_first
        self.open: dict | None = None
        self.head = True

    def feed(self, rows: np.ndarray) -> Iterator[tuple]:
        """``rows``: h1, h2, doc_id, text_hash, pos."""
        new_key = np.ones(len(rows), bool)
        new_key[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        starts = np.flatnonzero(new_key).tolist()
        for a, b in zip(starts, [*starts[1:], len(rows)], strict=True):
            run, key = rows[a:b], (int(rows[a, 0]), int(rows[a, 1]))
            if self.open and self.open["key"] != key:
                yield from self.close(last=False)
            first = tuple(run[0, 2:4])
            if not self.open:
                self.open = {"key": key, "docs": 0, "first": first, "last": None, "head": self.head, "held": []}
                self.head = False
                if self.keep_first:
                    if self.open["head"]:
                        yield ("first", run[:1])
                    run_left = run[1:]
                else:
                    run_left = run
            else:
                run_left = run
            state = self.open
            state["docs"] += int((run[1:, 2:4] != run[:-1, 2:4]).any(axis=1).sum()) + (first != state["last"])
            state["last"] = tuple(run[-1, 2:4])
            if len(run_left):
                state["held"].append(run_left)
            if state["docs"] >= self.least and state["held"]:
                yield ("drop", np.concatenate(state["held"]))
                state["held"] = []

    def close(self, last: bool) -> Iterator[tuple]:
        state, self.open = self.open, None
        if state and (state["head"] or last):
            if state["held"]:
                yield ("pending", np.concatenate(state["held"]))
            yield ("edge", self.part, *state["key"], *map(int, state["first"]), *map(int, state["last"]), state["docs"], bool(last))


OUT = (
    "kind string, part int, h1 long, h2 long, doc_id long, text_hash long, pos int, last_doc long, last_hash long, docs long, at_end boolean"
)


def streamed(lines: DataFrame, least_docs: int, keep_first: bool, partitions: int | None = None) -> DataFrame:
    """What the tasks say: lines to ``drop``, ``pending`` and ``first`` lines, and an ``edge`` row for the first and last key of each task."""
    names = [c.split()[0] for c in OUT.split(", ")]
    schema = pa.schema(list(zip(names, [pa.string(), pa.int32(), *[pa.int64()] * 4, pa.int32(), *[pa.int64()] * 3, pa.bool_()], strict=True)))

    def batch_of(made: tuple, part: int) -> pa.RecordBatch:
        if made[0] == "edge":
            _, part, h1, h2, first, first_hash, last, last_hash, docs, at_end = made
            row = ["edge", part, h1, h2, first, first_hash, None, last, last_hash, docs, at_end]
            return pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True))], schema)
        kind, rows = made
        n = len(rows)
        columns = [pa.array([kind] * n), pa.array([part] * n, pa.int32())]
        columns += [pa.array(rows[:, k]) for k in range(4)] + [pa.array(rows[:, 4].astype(np.int32))]
        columns += [pa.nulls(n, pa.int64())] * 3 + [pa.nulls(n, pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.release_words()
        part = TaskContext.get().partitionId()
        stream, held, size = _Stream(part, least_docs, keep_first), [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in (*KEY, *DOC, "pos")], axis=1)
            for made in stream.feed(rows):
                held.append(batch_of(made, part))
                size += held[-1].num_rows
                if size >= 20_000:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held, size = [], 0
        held += [batch_of(made, part) for made in stream.close(last=True)]
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    order = [*KEY, *DOC, "pos"]
    partitions = partitions or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lines.repartitionByRange(partitions, *order).sortWithinPartitions(*order).mapInArrow(run, OUT)


def _settled(edges: list, least_docs: int) -> set[tuple[str, int, int, int]]:
    """(kind, part, h1, h2) of the pending and first lines that go. ``edges``: at most two rows a task."""
    by_key = defaultdict(list)
    for row in sorted(edges, key=lambda r: (r.part, bool(r.at_end))):
        by_key[row.h1, row.h2].append(row)
    gone = set()
    for key, rows in by_key.items():
        docs = sum(row.docs for row in rows)
        for one, two in zip(rows, rows[1:], strict=False):
            docs -= (one.last_doc, one.last_hash) == (two.doc_id, two.text_hash)
        if docs >= least_docs:
            gone |= {("pending", row.part, *key) for row in rows} | {("first", row.part, *key) for row in rows[1:]}
    return gone


def keep_bitmaps(docs: DataFrame, path: str, least_docs: int = 1, keep_first: bool = True, least_points: int = 1) -> DataFrame:
    """(doc_id, text_hash, n_dropped, bitmap): for every document that loses lines, which ones stay.

    Lines whose key is in at least ``least_docs`` documents go, with ``keep_first`` all but the first by id and position. The key of a line: blanks at both ends stripped, A-Z lower-cased; keys with fewer than ``least_points`` code points are left
    alone. ``bitmap`` is zlib-compressed bits, 1 for stay; lines after its end stay. Null texts are one empty line, null ids the smallest
    id; rows with equal id and text count as one document and get one bitmap. ``path``: folder in the shared storage for the hashes.
    """
    lines = arrays.written(line_hashes(keyed(docs), least_points), f"{path}/lines")
    said = arrays.written(streamed(lines, least_docs, keep_first), f"{path}/said")
    edges = said.where("kind = 'edge'").select("part", *KEY, *DOC, "last_doc", "last_hash", "docs", "at_end").collect()
    gone = _settled(edges, least_docs)
    going = said.where("kind = 'drop'").select(*DOC, "pos")
    if gone:
        settled = docs.sparkSession.createDataFrame(sorted(gone), "kind string, part int, h1 long, h2 long")  # four rows a task at most
        pending = said.join(F.broadcast(settled), ["kind", "part", *KEY], "left_semi")
        going = going.unionByName(pending.select(*DOC, "pos"))

    def bits(batch: pa.RecordBatch) -> pa.RecordBatch:
        made, sizes = [], []
        for positions in batch.column("gone").to_pylist():
            stays = np.ones((max(positions) // 8 + 1) * 8, np.uint8)  # whole bytes
            stays[positions] = 0
            made.append(zlib.compress(np.packbits(stays, bitorder="little").tobytes()))
            sizes.append(len(positions))
        columns = [batch.column(c) for c in DOC] + [pa.array(sizes, pa.int64()), pa.array(made, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, [*DOC, "n_dropped", "bitmap"])

    listed = going.groupBy(*DOC).agg(F.collect_set("pos").alias("gone"))
    made = arrays.map_batches(listed, bits, "doc_id long, text_hash long, n_dropped long, bitmap binary")
    return arrays.written(made, f"{path}/bitmaps")


def stays(bitmap: bytes, lines: int) -> np.ndarray:
    """Which of a document's lines stay."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")[:lines].astype(bool)
    return np.concatenate([bits, np.ones(lines - len(bits), bool)])


def kept_text(text: str, bitmap: bytes | None) -> str:
    if bitmap is None:
        return text
    lines = text.split("\n")
    return "\n".join(line for line, stay in zip(lines, stays(bitmap, len(lines)).tolist(), strict=True) if stay)


def digests(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row; only here texts meet their bitmaps."""
    joined = keyed(docs).join(bitmaps.hint("shuffle_hash"), DOC, "left")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lines, dropped, digest = [], [], []
        columns = (batch.column(c).to_pylist() for c in ("text", "bitmap", "n_dropped"))
        for text, bitmap, gone in zip(*columns, strict=True):
            lines.append(text.count("\n") + 1)
            dropped.append(gone or 0)
            digest.append(hashlib.sha256(kept_text(text, bitmap).encode()).hexdigest())
        own = batch.column("doc_id")
        return pa.RecordBatch.from_arrays(
            [own, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(digest)],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )

    rows = arrays.map_batches(
        joined.select("doc_id", "text", "bitmap", "n_dropped"), work, "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    )
    return rows.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def deduplicated(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with all its columns, texts without the lines that go; a null text stays null."""
    key = F.struct(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
    )
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), key.alias("key"))
    small = bitmaps.select(F.struct("doc_id", "text_hash").alias("key"), "bitmap")
    joined = own.join(small.hint("shuffle_hash"), "key", "left").select("doc", "bitmap")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.column("doc").type.get_field_index("text")
        texts = batch.column("doc").field(at).to_pylist()
        made = [kept_text(t, b) if t is not None else None for t, b in zip(texts, batch.column("bitmap").to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(made, pa.string())], ["doc", "kept"])

    kind = own.schema["doc"].dataType.simpleString()
    rows = arrays.map_batches(joined, work, f"doc {kind}, kept string")
    return rows.select(*[F.col("kept").alias(c) if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns])
