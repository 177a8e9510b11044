"""Removal of long repeats: bytes covered by a string of 200 bytes that starts anywhere else too.

Of every 200 bytes one part of 50 is chosen by the smallest hash, so equal strings choose equal parts: the anchors. Occurrences of an
anchor with the same 350 bytes around them are repeats as they are. Where the surroundings differ, one occurrence of each kind
goes into an index of its anchor: a Burrows-Wheeler transform of the surroundings, kept by runs. It is built backwards from the anchor, one
preceding byte at a time; within a run neighbours stay neighbours and their common length grows by one, only at the
ends of runs it is worked out anew. Each row's longest match with another row is its matching statistic, and matches of 200 bytes are marked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm import arrays
from newslens.llm.line_dedup import DOC, NO_ID, keyed

LENGTH, ANCHOR = 200, 50
AROUND = LENGTH - ANCHOR
#: Rows that an index holds (more, if one anchor has more), and rows from which on an anchor is settled by hashes of all its windows.
INDEX_ROWS, HOT_ROWS = 8_000, 100_000
_END = 0xFF  # no UTF-8 text holds this byte


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, position in it, bytes from there to the end of its surroundings, anchor hash, hash of the surroundings)."""
    size, windows = len(data), len(data) - LENGTH + 1
    none = np.zeros(0, np.int64)
    if windows < 1:
        return none, none, none, none, none
    sums = arrays.prefix_sums(data)
    at = np.arange(size - ANCHOR + 1)
    hashes = arrays.span_hashes(sums, at, at + ANCHOR)
    bits = np.uint64(size.bit_length())
    low = np.uint64((1 << int(bits)) - 1)
    keys = (hashes & ~low) | at.astype(np.uint64)  # of equal hashes in a window the first
    width = AROUND + 1
    padded = np.full(-(-len(keys) // width) * width, np.uint64(2**64 - 1))
    padded[: len(keys)] = keys
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows])
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    chosen = np.zeros(size, bool)
    chosen[(least[doc[:windows] == doc[LENGTH - 1 :]] & low).astype(np.int64)] = True
    place = np.flatnonzero(chosen)
    own = doc[place]
    begin = np.maximum(offsets[own], place - AROUND)
    end = np.minimum(offsets[own + 1], place + LENGTH)
    around = arrays.mixed(arrays.span_hashes(sums, begin, end) + (place - begin).astype(np.uint64))
    return own, place - offsets[own], end - place, hashes[place].view(np.int64), around.view(np.int64)


def anchored(docs: DataFrame) -> DataFrame:
    """(num, doc_id, text_hash, anchors, around, places) of every document of at least LENGTH bytes; write it before using ``num``.

    A place is ``position << 8 | bytes to the end of the surroundings``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.release_words()
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for first, last in arrays.blocks(texts):
                doc, position, ahead, hashes, around = anchors(*arrays.utf8(texts[first:last]))
                counts = np.bincount(doc, minlength=last - first)
                has = np.flatnonzero(counts)
                cuts = pa.array(np.concatenate([[0], np.cumsum(counts[has])]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cuts, pa.array(v)) for v in (hashes, around, position << 8 | ahead)]
                own = [pa.array(batch.column(c).to_numpy()[first + has]) for c in DOC]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number + np.arange(len(has))), *own, *lists], ["num", *DOC, "anchors", "around", "places"]
                )
                number += len(has)

    schema = "num long, doc_id long, text_hash long, anchors array<long>, around array<long>, places array<long>"
    return docs.mapInArrow(run, schema)


def compared(rows: DataFrame) -> DataFrame:
    """(anchor, num, place, whole): occurrences whose surroundings are repeated (``whole``) or must be compared with others.

    Occurrences are sorted in ranges of (anchor, surroundings, number), so that those of one anchor may be spread over tasks. Each batch of rows stands
    for itself: its first and last anchor may go on elsewhere, and one occurrence of each of their surroundings is compared in any case.
    """
    lists = F.arrays_zip("anchors", "around", "places")
    flat = rows.select("num", F.explode(lists).alias("o")).select(
        F.col("o.anchors").alias("anchor"), F.col("o.around").alias("around"), "num", F.col("o.places").alias("place")
    )
    order = ["anchor", "around", "num", "place"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        anchor, around, num, place = (batch.column(c).to_numpy() for c in order)
        new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        new_kind = new_anchor | np.concatenate([[True], around[1:] != around[:-1]])
        group, kind = np.cumsum(new_anchor) - 1, np.cumsum(new_kind) - 1
        kinds = np.bincount(group[new_kind])
        open_ = kinds[group] > 1
        open_ |= (group == 0) | (group == group[-1])
        whole = np.bincount(kind)[kind] > 1
        long_enough = np.minimum(place >> 8, AROUND) + (place & 255) >= LENGTH
        asked = new_kind & open_ & long_enough
        marked = whole & long_enough
        at = np.concatenate([np.flatnonzero(marked), np.flatnonzero(asked)])
        says = np.arange(len(at)) < marked.sum()
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor[at]), pa.array(num[at]), pa.array(place[at]), pa.array(says)], ["anchor", "num", "place", "whole"]
        )

    ranged = flat.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return arrays.map_batches(ranged, work, "anchor long, num long, place long, whole boolean")


def surroundings(docs: DataFrame, rows: DataFrame, asked: DataFrame) -> DataFrame:
    """(anchor, num, place, bytes) of the asked occurrences, cut out of their texts."""
    per_text = asked.groupBy("num").agg(F.collect_list(F.struct("anchor", "place")).alias("asked"))
    per_doc = rows.select("num", *DOC).join(per_text, "num")

    def work(batch: pa.RecordBatch):
        columns = (batch.column(c).to_pylist() for c in ("text", "num", "asked"))
        made, size = [], 0
        for text, num, wanted in zip(*columns, strict=True):
            data = text.encode()
            for one in wanted:
                position, ahead = one["place"] >> 8, one["place"] & 255
                made.append((one["anchor"], num, one["place"], data[max(0, position - AROUND) : position + ahead]))
            if len(made) >= 4_000:
                yield batch_of(made)
                made = []
        if made:
            yield batch_of(made)

    def batch_of(made: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        names = ["anchor", "num", "place", "bytes"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)], names)

    joined = keyed(docs).join(per_doc.hint("shuffle_hash"), DOC).select("text", "num", "asked")
    return arrays.map_batches(joined, work, "anchor long, num long, place long, bytes binary")


def longest_matches(groups: np.ndarray, lefts: np.ndarray, rights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes before the anchor, bytes from it on) that each row's matches of LENGTH bytes with other rows of its group cover; 0, 0: none.

    ``rights``: bytes from the anchor on, ``lefts``: bytes before it, backwards; both filled up with _END. ``groups`` ascend.
    """
    rows = np.ascontiguousarray(np.concatenate([groups.astype(">u4").view(np.uint8).reshape(-1, 4), rights], axis=1))
    order = np.argsort(rows.view(f"S{rows.shape[1]}").reshape(-1), kind="stable")
    differs = (rights[order[1:]] != rights[order[:-1]]) | (rights[order[1:]] == _END)
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), rights.shape[1])
    common[groups[order[1:]] != groups[order[:-1]]] = -1
    common = np.concatenate([[-1], common])  # with the row before
    before, after = np.zeros(len(groups), np.int64), np.zeros(len(groups), np.int64)
    for step in range(AROUND + 1):
        best = np.maximum(common, np.append(common[1:], -1))
        hit = best >= LENGTH
        found = order[hit]
        before[found] = step
        after[found] = np.maximum(after[found], best[hit] - step)
        if step == AROUND:
            break
        # the transform's column: the byte before each suffix; its runs within a group
        byte = lefts[order, step]
        live = np.flatnonzero((byte != _END) & (best + AROUND - step >= LENGTH))
        if len(live) < 2:
            break
        key = groups[order[live]].astype(np.int64) << 8 | byte[live]
        moved = np.argsort(key, kind="stable")  # last to first column
        at, key = live[moved], key[moved]
        same = key[1:] == key[:-1]
        inside = same & (at[1:] == at[:-1] + 1)
        grown = np.full(len(at), -1)
        grown[1:][inside] = common[at[1:][inside]] + 1
        ends = np.flatnonzero(same & ~inside)  # between two runs of one byte: the least common length on the way
        if len(ends):
            spans = np.stack([at[ends] + 1, at[ends + 1] + 1], axis=1).reshape(-1)
            least = np.minimum.reduceat(np.append(common, 0), spans)[::2]
            grown[ends + 1] = np.where(least >= 0, least + 1, -1)
        order, common = order[at], grown
    return before, after


def indexed(rows: DataFrame) -> DataFrame:
    """(num, start, stop): what the indexes of the anchors mark. An anchor's rows stay together; a task builds index after index."""

    def index(made: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(made)
        anchor, num, place = (table.column(c).to_numpy() for c in ("anchor", "num", "place"))
        keep = np.ones(len(anchor), bool)
        keep[1:] = (anchor[1:] != anchor[:-1]) | (num[1:] != num[:-1]) | (place[1:] != place[:-1])  # rows of one occurrence
        groups = np.cumsum(np.concatenate([[True], anchor[1:] != anchor[:-1]])) - 1
        several = keep & (np.bincount(groups, keep)[groups] > 1)
        at = np.flatnonzero(several)
        if not len(at):
            return pa.RecordBatch.from_pydict({c: pa.array([], pa.int64()) for c in ("num", "start", "stop")})
        data = table.column("bytes").to_pylist()
        left = np.minimum(place[at] >> 8, AROUND)
        lefts, rights = np.full((len(at), AROUND), _END, np.uint8), np.full((len(at), LENGTH), _END, np.uint8)
        for row, (k, cut) in enumerate(zip(at.tolist(), left.tolist(), strict=True)):
            value = np.frombuffer(data[k], np.uint8)
            lefts[row, :cut] = value[:cut][::-1]
            rights[row, : len(value) - cut] = value[cut:]
        before, after = longest_matches(groups[at], lefts, rights)
        hit = after > 0
        position = (place[at] >> 8)[hit]
        columns = (num[at][hit], position - before[hit], position + after[hit])
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["num", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.release_words()
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= INDEX_ROWS:
                whole = pa.Table.from_batches(held).combine_chunks()
                anchor = whole.column("anchor").to_numpy()
                cut = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on
                if cut:
                    yield index(whole.slice(0, cut).to_batches())
                    held = whole.slice(cut).to_batches()
                    size = whole.num_rows - cut
        if held:
            yield index(held)

    order = ["anchor", "num", "place"]
    dealt = rows.repartition("anchor").sortWithinPartitions(*order)
    return dealt.mapInArrow(run, "num long, start long, stop long")


def by_windows(rows: DataFrame) -> DataFrame:
    """(num, start, stop) for anchors with too many rows for an index: hashes of all their windows, counted by Spark."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for num, place, data in zip(*(batch.column(c).to_pylist() for c in ("num", "place", "bytes")), strict=True):
            begin = max(0, (place >> 8) - AROUND)
            for at in range(len(data) - LENGTH + 1):
                made.append((hashlib.blake2b(data[at : at + LENGTH], digest_size=16).digest(), num, begin + at))
        columns = list(zip(*made, strict=True)) or [[], [], []]
        kinds = (pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["window", "num", "start"])

    windows = arrays.map_batches(rows, work, "window binary, num long, start long").distinct()
    again = windows.groupBy("window").count().where("count > 1").select("window")
    return windows.join(again, "window", "left_semi").select("num", "start", (F.col("start") + LENGTH).alias("stop"))


def repeated_spans(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, text_hash, spans array<struct<start, stop>>): maximal runs of repeated bytes of each document that has any.

    Texts count as UTF-8 bytes, null as empty; texts under LENGTH bytes have no repeats; matches stay within documents. Of repeated rows each
    repeats the other, and they are told by id (null: the smallest id) and text, so they lose the same bytes. ``path``: folder in the shared storage.
    """
    rows = arrays.written(anchored(keyed(docs)), f"{path}/anchors")
    said = arrays.written(compared(rows), f"{path}/compared")
    asked = said.where("not whole").select("anchor", "num", "place")
    hot = [r.anchor for r in asked.groupBy("anchor").count().where(F.col("count") > HOT_ROWS).select("anchor").limit(1).collect()]
    position, ahead = F.shiftright("place", 8), F.col("place").bitwiseAND(255)
    marks = said.where("whole").select(
        "num", F.greatest(position - AROUND, F.lit(0)).alias("start"), (position + ahead).alias("stop")
    )
    if hot:
        large = asked.groupBy("anchor").count().where(F.col("count") > HOT_ROWS).select("anchor")
        marks = marks.unionByName(by_windows(surroundings(docs, rows, asked.join(large, "anchor", "left_semi"))))
        asked = asked.join(large, "anchor", "left_anti")
    marks = marks.unionByName(indexed(surroundings(docs, rows, asked)))
    listed = marks.groupBy("num").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    per_doc = listed.join(rows.select("num", *DOC), "num").groupBy(*DOC).agg(F.flatten(F.collect_list("spans")).alias("spans"))

    def merge(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for spans in batch.column("spans"):
            start, stop = (spans.values.field(k).to_numpy() for k in range(2))
            order = np.argsort(start, kind="stable")
            start, stop = start[order], np.maximum.accumulate(stop[order])
            heads = np.flatnonzero(np.concatenate([[True], start[1:] > stop[:-1]]))
            tails = np.append(heads[1:] - 1, len(start) - 1)
            made.append([{"start": a, "stop": b} for a, b in zip(start[heads].tolist(), stop[tails].tolist(), strict=True)])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in DOC), pa.array(made, kind)], [*DOC, "spans"])

    made = arrays.map_batches(per_doc, merge, "doc_id long, text_hash long, spans array<struct<start:long,stop:long>>")
    return arrays.written(made, f"{path}/spans")


def kept_bytes(text: str, spans: list[dict] | None) -> bytes:
    """The bytes outside the spans."""
    data = text.encode()
    if not spans:
        return data
    cuts = [0, *(edge for span in spans for edge in (span["start"], span["stop"])), len(data)]
    return b"".join(data[a:b] for a, b in zip(cuts[0::2], cuts[1::2], strict=True))


def digests(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    joined = keyed(docs).join(spans.hint("shuffle_hash"), DOC, "left").select("doc_id", "text", "spans")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for text, own in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            kept, size = kept_bytes(text, own), len(text.encode())
            made.append((size, size - len(kept), len(own or ()), hashlib.sha256(kept).hexdigest()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = [pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return arrays.map_batches(joined, work, schema).withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def without_repeats(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with all columns, texts without their spans (a character of which only some bytes are left goes too); null stays null."""
    key = F.struct(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
    )
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), key.alias("key"))
    small = spans.select(F.struct("doc_id", "text_hash").alias("key"), "spans")
    joined = own.join(small.hint("shuffle_hash"), "key", "left").select("doc", "spans")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.column("doc").type.get_field_index("text")
        pairs = zip(batch.column("doc").field(at).to_pylist(), batch.column("spans").to_pylist(), strict=True)
        made = [kept_bytes(t, s).decode("utf-8", "ignore") if t is not None else None for t, s in pairs]
        return pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(made, pa.string())], ["doc", "kept"])

    rows = arrays.map_batches(joined, work, f"doc {own.schema['doc'].dataType.simpleString()}, kept string")
    return rows.select(*[F.col("kept").alias(c) if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns])
