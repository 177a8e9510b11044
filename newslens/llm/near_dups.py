"""Near duplicates by order MinHash (Marçais et al. 2019), verified by banded alignment.

A document is the sequence of its shingles of five words, each labelled with how often it has occurred before. A sketch takes the few
labelled shingles with the smallest hashes and hashes them in text order, so it agrees for documents that have the same parts in the
same order. Documents that share a sketch with few others are compared all with all. In a larger bucket, or one that crosses a border of tasks, they
are first compared with one representative and with their neighbours in the order of all sketches. Where that leaves a bucket in several parts, neighbours in
several orders of long signatures are compared that are not yet in one part, each document with a few others, so most parts of a group of copies meet before anything is
paired within it. What is still apart is joined by its rarest shingles (prefix and positional filter, Xiao et al. 2008), which loses no pair and meets no
common template.
Which of these pairs are near duplicates is decided by alignment of the shingles. Classes are the connected components.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm import arrays
from newslens.llm.components import components

SHINGLE, SIMILARITY = 5, 0.8
#: Sketches a document, shingles a sketch, and how many sketches two documents must share to be aligned. At a similarity of
#: 0.8 a pair shares a sketch with probability 0.8 ** 3, so it is missed with a probability under 0.0002.
SKETCHES, TAKEN, SHARED = 16, 3, 2
#: Buckets of up to so many rows are compared all with all, rows of larger ones with so many neighbours at first.
WHOLE, NEIGHBOURS = 16, 3
#: Rows that are held at once. Later rows of a bucket get a representative of their own, linked to the one before.
HELD = 50_000
#: Counters of shingles that put rare ones first. Any order gives the same pairs; shingles that share a counter only look more frequent.
COUNTERS = 1 << 20
#: Orders of signatures and the bytes that each is sorted by, rows before a row that are looked at, how many of them are aligned with it, and the
#: share of equal bytes that this takes (at a similarity of 0.8 that of 144 bytes lies below it once in ten times).
ORDERS, SIGNS, WINDOW, BESIDE, LIKELY = 6, 24, 32, 2, 0.76

_FACTORS = np.random.default_rng(20190711).integers(1, 2**63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(texts: list[str], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the shingles of all texts, offsets of the texts). Words are what blanks separate, A-Z lower-cased.

    A text with fewer words than a shingle has one shingle of all its words; without words it has none.
    """
    _, points = arrays.code_points(texts)
    points = np.where((points >= 65) & (points <= 90), points + 32, points)
    breaks = np.flatnonzero(points == arrays.BREAK)
    wordly = ~((points == 32) | (points >= 9) & (points <= 13) | (points == arrays.BREAK))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], wordly, [False]]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    words = arrays.span_hashes(arrays.prefix_sums(points), starts, ends)
    doc = np.searchsorted(breaks, starts)
    n_words = np.bincount(doc, minlength=len(texts))
    counts = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    first = np.cumsum(n_words) - n_words
    offsets = np.concatenate([[0], np.cumsum(counts)])
    at = np.repeat(first - offsets[:-1], counts) + np.arange(offsets[-1])
    last = np.repeat(first + n_words, counts)
    total = np.zeros(len(at), np.uint64)
    for k in range(width):
        inside = at + k < last
        word = np.where(inside, words[np.minimum(at + k, len(words) - 1)] if len(words) else 0, 0).astype(np.uint64)
        total = arrays.mixed(total * np.uint64(31) + word + np.uint64(k))
    return total, offsets


def labelled(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shingles with their occurrence number within the text mixed in: all different within a text."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((hashes, doc))
    again = (hashes[order[1:]] == hashes[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    if not again.any():
        return hashes
    run = np.arange(len(order))
    heads = np.concatenate([[True], ~again])
    occurrence = np.zeros(len(order), np.uint64)
    occurrence[order] = (run - np.maximum.accumulate(np.where(heads, run, 0))).astype(np.uint64)
    return np.where(occurrence > 0, arrays.mixed(hashes + occurrence * np.uint64(0x9E3779B97F4A7C15)), hashes)


def sketches(hashes: np.ndarray, labels: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts with shingles) x SKETCHES: hashes of the smallest labelled shingles in text order."""
    has = np.flatnonzero(np.diff(offsets))
    starts, counts = offsets[:-1][has], np.diff(offsets)[has]
    at = np.arange(len(labels))
    far = np.uint64(2**64 - 1)
    made = np.zeros((len(has), SKETCHES), np.uint64)
    for k in range(SKETCHES):
        value = labels * _FACTORS[k]
        picked = np.zeros((len(has), TAKEN), np.int64)
        for turn in range(TAKEN):
            least = np.minimum.reduceat(value, starts)
            hit = np.flatnonzero(value == np.repeat(least, counts))
            owner = np.searchsorted(starts, hit, side="right") - 1
            spot = np.zeros(len(has), np.int64)
            spot[owner[::-1]] = at[hit[::-1]]
            picked[:, turn] = np.where(turn < counts, spot, -1)  # fewer shingles: fewer are taken
            value[spot] = far
        picked.sort(axis=1)
        chain = np.full(len(has), k, np.uint64)
        for turn in range(TAKEN):
            chain = arrays.mixed(chain * np.uint64(31) + np.where(picked[:, turn] >= 0, hashes[picked[:, turn]], np.uint64(7)))
        made[:, k] = chain
    return made


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, node, n, sketch array<long>) of every row: ``node`` is a hash of the words, 16 bytes."""

    def work(batch: pa.RecordBatch):
        texts = arrays.column_texts(batch, "text")
        for begin, end in arrays.blocks(texts):
            hashes, offsets = shingles(texts[begin:end])
            counts = np.diff(offsets)
            labels = labelled(hashes, offsets)
            found = np.zeros((end - begin, SKETCHES), np.uint64)
            has = counts > 0
            if has.any():
                found[has] = sketches(hashes, labels, offsets)
            place = np.arange(len(hashes)) - np.repeat(offsets[:-1], counts)
            doc = np.repeat(np.arange(end - begin), counts)
            nodes = np.zeros((end - begin, 2), np.uint64)
            for half, salt in enumerate((0x51, 0xA7)):
                value = arrays.mixed(arrays.mixed(hashes + np.uint64(salt)) + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                sums = np.zeros(end - begin, np.uint64)
                np.add.at(sums, doc, value)
                nodes[:, half] = arrays.mixed(sums + counts.astype(np.uint64))
            keys = nodes.astype(">u8").tobytes()
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(end - begin + 1, dtype=np.int32) * SKETCHES), pa.array(found.view(np.int64).reshape(-1))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(begin, end - begin) for c in ("doc_id", "text_key")]
                + [pa.array([keys[16 * k : 16 * k + 16] for k in range(end - begin)], pa.binary())]
                + [pa.array(counts.astype(np.int32)), lists],
                ["doc_id", "text_key", "node", "n", "sketch"],
            )

    rows = _keyed(docs).select("doc_id", "text_key", "text")
    return arrays.map_batches(rows, work, "doc_id long, text_key long, node binary, n int, sketch array<long>")


class _Rows:
    """Rows of sorted buckets: numbers of the bucket, node as two numbers, shingles, marks."""

    def __init__(self, bands: np.ndarray, values: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, marks: np.ndarray):
        self.columns = (bands, values, nodes, sizes, marks)

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> "_Rows":
        nodes = np.frombuffer(b"".join(batch.column("node").to_pylist()), ">u8").reshape(-1, 2).astype(np.uint64)
        marks = batch.column("mark").flatten().to_numpy().reshape(-1, SKETCHES)
        return cls(batch.column("band").to_numpy(), batch.column("value").to_numpy(), nodes, batch.column("n").to_numpy(), marks)

    @classmethod
    def joined(cls, parts: list["_Rows"]) -> "_Rows":
        return cls(*(np.concatenate(column) for column in zip(*(part.columns for part in parts), strict=True)))

    def __len__(self) -> int:
        return len(self.columns[0])

    def part(self, chosen) -> "_Rows":
        return _Rows(*(column[chosen] for column in self.columns))

    def starts(self) -> np.ndarray:
        bands, values = self.columns[:2]
        return np.flatnonzero(np.concatenate([[True], (values[1:] != values[:-1]) | (bands[1:] != bands[:-1])]))

    def heads(self, starts: np.ndarray) -> np.ndarray:
        """For each bucket the row of its smallest node: its representative."""
        high = self.columns[2][:, 0]
        counts = np.diff(np.append(starts, len(self)))
        hit = np.flatnonzero(high == np.repeat(np.minimum.reduceat(high, starts), counts))
        owner = np.searchsorted(starts, hit, side="right") - 1
        heads = np.zeros(len(starts), np.int64)
        heads[owner[::-1]] = hit[::-1]
        return heads

    def said(self, open_first: bool, open_last: bool) -> pa.RecordBatch:
        """SAID: pairs to look at, and rows of buckets that are not compared all with all here, as (node, null, null, band, value).

        ``open_first``, ``open_last``: the first or last bucket may have more rows elsewhere.
        """
        bands, values, nodes, sizes, marks = self.columns
        starts = self.starts()
        counts = np.diff(np.append(starts, len(self)))
        part = counts > WHOLE
        part[0] |= open_first
        part[-1] |= open_last
        bucket = np.repeat(np.arange(len(starts)), counts)
        rows = np.arange(len(self))
        choices = [(rows, self.heads(starts)[bucket])]
        whole = (counts <= WHOLE)[bucket]
        for k in range(1, min(max(WHOLE - 1, NEIGHBOURS), len(self) - 1) + 1):
            near = rows[k:][(bucket[k:] == bucket[:-k]) & (whole[k:] | (k <= NEIGHBOURS))]
            choices.append((near, near - k))
        found = []
        for one, two in choices:
            shared = (marks[one] == marks[two]).sum(axis=1)
            small, large = np.minimum(sizes[one], sizes[two]), np.maximum(sizes[one], sizes[two])
            fit = (shared >= SHARED) & (small >= SIMILARITY * large) & (nodes[one] != nodes[two]).any(axis=1)
            one, two, shared = one[fit], two[fit], shared[fit]
            (a1, a2), (b1, b2) = nodes[one].T, nodes[two].T
            up = (a1 > b1) | (a1 == b1) & (a2 > b2)
            found.append((np.where(up, one, two), np.where(up, two, one), shared))
        high, low, shared = (np.concatenate(column) for column in zip(*found, strict=True))
        left = np.flatnonzero(part[bucket])
        n, m = len(high), len(left)
        columns = [pa.array(_spelled(nodes[high]) + _spelled(nodes[left]), pa.binary()), pa.array(_spelled(nodes[low]) + [None] * m, pa.binary())]
        columns.append(pa.concat_arrays([pa.array(shared.astype(np.int32)), pa.nulls(m, pa.int32())]))
        columns.append(pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(bands[left].astype(np.int32))]))
        columns.append(pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(values[left].astype(np.int64))]))
        return pa.RecordBatch.from_arrays(columns, ["a", "b", "shared", "band", "value"])


SAID = "a binary, b binary, shared int, band int, value long"


def _spelled(nodes: np.ndarray) -> list[bytes]:
    keys = nodes.astype(">u8").tobytes()
    return [keys[at : at + 16] for at in range(0, len(keys), 16)]


def candidates(nodes: DataFrame) -> DataFrame:
    """SAID rows: pairs of different nodes to look at, a > b, and the rows of buckets that these pairs do not settle.

    Buckets are ranges of one sort order, so a large bucket may be spread over tasks. Within a bucket rows are sorted by one byte of each sketch,
    from the band on: neighbours agree in many sketches.
    """
    band = F.explode(F.sequence(F.lit(0), F.lit(SKETCHES - 1))).alias("band")
    rows = nodes.where("n > 0").select("node", "n", "sketch", band)
    turned = F.concat(F.slice("sketch", F.col("band") + 1, SKETCHES), F.slice("sketch", 1, F.col("band")))
    mark = F.transform(turned, lambda s: (F.pmod(s, F.lit(251)) - 125).cast("tinyint"))
    rows = rows.select("band", F.get("sketch", F.col("band")).alias("value"), mark.alias("mark"), "n", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.release_words()
        held: list[_Rows] = []
        size, open_first = 0, True  # the first and the last bucket of a task may cross its border
        for batch in batches:
            if batch.num_rows:
                held.append(_Rows.of(batch))
                size += batch.num_rows
            if size >= HELD:
                rows = _Rows.joined(held)
                last = int(rows.starts()[-1])
                if last:  # the last bucket may go on: it waits
                    done, rest = rows.part(slice(0, last)), rows.part(slice(last, None))
                else:  # one large bucket: its representative stays as a link to the rest
                    done, rest = rows, rows.part(rows.heads(np.zeros(1, np.int64)))
                yield done.said(open_first, not last)
                held, size, open_first = [rest], len(rest), not last
        if size:
            yield _Rows.joined(held).said(open_first, True)

    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["band", "value", "mark", "node"]
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, SAID)


def unsettled(left: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root): nodes of the buckets (node, band, value) in ``left`` whose nodes are not all in one component."""
    own = left.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = own.groupBy("band", "value").agg(F.min("root").alias("one"), F.max("root").alias("other")).where("one <> other")
    return own.join(mixed.select("band", "value"), ["band", "value"], "left_semi").select("node", "root").distinct()


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(turn, signs, node, root, n): a row for each order; ``signs``: a byte of each of ORDERS x SIGNS smallest hashes of a text's labelled shingles,
    those of the order first."""
    factors = np.random.default_rng(20240611).integers(1, 2**63, ORDERS * SIGNS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    arrays.release_words()
    for batch in batches:
        texts = arrays.column_texts(batch, "text")
        for begin, end in arrays.blocks(texts):
            hashes, offsets = shingles(texts[begin:end])
            labels, counts = labelled(hashes, offsets), np.diff(offsets)
            at = np.flatnonzero(counts)
            if not len(at):
                continue
            least = np.stack([np.minimum.reduceat(arrays.mixed(labels * f), offsets[:-1][at]) for f in factors], axis=1)
            signs = (least % np.uint64(251)).astype(np.uint8)
            row = pa.array(at + begin)
            own = [batch.column(c).take(row) for c in ("node", "root")] + [pa.array(counts[at].astype(np.int32))]
            for turn in range(ORDERS):
                turned = np.roll(signs, -turn * SIGNS, axis=1).tobytes()
                keys = pa.array([turned[k : k + ORDERS * SIGNS] for k in range(0, len(turned), ORDERS * SIGNS)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), turn, np.int32)), keys, *own], ["turn", "signs", "node", "root", "n"])


def by_signatures(texts: DataFrame, path: str, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): pairs of (node, root, text) with different roots that stand near each other in an order of signatures, a > b.

    Texts that agree in more shingles agree in longer beginnings of a signature, so a row's neighbours are its most similar rows. Of the WINDOW rows before it
    a row is paired with the BESIDE of other roots that agree with it most, if they agree enough: the pairs are linear in the rows, whatever the groups.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            turn, n = (batch.column(c).to_numpy() for c in ("turn", "n"))
            signs = np.frombuffer(b"".join(batch.column("signs").to_pylist()), np.uint8).reshape(-1, ORDERS * SIGNS)
            nodes, roots = (np.array(batch.column(c).to_pylist(), object) for c in ("node", "root"))
            now = (turn, n, signs, nodes, roots)
            before = 0 if held is None else len(held[0])
            turn, n, signs, nodes, roots = now if held is None else (np.concatenate(pair) for pair in zip(held, now, strict=True))
            _, root = np.unique(roots.astype("S16"), return_inverse=True)
            rows = np.arange(before, len(turn))
            agree = np.zeros((len(rows), WINDOW), np.int16)
            for k in range(1, WINDOW + 1):
                mine = rows[rows >= k]
                small, large = np.minimum(n[mine], n[mine - k]), np.maximum(n[mine], n[mine - k])
                mine = mine[(turn[mine] == turn[mine - k]) & (root[mine] != root[mine - k]) & (small >= similarity * large)]
                agree[mine - before, k - 1] = (signs[mine] == signs[mine - k]).sum(axis=1)
            best = np.argsort(-agree, axis=1, kind="stable")[:, :BESIDE]
            one, place = np.nonzero(np.take_along_axis(agree, best, axis=1) >= LIKELY * ORDERS * SIGNS)
            pairs = [(nodes[before + i], nodes[before + i - 1 - best[i, j]]) for i, j in zip(one.tolist(), place.tolist(), strict=True)]
            columns = [pa.array([pick(pair) for pair in pairs], pa.binary()) for pick in (max, min)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])
            held = tuple(column[-WINDOW:] for column in (turn, n, signs, nodes, roots))

    kinds = "turn int, signs binary, node binary, root binary, n int"
    signed = arrays.written(texts.select("node", "root", "text").mapInArrow(_signatures, kinds), path)
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["turn", "signs", "node"]
    return signed.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, "a binary, b binary").distinct()


def merged(roots: DataFrame, edges: DataFrame, path: str) -> DataFrame:
    """(node, root) after more edges (u, v): only the roots that they join are named anew, so the cost is theirs, not that of all edges."""
    ends = edges.select("u", "v")
    for c in ("u", "v"):
        own = roots.select(F.col("node").alias(c), F.col("root").alias("own"))
        ends = ends.join(own, c, "left").withColumn(c, F.coalesce("own", c)).drop("own")
    named = components(arrays.written(ends.distinct(), f"{path}/ends"), f"{path}/parts").select(F.col("node").alias("root"), F.col("root").alias("named"))
    moved = roots.join(named, "root", "left").select("node", F.coalesce("named", "root").alias("root"))
    alone = named.select(F.col("root").alias("node"), "named").join(roots.select("node"), "node", "left_anti").select("node", F.col("named").alias("root"))
    return arrays.written(moved.unionByName(alone), f"{path}/roots")


def _label_counts(texts: DataFrame) -> np.ndarray:
    """For each counter the power of two of how many labelled shingles fall on it: 0 for a single one. A fixed number of bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            texts = arrays.column_texts(batch, "text")
            for begin, end in arrays.blocks(texts):
                slots, times = np.unique(labelled(*shingles(texts[begin:end])) % np.uint64(COUNTERS), return_counts=True)
                total[slots.astype(np.int64)] += times
        slots = np.flatnonzero(total)
        for at in range(0, len(slots), 10_000):
            part = slots[at : at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], ["slot", "n"])

    counted = texts.select("text").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.floor(F.log2(F.sum("n"))).cast("tinyint").alias("power"))
    found = counted.toArrow()
    powers = np.zeros(COUNTERS, np.uint8)
    powers[found["slot"].to_numpy()] = found["power"].to_numpy()
    return powers


def by_rare_shingles(texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): all pairs of (node, root, text) with different roots that can be near duplicates, a > b.

    Two texts of a and b shingles, a <= b, need ``least`` = (a + b) * similarity / (1 + similarity) in common. So in any one order of all shingles the first
    one in common has ``least`` - 1 more behind it in both texts: it is early in both. In the order of rarity few texts share an early one.
    """
    powers = _label_counts(texts)

    def early(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, places, sizes, rows = [], [], [], []
            for k, text in enumerate(arrays.column_texts(batch, "text")):
                own = labelled(*shingles([text]))
                power = powers[(own % np.uint64(COUNTERS)).astype(np.int64)]
                order = np.lexsort((own, power))[: len(own) - int(np.ceil(similarity * len(own) - 1e-9)) + 1]
                place = np.flatnonzero(power[order] > 0)  # a single one is in no other text
                labels.append(own[order[place]].view(np.int64))
                places.append(place)
                sizes.append(np.full(len(place), len(own)))
                rows.append(np.full(len(place), k))
            if rows:
                at = pa.array(np.concatenate(rows))
                columns = [pa.array(np.concatenate(labels)), batch.column("node").take(at), batch.column("root").take(at)]
                columns += [pa.array(np.concatenate(c).astype(np.int32)) for c in (sizes, places)]
                yield pa.RecordBatch.from_arrays(columns, ["label", "node", "root", "n", "place"])

    rows = texts.select("node", "root", "text").mapInArrow(early, "label long, node binary, root binary, n int, place int")
    share = similarity / (1 + similarity)
    short = rows.where(F.col("n") - F.col("place") >= 2 * share * F.col("n") - 1e-9)
    short, long = (part.select("label", *[F.col(c).alias(f"{c}_{k}") for c in ("node", "root", "n", "place")]) for k, part in ((1, short), (2, rows)))
    fit = (F.col("root_1") != F.col("root_2")) & (F.col("n_1") <= F.col("n_2")) & (F.col("n_1") >= similarity * F.col("n_2") - 1e-9)
    behind = F.least(F.col("n_1") - F.col("place_1"), F.col("n_2") - F.col("place_2"))
    fit &= behind >= share * (F.col("n_1") + F.col("n_2")) - 1e-9
    pairs = short.join(long, (short["label"] == long["label"]) & fit)
    return pairs.select(F.greatest("node_1", "node_2").alias("a"), F.least("node_1", "node_2").alias("b")).distinct()


def aligned(one: np.ndarray, two: np.ndarray, similarity: float = SIMILARITY) -> float:
    """Similarity of two texts as labelled shingles: aligned ones over all. 0 where it is certainly below ``similarity``.

    At that similarity the texts differ in few places, so aligned shingles lie in a narrow band of offsets.
    """
    total = len(one) + len(two)
    least = total * similarity / (1 + similarity)
    order = np.argsort(two, kind="stable")
    at = np.minimum(np.searchsorted(two[order], one), len(two) - 1)
    place = order[at]
    found = np.flatnonzero(two[place] == one)
    band = total - 2 * least
    found = found[np.abs(place[found] - found) <= band]
    if len(found) < least - 1e-9:
        return 0.0
    places = place[found]
    if (np.diff(places) < 0).any():  # the longest ordered part
        tails: list[int] = []
        for p in places.tolist():
            k = bisect_left(tails, p)
            tails[k : k + 1] = [p]
        matched = len(tails)
    else:
        matched = len(places)
    return matched / (total - matched)


def verified(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(u, v, similarity) of the pairs (a, b) that are near duplicates; ``texts``: (node, text), one row a node."""
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.release_words()
        known: OrderedDict[bytes, np.ndarray] = OrderedDict()

        def labels(node: bytes, text: str) -> np.ndarray:
            if node not in known:
                known[node] = labelled(*shingles([text]))
                if len(known) > 64:
                    known.popitem(last=False)
            else:
                known.move_to_end(node)
            return known[node]

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("a", "text_a", "b", "text_b")), strict=True)
            made = [(a, b, aligned(labels(a, s), labels(b, t), similarity)) for a, s, b, t in rows]
            made = [row for row in made if row[2] >= similarity]
            columns = list(zip(*made, strict=True)) or [[], [], []]
            kinds = (pa.binary(), pa.binary(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["u", "v", "similarity"])

    both = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "text_a", "b", "text_b")
    return both.mapInArrow(run, "u binary, v binary, similarity double")


def _row_key(row=None):
    """What tells rows apart, in an order that puts null ids last: never null itself."""
    doc_id, text_key = (row["doc_id"], row["text_key"]) if row is not None else (F.col("doc_id"), F.col("text_key"))
    return F.struct(doc_id.isNull().alias("no_id"), F.coalesce(doc_id, F.lit(0)).alias("id"), text_key.alias("text_key"))


def _texts(docs: DataFrame, rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text): one row, that of the smallest id, for each wanted node; the only time that texts are shuffled."""
    key = _row_key().alias("key")
    chosen = rows.join(wanted, "node", "left_semi").select("node", key).groupBy("node").agg(F.min("key").alias("key"))
    found = _keyed(docs).select(key, "text").join(chosen.hint("shuffle_hash"), "key")
    return found.groupBy("node").agg(F.first("text").alias("text"))


def classes(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, text_key, class_id): the class of every row; ``class_id`` is the smallest id in the class.

    Texts with the same words are one node; texts without words are one class. Null texts have no words; null ids get a class like others and never
    name one unless all of a class are null; repeated rows are repeated. ``path``: folder in the shared storage. ``stays``: rows of the smallest id in the class.

    First every node is aligned with its representative of the smallest hash; what that joins needs no more alignments, and only
    pairs between different components are aligned after that. Then come buckets that were not compared all with all and are still in several components: first
neighbours in orders of signatures, then, for the parts that are left, all pairs with a rare shingle in common.
    """
    rows = arrays.written(sketched(docs), f"{path}/sketches")
    nodes = rows.groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    said = arrays.written(candidates(nodes), f"{path}/said")
    pairs = arrays.written(said.where("b is not null").groupBy("a", "b").agg(F.max("shared").alias("shared")), f"{path}/pairs")
    left = said.where("b is null").select(F.col("a").alias("node"), "band", "value")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).unionByName(left.select("node")).distinct()
    texts = arrays.written(_texts(docs, rows, wanted), f"{path}/texts")
    first = pairs.groupBy("a").agg(F.min("b").alias("b"))
    edges = arrays.written(verified(first, texts), f"{path}/edges-1")
    roots = components(edges, f"{path}/components-1")
    a, b = (roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab")
    apart = pairs.join(a, "a", "left").join(b, "b", "left").where(
        F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    )
    apart = apart.join(first, ["a", "b"], "left_anti")
    more = arrays.written(verified(apart, texts), f"{path}/edges-2")
    roots = components(edges.unionByName(more).select("u", "v"), f"{path}/components-2")
    for turn, more_pairs in enumerate((lambda found: by_signatures(found, f"{path}/signatures"), by_rare_shingles)):
        hot = arrays.written(unsettled(left, roots), f"{path}/unsettled-{turn}")
        if hot.isEmpty():
            break
        wider = arrays.written(more_pairs(texts.join(hot, "node")), f"{path}/more-pairs-{turn}")
        links = arrays.written(verified(wider, texts), f"{path}/more-edges-{turn}")
        if not links.isEmpty():
            roots = merged(roots, links, f"{path}/merged-{turn}")
    own = rows.select("doc_id", "text_key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = own.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.min(_row_key()).alias("chosen"))
    return own.join(named, "root").select("doc_id", "text_key", "class_id", (_row_key() == F.col("chosen")).alias("stays"))


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with all columns, one row of each class of ``found``: that with the smallest id (null ids last)."""
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), _row_key(key).alias("key"))
    chosen = found.where("stays").select(_row_key().alias("key")).distinct()
    rows = own.join(chosen.hint("shuffle_hash"), "key", "left_semi").dropDuplicates(["key"])
    return rows.select(*[F.col("doc")[c].alias(c) for c in docs.columns])
