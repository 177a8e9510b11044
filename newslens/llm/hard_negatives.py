"""Hard negatives by anchor-clustered shared lists, after MAXIMUS (Abuzaid et al. 2019).

Anchors are clustered by direction. For a cluster with centre c whose members lie within the angle s of it, no member a has an inner product with x above
|a| |x| cos(max(0, angle(x, c) - s)). Candidates are dealt into blocks of bounded size; a block's candidates are sorted by that bound once for each cluster, and
every member walks this shared list from its head until the bound times |a| is below all that it still needs: what follows is certified to be
of no use. A walk for positives needs its k-th best score, a walk for negatives the k-th best below each positive, or the lowest
score that may count at all. Blocks give a few rows an anchor, which are merged.

Positives are searched only in blocks of the anchor's label, negatives in blocks of all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.llm import arrays

#: Rows of a block, at most about; a table with fewer than one block for each shuffle partition is dealt into smaller ones.
BLOCK_ROWS, LEAST_BLOCK_ROWS = 65_536, 2_048
#: The clustering is fitted on so many anchors at most; every anchor is then assigned. It decides speed only, never rows.
SAMPLE, CLUSTERS, MEMBERS = 2_048, 64, 16
#: Anchors that walk together, and rows of a list's first step.
TOGETHER, FIRST_STEP = 256, 512
_SAFE = 2.0**52
_SLACK = 1e-7  # of the product of the norms; angles are known to some 1e-8


def whole_numbers(vectors: DataFrame, scale: int, id_column: str, vector_column: str, label: Column) -> DataFrame:
    """(vec_id, label, v array<long>): floor(scale x) of every component.

    Rows with a null label, a null vector or a null, NaN or infinite component are left out; a null id stays. Other columns are not read.
    """
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(label.isNotNull() & vector.isNotNull() & sound)
    v = F.transform(vector, lambda x: F.floor(x * scale)).alias("v")
    return rows.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), label.cast("long").alias("label"), v)


# --- clusters of anchors -------------------------------------------------------------------------------------------------------


def _units(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1)
    return vectors / np.where(norms > 0, norms, 1.0)[:, None]


def centres(vectors: np.ndarray, count: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means from the first ``count`` different rows on."""
    units = _units(vectors.astype(np.float64))
    _, first = np.unique(units, axis=0, return_index=True)
    found = units[np.sort(first)[:count]]
    for _ in range(rounds):
        nearest = np.argmax(units @ found.T, axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, units)
        found = np.where(np.linalg.norm(sums, axis=1)[:, None] > 0, _units(sums), found)
    return found


def clustered(anchors: DataFrame) -> DataFrame:
    """``anchors`` with ``cluster``: the nearest of at most CLUSTERS centres, 0 for vectors of another length than most of the sample's."""
    rows = anchors.orderBy("own").select("v").limit(SAMPLE).collect()
    sizes = [len(r.v) for r in rows if len(r.v)]
    size = max(set(sizes), key=sizes.count, default=0)
    own = np.array([r.v for r in rows if len(r.v) == size], np.float64)
    found = centres(own, max(1, min(CLUSTERS, len(own) // MEMBERS))) if size else None

    def assign(batch: pa.RecordBatch) -> pa.RecordBatch:
        nearest = np.zeros(batch.num_rows, np.int32)
        if found is not None:
            lists = batch.column("v")
            fit = np.flatnonzero(np.diff(lists.offsets.to_numpy()) == size)
            if len(fit):
                values = lists.take(pa.array(fit)).flatten().to_numpy().reshape(-1, size)
                nearest[fit] = np.argmax(_units(values.astype(np.float64)) @ found.T, axis=1)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest)], [*batch.schema.names, "cluster"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema)
    return arrays.map_batches(anchors, assign, f"{schema}, cluster int")


# --- the walk ------------------------------------------------------------------------------------------------------------------


class Block:
    """Candidates of one length: ids (``no_id`` where null), labels, vectors."""

    def __init__(self, ids: np.ndarray, no_id: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.no_id, self.labels = ids, no_id, labels
        floats = vectors.astype(np.float64)
        self.top = float(np.abs(floats).max(initial=0))
        self.norms = np.linalg.norm(floats, axis=1)
        self.units = floats / np.where(self.norms > 0, self.norms, 1.0)[:, None]
        self.whole = vectors.astype(np.int64)
        self.floats = floats if self.top * self.top * max(1, vectors.shape[1]) < _SAFE else None
        self.read = 0  # scores worked out so far

    def listed(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shared list of a cluster: all rows by falling bound, and the bounds (for members of norm 1)."""
        units = _units(members[np.abs(members).max(axis=1, initial=0) > 0].astype(np.float64))
        centre = _units(units.sum(axis=0)[None])[0] if len(units) else np.zeros(members.shape[1])
        spread = float(np.arccos(np.clip(units @ centre, -1, 1)).max(initial=0))
        angle = np.arccos(np.clip(self.units @ centre, -1, 1))
        bounds = self.norms * np.cos(np.maximum(0, angle - spread))
        order = np.argsort(-bounds, kind="stable")
        return order, bounds[order]

    def scores(self, members: np.ndarray, at: np.ndarray) -> np.ndarray:
        self.read += len(members) * len(at)
        top = float(np.abs(members.astype(np.float64)).max(initial=0))
        if self.floats is not None and top * self.top * max(1, members.shape[1]) < _SAFE:
            return (members.astype(np.float64) @ self.floats[at].T).astype(np.int64)
        return members.astype(np.int64) @ self.whole[at].T

    def best(self, at: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The first k by score, then id, null ids last."""
        order = np.lexsort((self.ids[at], self.no_id[at], -scores))[:k]
        return at[order], scores[order]


@dataclass
class Need:
    """The first k rows with low <= score <= high; ``low`` rises to the k-th score found."""

    low: int
    high: int
    at: np.ndarray
    scores: np.ndarray

    @classmethod
    def between(cls, low: int, high: int) -> "Need":
        return cls(low, high, np.zeros(0, np.int64), np.zeros(0, np.int64))

    def take(self, block: Block, at: np.ndarray, scores: np.ndarray, k: int) -> None:
        fit = np.flatnonzero((scores >= self.low) & (scores <= self.high))
        if len(fit):
            both = np.concatenate([self.at, at[fit]]), np.concatenate([self.scores, scores[fit]])
            self.at, self.scores = block.best(*both, k)
            if len(self.at) == k:
                self.low = int(self.scores[-1])


LOWEST, HIGHEST = -(2**62), 2**62


def walk(block: Block, ids: np.ndarray, labels: np.ndarray, members: np.ndarray, needs: list[list[Need]], same_label: bool, k: int) -> None:
    """Fill the needs of all members of one cluster (anchors' ids, labels and vectors) from the block's shared list."""
    order, bounds = block.listed(members)
    norms = np.linalg.norm(members.astype(np.float64), axis=1)
    slack = _SLACK * float(block.norms.max(initial=0)) + 1e-9
    for begin in range(0, len(members), TOGETHER):
        active = np.arange(begin, min(begin + TOGETHER, len(members)))
        depth, step = 0, FIRST_STEP
        while depth < len(order) and len(active):
            low = np.array([min((need.low for need in needs[m]), default=HIGHEST) for m in active], np.float64)
            active = active[norms[active] * (bounds[depth] + slack) + 1e-6 >= low]  # the others are certified
            if not len(active):
                break
            at = order[depth : depth + step]
            scores = block.scores(members[active], at)
            for row, m in zip(scores, active.tolist(), strict=True):
                fit = ((block.labels[at] == labels[m]) == same_label) & ((block.ids[at] != ids[m]) | block.no_id[at])
                fit &= row >= min((need.low for need in needs[m]), default=HIGHEST)
                near = np.flatnonzero(fit)
                if len(near):
                    for need in needs[m]:
                        need.take(block, at[near], row[near], k)
            depth, step = depth + step, 2 * step


# --- blocks on Spark -----------------------------------------------------------------------------------------------------------

_DEALT = ("block", "size", "kind", "cluster", "vec_id", "label", "own", "v", "asked")


def _searched(
    candidates: DataFrame, anchors: DataFrame, parts: int, same_label: bool, k: int, needs: Callable[[list[int] | None], list[Need]],
) -> DataFrame:
    """(anchor_id, own, place, vec_id, score): what each block finds for each need of each anchor sent to it.

    ``candidates``: (block, vec_id, label, v); ``anchors``: (block, cluster, vec_id, label, own, v, asked). ``asked`` is handed to ``needs``.
    """
    rows = candidates.select("block", "vec_id", "label", "v", F.lit(0).alias("kind"), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("own"))
    rows = rows.withColumn("asked", F.lit(None).cast("array<long>"))
    rows = rows.unionByName(anchors.withColumn("kind", F.lit(1))).withColumn("size", F.size("v")).select(*_DEALT)
    dealt = rows.repartition(parts, "block").sortWithinPartitions("block", "size", "kind", "cluster")

    def matrix(batches: list[pa.RecordBatch], size: int) -> np.ndarray:
        return np.concatenate([b.column("v").flatten().to_numpy() for b in batches]).reshape(-1, size) if size else np.zeros((sum(b.num_rows for b in batches), 0), np.int64)

    def column(batches: list[pa.RecordBatch], name: str) -> np.ndarray:
        return np.concatenate([b.column(name).fill_null(0).to_numpy() for b in batches])

    def answered(block: Block, held: list[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
        ids, labels, own = (column(held, c) for c in ("vec_id", "label", "own"))
        wanted = [needs(a) for b in held for a in b.column("asked").to_pylist()]
        walk(block, ids, labels, matrix(held, size), wanted, same_label, k)
        found = [(m, place, need) for m, own_needs in enumerate(wanted) for place, need in enumerate(own_needs) if len(need.at)]
        if found:
            counts = np.array([len(need.at) for _, _, need in found])
            m = np.repeat([f[0] for f in found], counts)
            at = np.concatenate([need.at for _, _, need in found])
            columns = [pa.array(ids[m]), pa.array(own[m]), pa.array(np.repeat([f[1] for f in found], counts).astype(np.int32))]
            columns += [pa.array(block.ids[at], mask=block.no_id[at]), pa.array(np.concatenate([need.scores for _, _, need in found]))]
            yield pa.RecordBatch.from_arrays(columns, ["anchor_id", "own", "place", "vec_id", "score"])

    def closed(group: tuple, held: list[pa.RecordBatch], block: Block | None) -> tuple[Block | None, list[pa.RecordBatch]]:
        """What the rows of one (block, size, kind, cluster) give: a block of candidates, or a cluster's answers."""
        _, size, kind, _ = group
        if kind == 0:
            no_id = np.concatenate([b.column("vec_id").is_null().to_numpy(zero_copy_only=False) for b in held])
            return Block(column(held, "vec_id"), no_id, column(held, "label"), matrix(held, size)), []
        return block, list(answered(block, held, size)) if block else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, block, block_of = None, [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("block", "size", "kind", "cluster")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                now = tuple(keys[begin].tolist())
                if now != group:
                    if group is not None:
                        block, made = closed(group, held, block)
                        yield from made
                    if now[:2] != block_of:  # a block without candidates has no answers
                        block = None if group is None or group[:2] != now[:2] else block
                        block_of = now[:2]
                    group, held = now, []
                held.append(batch.slice(begin, end - begin))
        if group is not None:
            yield from closed(group, held, block)[1]

    return dealt.mapInArrow(run, "anchor_id long, own long, place int, vec_id long, score long")


def _first(rows: DataFrame, k: int) -> DataFrame:
    """The first k of each need, with ``rank``."""
    order = Window.partitionBy("anchor_id", "own", "place").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, is_anchor: Column, path: str, positives: int = 5, negatives: int = 5, percent: int = 80, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (vec_id, label, v array<long>).

    A row's score is its inner product with the anchor. An anchor's positives are the best other rows of its label. For each positive come the
    best rows of other labels with percent * positive_score <= 100 * score <= 100 * positive_score, ranked from 1. Ties go to the
    smaller id, null ids last. Rows with the anchor's id are never its results; repeated candidate rows are a result each, repeated anchor
    rows count once. A null ``is_anchor`` is no anchor. Vectors of other lengths are not compared. Fewer are returned where there are fewer;
    an empty table gives none. Scores must fit in 62 bits. ``path``: folder in the shared storage.
    """
    spark = vectors.sparkSession
    rows = arrays.written(vectors.select("vec_id", "label", "v"), f"{path}/vectors")
    largest = F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v")))
    count, top = rows.agg(F.count(F.lit(1)), F.max(largest)).first()
    kind = "smallint" if (top or 0) < 2**15 else "int" if top < 2**31 else "long"
    rows = rows.withColumn("v", F.col("v").cast(f"array<{kind}>"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-count // block_rows), min(partitions, count // min(block_rows, LEAST_BLOCK_ROWS)))
    own = F.xxhash64("vec_id", "label", "v").alias("own")
    anchors = clustered(rows.where(F.coalesce(is_anchor, F.lit(False)) & F.col("vec_id").isNotNull()).select("vec_id", "label", own, "v").dropDuplicates())
    anchors = arrays.written(anchors, f"{path}/anchors")

    # positives: a label's rows are dealt into slices, and its anchors go to each of them
    rows_a_block = -(-count // blocks) if count else 1
    slices = rows.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / rows_a_block).alias("slices"))
    spread = F.xxhash64("vec_id", "v")
    sliced = rows.join(slices, "label").withColumn("block", F.xxhash64("label", F.pmod(spread, F.col("slices"))))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))
    sent = anchors.join(slices, "label").withColumn("slice", every).withColumn("block", F.xxhash64("label", "slice"))
    sent = sent.withColumn("asked", F.lit(None).cast("array<long>")).drop("slice", "slices")
    found = _searched(sliced.drop("slices"), sent, blocks, True, positives, lambda _: [Need.between(LOWEST, HIGHEST)])
    chosen = arrays.written(_first(found, positives).select("anchor_id", "own", "rank", "vec_id", "score"), f"{path}/positives")

    # negatives: to all blocks goes who has a positive that can have any
    asked = chosen.groupBy("anchor_id", "own").agg(F.array_sort(F.collect_set("score")).alias("asked"))
    asked = asked.withColumn("asked", F.filter("asked", lambda s: s >= 0)).where(F.size("asked") > 0)
    asking = anchors.join(asked.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "own"])
    asking = asking.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    dealt = rows.withColumn("block", F.pmod(spread, F.lit(blocks)))

    def windows(scores: list[int] | None) -> list[Need]:
        return [Need.between(-(-percent * s // 100), s) for s in scores or []]

    near = _first(_searched(dealt, asking, blocks, False, negatives, windows), negatives)
    near = near.join(asked, ["anchor_id", "own"]).withColumn("positive_score", F.get("asked", "place"))
    near = near.select("anchor_id", "own", "positive_score", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = chosen.select("anchor_id", "own", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return pairs.join(near, ["anchor_id", "own", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
