"""Exact top-k inner products by Fagin's threshold algorithm over sorted lists of every dimension.

Candidates are dealt into blocks of bounded size. A task sorts a block's dimensions once and streams all queries past it: each query
reads its lists from the best end, in steps that double, scores what it meets, and stops when no unread vector can beat its k-th
result. Blocks give at most k rows a query, which are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1024
#: Vectors of a block, about: a block with its lists takes some 20 bytes for each component.
BLOCK_ROWS = 16_384
FIRST_STEP = 16
_SAFE = 2.0**52


def whole_numbers(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v array<long>): floor(1024 x) of every component; vectors that are null or hold null, NaN or infinity are left out."""
    vector = F.col(vector_column).cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(id_column).isNotNull() & vector.isNotNull() & sound)
    return rows.select(F.col(id_column).cast("long").alias("vec_id"), F.transform(vector, lambda x: F.floor(x * SCALE)).alias("v"))


class Block:
    """Vectors of one length with their ids, and for each dimension the order of its values."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.lists = np.argsort(self.vectors, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(self.vectors.T, self.lists, axis=1)
        top = float(np.abs(self.vectors.astype(np.float64)).max(initial=0))
        self.exact = top * top * max(1, vectors.shape[1]) < _SAFE
        self.floats = self.vectors.astype(np.float64) if self.exact else self.vectors

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores, vectors read) of the k best, ties to the smaller id; the query's own id is left out."""
        size, used = len(self.ids), np.flatnonzero(query)
        weight = query[used]
        exact = self.exact and float(np.abs(query.astype(np.float64)).max(initial=0)) ** 2 * len(query) < _SAFE
        vectors, factor = (self.floats, query.astype(np.float64)) if exact else (self.vectors, query)
        down = weight > 0
        seen = np.zeros(size, bool)
        best_at, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step = 0, FIRST_STEP
        while depth < size:
            stop = min(size, depth + step)
            if len(used):
                ups = self.lists[used[~down], depth:stop]
                downs = self.lists[used[down], size - stop : size - depth]
                met = np.concatenate([ups.reshape(-1), downs.reshape(-1)])
                fresh = np.zeros(size, bool)
                fresh[met] = True
                fresh &= ~seen
            else:
                stop, fresh = size, np.ones(size, bool)
            at = np.flatnonzero(fresh)
            seen |= fresh
            at = at[self.ids[at] != query_id]
            scores = (vectors[at] @ factor).astype(np.int64)
            best_at, best = np.concatenate([best_at, at]), np.concatenate([best, scores])
            if len(best) > k:
                line = np.partition(best, len(best) - k)[len(best) - k]
                near = best >= line
                best_at, best = best_at[near], best[near]
                order = np.lexsort((self.ids[best_at], -best))[:k]
                best_at, best = best_at[order], best[order]
            depth, step = stop, 2 * step
            if depth < size and len(best) == k:
                next_values = np.where(down, self.values[used, size - 1 - depth], self.values[used, depth])
                if int((next_values * weight).sum()) < int(best.min()):
                    break
        return self.ids[best_at], best, int(seen.sum())


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best (all, if fewer). Both inputs: (vec_id, v array<long>).

    Ties go to the smaller id; vectors of another length than the query's are not compared; the row with the query's own id is not among
    its results. Repeated candidate rows are each a result; repeated query rows count once. Scores must fit in 64 bits.
    """
    count = vectors.count()
    blocks = max(1, -(-count // block_rows))
    kind = lambda n: F.lit(n).alias("kind")
    deal = F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).alias("block")
    candidates = vectors.select(deal, kind(0), "vec_id", "v")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    asked = queries.dropDuplicates(["vec_id", "v"]).select(every, kind(1), "vec_id", "v")
    dealt = candidates.unionByName(asked).repartition(blocks, "block").sortWithinPartitions("block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, index = None, [], {}

        def build() -> dict[int, Block]:
            made = {}
            for size in {len(v) for _, v in held}:
                own = [(i, v) for i, v in held if len(v) == size]
                made[size] = Block(np.array([i for i, _ in own]), np.array([v for _, v in own], np.int64).reshape(len(own), size))
            return made

        for batch in batches:
            found = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("block", "kind", "vec_id")), batch.column("v"), strict=True)
            for block, kind_, vec_id, v in rows:
                vector = v.values.to_numpy(zero_copy_only=False) if len(v.values) else np.zeros(0, np.int64)
                if block != current:
                    current, held, index = block, [], {}
                if kind_ == 0:
                    held.append((vec_id, vector))
                    continue
                if not index:
                    index, held = build(), []
                if len(vector) in index:
                    ids, scores, _ = index[len(vector)].search(vec_id, vector, k)
                    found.append((np.full(len(ids), vec_id), ids, scores))
            if found:
                columns = [pa.array(np.concatenate(part).astype(np.int64)) for part in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    parts = dealt.mapInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).alias("rank")
    return parts.select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)
