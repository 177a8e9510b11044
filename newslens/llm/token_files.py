"""Token files: frequency-ranked ids in one to four bytes, lengths in control bytes.

A file is a Parquet part of blocks in document order. A block holds whole documents: their ids and token counts, the
control bytes (two bits for each token: how many bytes it has, less one) and the data bytes (the token's rank, low byte
first). The commonest 256 ids take one byte. Ranks come from a count over all documents and are kept beside the blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newslens.llm import arrays
from newslens.llm.bpe import vocabulary
from newslens.llm.tokens import id_type, library_encode

#: Tokens of a block (more if one document has more) and of a file, about.
BLOCK_TOKENS, FILE_TOKENS = 1 << 18, 1 << 23
#: How many bytes each of the four tokens of a control byte has.
LENGTHS = np.array([[(control >> 2 * k & 3) + 1 for k in range(4)] for control in range(256)], np.int64)
COLUMNS = "shard int, block int, start long, n_tokens long, doc_ids array<long>, counts array<long>, control binary, data binary"


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of ranks under 2^32."""
    ranks = ranks.astype("<u4")
    lengths = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = lengths - 1
    control = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < lengths[:, None]].tobytes()


def unpack(control: bytes, data: bytes, size: int) -> np.ndarray:
    """The ranks again: lengths by table lookup, bytes put in their places."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:size]
    ranks = np.zeros((size, 4), np.uint8)
    ranks[np.arange(4) < lengths[:, None]] = np.frombuffer(data, np.uint8)
    return ranks.view("<u4").reshape(-1)


@dataclass(frozen=True)
class TokenFiles:
    """A written set of files: ``blocks`` and ``ranks`` (rank, token_id) below ``path``."""

    spark: SparkSession
    path: str

    def blocks(self) -> DataFrame:
        return self.spark.read.schema(COLUMNS).parquet(f"{self.path}/blocks")

    def ids_by_rank(self) -> np.ndarray:
        """Bounded by the vocabulary."""
        rows = self.spark.read.schema("rank int, token_id int").parquet(f"{self.path}/ranks").orderBy("rank").collect()
        return np.array([row.token_id for row in rows], np.uint32)

    def starts(self) -> DataFrame:
        """(shard, before): tokens in all earlier files; one row for each file."""
        totals = self.blocks().groupBy("shard").agg(F.sum("n_tokens").alias("n"))
        before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
        return totals.select("shard", F.coalesce(before, F.lit(0)).alias("before"))

    def _read(self, schema: str, emit) -> DataFrame:
        ids = self.ids_by_rank()

        def work(batch: pa.RecordBatch):
            for row in batch.to_pylist():
                tokens = ids[unpack(row["control"], row["data"], row["n_tokens"])]
                yield emit(row, tokens)

        return arrays.map_batches(self.blocks(), work, schema)

    def documents(self) -> DataFrame:
        """(doc_id, token_ids array<int>) read back."""

        def emit(row, tokens):
            offsets = np.concatenate([[0], np.cumsum(row["counts"])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens.astype(np.int32)))
            return pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), lists], ["doc_id", "token_ids"])

        return self._read("doc_id long, token_ids array<int>", emit)

    def digests(self) -> DataFrame:
        """(doc_id, start, n_tokens, ids_crc32) read back; the blocks are not shuffled, only these rows may be."""

        def emit(row, tokens):
            counts = np.array(row["counts"], np.int64)
            at = np.concatenate([[0], np.cumsum(counts)])
            spelled = memoryview(tokens.astype("<u4").tobytes())
            sums = [zlib.crc32(spelled[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array([row["shard"]] * len(counts), pa.int32()), pa.array(row["doc_ids"], pa.int64())]
                + [pa.array(x, pa.int64()) for x in (at[:-1] + row["start"], counts, sums)],
                ["shard", "doc_id", "at", "n_tokens", "ids_crc32"],
            )

        rows = self._read("shard int, doc_id long, at long, n_tokens long, ids_crc32 long", emit)
        start = (F.col("before") + F.col("at")).alias("start")
        return rows.join(self.starts(), "shard").select("doc_id", start, "n_tokens", "ids_crc32")


def _tokenised(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    def work(batch: pa.RecordBatch):
        texts, kind = arrays.column_texts(batch, "text"), id_type(path)
        for begin, end in arrays.blocks(texts):
            ids, counts = library_encode(path, texts[begin:end])
            whole = np.insert(ids, np.cumsum(counts), end_id).astype(kind)
            parts = np.split(whole, np.cumsum(counts + 1)[:-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(begin, end - begin), pa.array([p.tobytes() for p in parts])], ["doc_id", "ids"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrays.map_batches(rows, work, "doc_id long, ids binary", words=True)


def _counts(tokens: DataFrame, path: str) -> DataFrame:
    """(token_id, n): each task adds up what it reads, so at most a vocabulary a task is shuffled."""
    size, kind = vocabulary(path).size, id_type(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), kind)
            total += np.bincount(ids, minlength=size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], ["token_id", "n"])

    return tokens.select("ids").mapInArrow(run, "token_id int, n long").groupBy("token_id").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, vocabulary_path: str, path: str, end_id: int) -> TokenFiles:
    """Encode all texts, append ``end_id`` to each document, write files in ascending ``doc_id`` order.

    Null texts are empty (one token, the end); null ids come first; rows with the same id are ordered by their tokens and all kept. Other
    columns are not read. Texts are tokenised once, where they lie; then only packed ids are sorted by range of ids.
    No documents: files without blocks.
    """
    spark = docs.sparkSession
    tokens = arrays.written(_tokenised(docs, vocabulary_path, end_id), f"{path}/tokens")
    counted = {row.token_id: row.n for row in _counts(tokens, vocabulary_path).collect()}  # bounded by the vocabulary
    order = sorted(counted, key=lambda token: (-counted[token], token))
    ranks = spark.createDataFrame(list(enumerate(order)), "rank int, token_id int").coalesce(1)
    ranks.write.parquet(f"{path}/ranks")
    rank_of = np.zeros(vocabulary(vocabulary_path).size, np.uint32)
    rank_of[order] = np.arange(len(order))
    kind = id_type(vocabulary_path)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = start = size = 0
        doc_ids, held, shard = [], [], 0

        def flush() -> pa.RecordBatch:
            counts = [len(ids) // np.dtype(kind).itemsize for ids in held]
            control, data = pack(rank_of[np.frombuffer(b"".join(held), kind)])
            values = (shard, block, start, sum(counts), doc_ids, counts, control, data)
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary())
            names = [column.split()[0] for column in COLUMNS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

        for batch in batches:
            for doc_id, ids, at in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "shard")), strict=True):
                doc_ids.append(doc_id)
                held.append(ids)
                shard = at
                size += len(ids) // np.dtype(kind).itemsize
                if size >= BLOCK_TOKENS:
                    yield flush()
                    block, start, size, doc_ids, held = block + 1, start + size, 0, [], []
        if doc_ids:
            yield flush()

    files = max(1, -(-sum(counted.values()) // FILE_TOKENS))
    # a hash of the ids splits what one id has; the ids themselves would be sampled to the driver
    ordered = tokens.repartitionByRange(files, "doc_id", F.xxhash64("ids")).sortWithinPartitions("doc_id", "ids")
    made = ordered.withColumn("shard", F.spark_partition_id()).mapInArrow(blocks, COLUMNS)
    made.write.option("compression", "zstd").parquet(f"{path}/blocks")
    return TokenFiles(spark, path)
