"""A partitioned log of messages in shared storage, and a streaming source that reads it.

What a topic gives the realtime path where there is no broker: messages (key, value, timestamp) lie in partitions by their key, in an order, and
each has an offset. ``append`` writes them as Parquet with Spark; a batch becomes part of the log at once, by one small manifest that is renamed into
place and lists its files with their first offsets. ``EventLog`` is a Python data source: a micro-batch is a range of offsets of every partition, each file
range is a task, and Spark's checkpoint holds the offsets, so a restart goes on where the last batch ended.

Options of the source: ``path``; ``startingOffsets``: ``earliest``, ``latest`` (default) or JSON of partition to offset; ``maxOffsetsPerTrigger``: the most
messages of a micro-batch, which needs ``reader``: a name under which the position is kept beside the log, as Spark does not tell a source where it stands.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from newslens.session import working_path

FORMAT = "event_log"
SCHEMA = "key string, value binary, partition int, offset long, timestamp timestamp"
PARTITIONS = 3
#: Messages and bytes of files that a task reads at most, and messages that it holds at a time.
TASK_ROWS, TASK_BYTES, HELD_ROWS = 250_000, 32 << 20, 1_000
#: Bytes of a row group: what a task skips or reads as a whole.
GROUP_BYTES = 16 << 20


class _Files:
    """The log's folder, by any path that Spark takes and Arrow knows."""

    def __init__(self, path: str):
        local = path.removeprefix("file://") if path.startswith("file://") else path.removeprefix("file:")
        if "://" in local:
            self.system, self.root = pyarrow.fs.FileSystem.from_uri(local)
        else:
            self.system, self.root = pyarrow.fs.LocalFileSystem(), local

    def names(self, folder: str) -> list[str]:
        chosen = pyarrow.fs.FileSelector(f"{self.root}/{folder}", allow_not_found=True)
        return sorted(f.base_name for f in self.system.get_file_info(chosen) if f.base_name.endswith(".json"))

    def read(self, name: str):
        with self.system.open_input_stream(f"{self.root}/{name}") as file:
            return json.loads(file.read())

    def write(self, name: str, value) -> None:
        """Whole or not at all: written aside, then renamed."""
        folder, _, base = f"{self.root}/{name}".rpartition("/")
        self.system.create_dir(folder, recursive=True)
        with self.system.open_output_stream(f"{folder}/.{base}") as file:
            file.write(json.dumps(value).encode())
        self.system.move(f"{folder}/.{base}", f"{folder}/{base}")

    def exists(self, name: str) -> bool:
        return self.system.get_file_info(f"{self.root}/{name}").type == pyarrow.fs.FileType.File


def append(messages: DataFrame, path: str, partitions: int = PARTITIONS) -> dict[int, int]:
    """Add messages (key, value[, timestamp]) to the log, each key in one partition; the new end of each partition. One writer at a time.

    Messages without key are spread by their value. Only the files' names and counts come to the driver.
    """
    spark, files = messages.sparkSession, _Files(path)
    known = files.names("manifests")
    last = files.read(f"manifests/{known[-1]}") if known else {"ends": {str(p): 0 for p in range(partitions)}}
    partitions = len(last["ends"])
    stamp = F.col("timestamp").cast("timestamp") if "timestamp" in messages.columns else F.current_timestamp()
    rows = messages.select(F.col("key").cast("string").alias("key"), F.col("value").cast("binary").alias("value"), stamp.alias("timestamp"))
    rows = rows.withColumn("partition", F.pmod(F.xxhash64(F.coalesce("key", F.col("value").cast("string"))), F.lit(partitions)).cast("int"))
    folder = working_path(spark, "segments").rpartition("/")[2]
    # files of even size; a partition that holds most messages becomes several files
    rows.hint("rebalance", "partition").write.option("parquet.block.size", GROUP_BYTES).partitionBy("partition").parquet(f"{path}/data/{folder}")
    written = spark.read.schema("key string, value binary, timestamp timestamp, partition int").parquet(f"{path}/data/{folder}")
    file = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")]
    counted = written.groupBy("partition", *file).agg(F.count(F.lit(1)).alias("n"))
    ends, listed = dict(last["ends"]), []
    for row in counted.orderBy("partition", "file").collect():
        name = row["file"].rpartition("/data/")[2]
        listed.append({"partition": row["partition"], "file": f"data/{name}", "first": ends[str(row["partition"])], "count": row["n"], "bytes": row["bytes"]})
        ends[str(row["partition"])] += row["n"]
    files.write(f"manifests/{len(known):012d}.json", {"ends": ends, "files": listed})
    return {int(p): end for p, end in ends.items()}


@dataclass
class Segment(InputPartition):
    """Rows [begin, end) of a file, whose first row has the offset ``first``."""

    file: str
    partition: int
    first: int
    begin: int
    end: int


class EventLogReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        options = {name.lower(): value for name, value in options.items()}
        self.files = _Files(options["path"])
        self.starting = options.get("startingoffsets", "latest")
        self.most = int(options["maxoffsetspertrigger"]) if options.get("maxoffsetspertrigger") else None
        self.position = f"readers/{options['reader']}.json" if options.get("reader") else None
        if self.most and not self.position:
            raise ValueError("maxOffsetsPerTrigger needs the option reader")
        self.at: dict[str, int] | None = None
        self.manifests: list[dict] = []

    def _log(self) -> list[dict]:
        """All manifests; those that have been read are kept."""
        for name in self.files.names("manifests")[len(self.manifests) :]:
            self.manifests.append(self.files.read(f"manifests/{name}"))
        return self.manifests

    def _ends(self) -> dict[str, int]:
        log = self._log()
        return dict(log[-1]["ends"]) if log else {}

    def initialOffset(self) -> dict:
        ends = self._ends()
        if self.starting == "latest":
            start = ends
        elif self.starting == "earliest":
            start = dict.fromkeys(ends, 0)
        else:
            given = json.loads(self.starting)
            start = {p: min(end, int(given.get(p, 0))) for p, end in ends.items()}
        self._stand(start)
        return start

    def _stand(self, at: dict[str, int]) -> None:
        self.at = dict(at)
        if self.position:
            self.files.write(self.position, self.at)

    def latestOffset(self) -> dict:
        if self.most is None:
            return self._ends()
        if self.at is None and self.position and self.files.exists(self.position):
            self.at = self.files.read(self.position)  # restarted: the last planned batch ended here
        if self.at is None:  # Spark asks for the end of a first batch before its beginning
            self.initialOffset()
        ends = self._ends()
        # the cap is shared by need: no partition waits while another has everything
        left, granted = self.most, {}
        waiting = sorted((end - self.at.get(p, 0), p) for p, end in ends.items())
        for k, (need, p) in enumerate(waiting):
            share = min(need, max(0, left) // (len(waiting) - k) if left >= len(waiting) - k else min(1, left))
            granted[p], left = self.at.get(p, 0) + share, left - share
        return granted

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self._stand(end)
        made = []
        for manifest in self._log():
            for entry in manifest["files"]:
                p, first, count = str(entry["partition"]), entry["first"], entry["count"]
                low, high = max(start.get(p, 0), first), min(end.get(p, 0), first + count)
                rows = min(TASK_ROWS, max(1, count * TASK_BYTES // max(1, entry.get("bytes", 0))))
                for at in range(low, high, rows):
                    made.append(Segment(entry["file"], entry["partition"], first, at - first, min(at + rows, high) - first))
        return made

    def read(self, partition: Segment):
        import pyarrow as pa

        with self.files.system.open_input_file(f"{self.files.root}/{partition.file}") as file:
            # a stretch at a time: whole columns of a file in every worker would be most of an executor's memory
            parquet = pyarrow.parquet.ParquetFile(file, buffer_size=1 << 20, pre_buffer=False)
            sizes = [parquet.metadata.row_group(k).num_rows for k in range(parquet.num_row_groups)]
            begins = [sum(sizes[:k]) for k in range(len(sizes))]
            groups = [k for k, at in enumerate(begins) if at < partition.end and at + sizes[k] > partition.begin]
            at = begins[groups[0]] if groups else 0
            for batch in parquet.iter_batches(HELD_ROWS, groups, ["key", "value", "timestamp"]):
                low, high = max(partition.begin, at), min(partition.end, at + batch.num_rows)
                if low < high:
                    own = batch.slice(low - at, high - low)
                    offsets = pa.array(range(partition.first + low, partition.first + high), pa.int64())
                    number = pa.array([partition.partition] * (high - low), pa.int32())
                    stamp = own.column("timestamp").cast(pa.timestamp("us", "UTC"))
                    columns = [own.column("key"), own.column("value").cast(pa.binary()), number, offsets, stamp]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "value", "partition", "offset", "timestamp"])
                at += batch.num_rows
                if at >= partition.end:
                    break

    def commit(self, end: dict) -> None:
        """Nothing to give back: the log keeps its messages, and the checkpoint the offsets."""


class EventLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return EventLogReader(dict(self.options))


def log_stream(
    spark: SparkSession, path: str, starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None, reader: str | None = None
) -> DataFrame:
    """Messages of the log as a stream (key, value, partition, offset, timestamp), for ``parse_envelope``."""
    spark.dataSource.register(EventLog)
    source = spark.readStream.format(FORMAT).option("path", path).option("startingOffsets", starting_offsets)
    if max_offsets_per_trigger:
        source = source.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return (source.option("reader", reader) if reader else source).load()
