"""Parquet tables that are replaced as a whole or by partition.

A table must not be overwritten while it is read, so a replacement is written beside it as the next version. Spark's
``_SUCCESS`` marker, written when the job commits, makes a version visible: a run that dies leaves the old one current.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newslens.session import working_path

VERSION = "version="


def _filesystem(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _filesystem(spark, path)
    return fs.exists(hadoop)


def _versions(spark: SparkSession, path: str, committed: bool) -> list[int]:
    fs, root = _filesystem(spark, path)
    if not fs.exists(root):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(root)]
    numbers = [int(name[len(VERSION) :]) for name in names if name.startswith(VERSION)]
    return sorted(n for n in numbers if not committed or path_exists(spark, f"{path}/{VERSION}{n}/_SUCCESS"))


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Write the next version of the table at ``path``; it is current once the write has committed."""
    number = max(_versions(df.sparkSession, path, committed=False), default=0) + 1
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/{VERSION}{number}")
    return number


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as last committed, or None before the first version."""
    numbers = _versions(spark, path, committed=True)
    return spark.read.parquet(f"{path}/{VERSION}{numbers[-1]}") if numbers else None


def rebuild(df: DataFrame, path: str) -> DataFrame:
    """Replace a report by a new version and read it back."""
    publish(df, path)
    return current(df.sparkSession, path)


def truncate_reload(spark: SparkSession, path: str, repair) -> DataFrame:
    """Replace a table by ``repair(table)``, e.g. one of the dedup operators."""
    return rebuild(repair(current(spark, path)), path)


def overwrite_partition(df: DataFrame, path: str, partition: str, value: object) -> None:
    """Replace one partition directory, also by nothing: dynamic overwrite would leave it when ``df`` is empty."""
    df.drop(partition).write.mode("overwrite").parquet(f"{path}/{partition}={value}")


def overwrite_touched(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace the partitions that ``df`` has rows for and leave the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def merge_touched(
    source: DataFrame, path: str, partition: str, merge: Callable[[DataFrame, DataFrame], DataFrame]
) -> None:
    """Merge rows into a table partitioned by a column of the merge key, such as the day of a mart.

    Only the partitions the source has rows for are read and rewritten; the table keeps all its columns, and a source with others is
    refused. Source and merged rows are written to the shared folder first: the source is evaluated once, and no partition is
    replaced before its new rows are complete. Distinct partition values come to the driver, never rows.
    """
    spark = source.sparkSession
    staged = written_once(source)
    values = [row[0] for row in staged.select(partition).distinct().collect()]
    if not values:
        return
    if path_exists(spark, path):
        target = spark.read.parquet(path)
        unknown = set(source.columns) - set(target.columns)
        if unknown:
            raise ValueError(f"the table has no column {sorted(unknown)}")
        touched = target.where(F.col(partition).isin(*values))
        staged = written_once(merge(touched, staged).select(*target.columns))
    overwrite_touched(staged, path, [partition])


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    """A table without rows that Spark knows to be empty: a list of none would be read by a Python worker in every task, and joined."""
    fields = StructType.fromDDL(ddl).fields
    columns = ", ".join(f"CAST(NULL AS {field.dataType.simpleString()}) AS `{field.name}`" for field in fields)
    return spark.sql(f"SELECT {columns} WHERE false")


def written_once(df: DataFrame) -> DataFrame:
    """Rows from a table in the shared folder: what is used several times is evaluated once, and lost executors cost nothing of it."""
    staging = working_path(df.sparkSession, "staged")
    df.write.parquet(staging)
    return df.sparkSession.read.schema(df.schema).parquet(staging)


def replace_model_partitions(scored: DataFrame, path: str, retired: list[str]) -> None:
    """On a sentiment table partitioned by model: replace every model that ``scored`` has rows of, empty the retired ones."""
    spark = scored.sparkSession
    staged = written_once(scored)
    models = {row[0] for row in staged.select("model_name").distinct().collect()}
    if models:
        overwrite_touched(staged, path, ["model_name"])
    for name in retired:
        if name not in models and path_exists(spark, f"{path}/model_name={name}"):
            overwrite_partition(staged.limit(0), path, "model_name", name)


def remove_old_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the newest committed versions of a published table."""
    for number in _versions(spark, path, committed=True)[: -max(1, keep)]:
        fs, hadoop = _filesystem(spark, f"{path}/{VERSION}{number}")
        fs.delete(hadoop, True)
