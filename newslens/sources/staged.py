"""Staged files: JSON lines or documents, CSV with quotes and one header row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for null in staged CSV files.
CSV_NULLS = ("", "NULL", "null")


def read_staged_json(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_staged_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV columns in the given types; three texts mean null. Read as text first, since ``nullValue`` takes only one."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    texts = T.StructType([T.StructField(field.name, T.StringType()) for field in wanted])
    raw = spark.read.schema(texts).option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return raw.select(
        *[
            F.when(~F.col(f.name).isin(*CSV_NULLS), F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in wanted.fields
        ]
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed response or feed files, one row per file: (path, body). Each is one response, so it is small."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("body"))
