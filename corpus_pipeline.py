"""Cleaning a corpus: each stage is written as Parquet and read again as the next one's documents.

A stage works on all documents that the one before has kept and returns the columns of documents, the last one the places
of all pieces in training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.llm import line_dedup, near_dups, packing, quality, repeats
from newslens.llm.queries import PIECES, VOCABULARY
from newslens.session import apply_session_conf, ship_package, working_path

#: Lines of so many documents stay only where they occur first.
COMMON_LINE_DOCS = 10


def _start(spark: SparkSession, name: str) -> str:
    apply_session_conf(spark)
    ship_package(spark)
    return working_path(spark, name)


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    judged = quality.quality(docs, VOCABULARY, PIECES, _start(spark, "quality"), docs.columns)
    return judged.where("kept").select(*[F.col("doc")[c].alias(c) for c in docs.columns])


def common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; lines that many of them have stay in the first one only."""
    bitmaps = line_dedup.keep_bitmaps(docs, _start(spark, "line-dedup"), COMMON_LINE_DOCS)
    return _counted(line_dedup.deduplicated(docs, bitmaps))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dups.one_of_each(docs, near_dups.classes(docs, _start(spark, "near-dups")))


def long_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without bytes of strings that are found elsewhere too."""
    return _counted(repeats.without_repeats(docs, repeats.repeated_spans(docs, _start(spark, "repeats"))))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences of 1,024 tokens."""
    _, places = packing.pack(docs, VOCABULARY, _start(spark, "packing"), end_id=2)
    return places.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality", quality_rules),
    ("lines", common_lines),
    ("near_duplicates", near_duplicates),
    ("repeats", long_repeats),
    ("packing", packed),
]

#: No SQL twin: tokenisers, sketches and packing have none. The stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the last one's rows are left to Spark."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            path = working_path(spark, f"stage-{name}")
            made.write.parquet(path)
            made = spark.read.parquet(path)
        docs = made
    return docs
