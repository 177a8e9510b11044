"""Marts from partial aggregates that are stored and merged: coarser grains come from finer ones, later rows are added to earlier ones.

Means of means are wrong and distinct counts do not add up, so a partial row holds what does merge: the sum of scores as a decimal, their number, and the set of its
articles as a bitmap. An article's bit is its place among the articles of the minute in which it was first seen (its home), so a minute's articles lie side by side and
their bitmap is as long as the minute has articles, an eighth of a byte each. Sets of one home and chunk are merged by OR, sets of different ones are disjoint and add up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newslens.functions.clock import time_bucket
from newslens.sources.tables import empty, path_exists, written_once

PARTS = 4096  # a home is numbered in as many parts in parallel, so one that holds a third of all articles is no hot spot
BATCH, DAY = "added_batch", "bucket_date"
NUMBERS_DDL = "url_hash string, home timestamp_ntz, place bigint"
PARTIALS_DDL = (
    "bucket timestamp_ntz, company_id bigint, home timestamp_ntz, chunk bigint, score_sum decimal(38,12), score_count bigint, url_bits binary"
)


def number_articles(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(url_hash, home, place) of the articles of ``rows`` that ``known`` lacks: places in a home go on after the known ones, from 1, without gaps.

    Articles without url_hash get none; one without a time is at home in the null minute. The same rows always give the same numbers.
    """
    seen = rows.where(F.col("url_hash").isNotNull()).groupBy("url_hash").agg(F.min("published_at_ts").alias("first"))
    if known is not None:
        seen = seen.join(known.select("url_hash"), "url_hash", "left_anti")
    parted = seen.select(
        "url_hash", time_bucket(F.col("first"), "minute").alias("home"), F.pmod(F.xxhash64("url_hash"), F.lit(PARTS)).alias("part")
    )
    sizes = parted.groupBy("home", "part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("home").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("home", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("shift"))
    if known is not None:
        last = known.groupBy(F.col("home").alias("known_home")).agg(F.max("place").alias("last"))
        shifts = shifts.join(last, F.col("home").eqNullSafe(F.col("known_home")), "left").select(
            "home", "part", (F.col("shift") + F.coalesce("last", F.lit(0))).alias("shift")
        )
    within = Window.partitionBy("home", "part").orderBy("url_hash")
    numbered = parted.withColumn("nth", F.row_number().over(within)).alias("n")
    same = F.col("n.home").eqNullSafe(F.col("s.home")) & (F.col("n.part") == F.col("s.part"))
    return numbered.join(shifts.alias("s"), same).select(
        F.col("n.url_hash"), F.col("n.home"), (F.col("s.shift") + F.col("n.nth")).cast("bigint").alias("place")
    )


def _trimmed(bits: Column, size: Column) -> Column:
    """The first bytes of a bitmap: Spark's own are always 4,096 long."""
    return F.substring(bits, F.lit(1), F.coalesce(size, F.lit(0)).cast("int"))


def partials(matched: DataFrame, numbers: DataFrame, unit: str = "minute", per_alias_hit: bool = False) -> DataFrame:
    """(bucket, company_id, home, chunk): sum and number of scores and the bitmap of articles.

    ``matched`` and ``per_alias_hit`` are those of ``bucket_mart``. ``numbers`` must hold every url_hash of the rows; rows without one count for the mean only.
    """
    rows = matched.select(
        time_bucket(F.col("published_at_ts"), unit).alias("bucket"), "company_id", "event_id", "url_hash", "sentiment_score"
    )
    if not per_alias_hit:
        rows = rows.groupBy("bucket", "company_id", "event_id").agg(
            F.min("url_hash").alias("url_hash"), F.max("sentiment_score").alias("sentiment_score")
        )
    placed = rows.join(numbers, "url_hash", "left").select(
        "bucket", "company_id", "home", F.bitmap_bucket_number("place").alias("chunk"),
        F.bitmap_bit_position("place").alias("bit"), F.col("sentiment_score").cast("decimal(28,12)").alias("score"),
    )
    return placed.groupBy("bucket", "company_id", "home", "chunk").agg(
        F.sum("score").alias("score_sum"),
        F.count("score").alias("score_count"),
        _trimmed(F.bitmap_construct_agg("bit"), F.floor(F.max("bit") / 8) + 1).alias("url_bits"),
    )


def coarser(fine: DataFrame, unit: str) -> DataFrame:
    """Partials merged into buckets of ``unit``; with the unit they have, partials of several batches merged into one."""
    return fine.groupBy(time_bucket(F.col("bucket"), unit).alias("bucket"), "company_id", "home", "chunk").agg(
        F.sum("score_sum").cast("decimal(38,12)").alias("score_sum"),
        F.sum("score_count").alias("score_count"),
        _trimmed(F.bitmap_or_agg("url_bits"), F.max(F.octet_length("url_bits"))).alias("url_bits"),
    )


def finished(merged: DataFrame, unit: str) -> DataFrame:
    """The mart of merged partials: (bucket_<unit>, company_id), distinct articles and mean score."""
    mean = F.try_divide(F.sum("score_sum").cast("double"), F.sum("score_count").cast("double"))
    return merged.groupBy(F.col("bucket").alias(f"bucket_{unit}"), "company_id").agg(
        F.sum(F.bitmap_count("url_bits")).alias("article_count"), mean.alias("avg_sentiment")
    )


@dataclass(frozen=True)
class StoredPartials:
    """Minute partials and article numbers of all batches under one folder; a batch is added by its own rows, whatever the table holds.

    Batches are added in order of their numbers. One that is added again replaces itself, so an attempt that died half-way is mended by the next; an earlier one must not be
    added again after a later one, whose numbers go on after its own. Events come once: rows of one event in two batches would weigh twice in the mean.
    """

    root: str

    def add(self, matched: DataFrame, batch: int, per_alias_hit: bool = False) -> None:
        spark = matched.sparkSession
        matched = written_once(matched.select("event_id", "company_id", "url_hash", "published_at_ts", "sentiment_score"))
        fresh = number_articles(matched, self._stored(spark, "numbers", NUMBERS_DDL).where(F.col(BATCH) < batch).drop(BATCH))
        self._replace(fresh, "numbers", batch)
        numbers = self._stored(spark, "numbers", NUMBERS_DDL).where(F.col(BATCH) <= batch).drop(BATCH)
        rows = partials(matched, numbers, per_alias_hit=per_alias_hit).withColumn(DAY, F.col("bucket").cast("date"))
        self._replace(rows.hint("rebalance", DAY), "partials", batch, DAY)

    def mart(self, spark: SparkSession, unit: str, days: list | None = None) -> DataFrame:
        """The mart at ``unit`` over all batches; ``days`` reads only the partitions of those days."""
        stored = self._stored(spark, "partials", f"{PARTIALS_DDL}, {DAY} date")
        if days is not None:
            stored = stored.where(F.col(DAY).isin(*days))
        return finished(coarser(stored, unit), unit)

    def _replace(self, rows: DataFrame, table: str, batch: int, *partition_by: str) -> None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.root}/{table}/{BATCH}={batch}")

    def _stored(self, spark: SparkSession, table: str, ddl: str) -> DataFrame:
        path, schema = f"{self.root}/{table}", f"{ddl}, {BATCH} bigint"
        return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else empty(spark, schema)
