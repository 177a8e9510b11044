"""Numbers for rows that have none."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newslens.sources.tables import written_once

BUCKET_HEX = 4  # hex digits: at most 65,536 buckets, whatever the table holds


def number_new_rows(rows: DataFrame, keys: list[str], name: str, after: DataFrame | None = None) -> DataFrame:
    """Give each row of a table with unique ``keys`` a number, without gaps, after the largest in ``after``.

    Numbers follow the sha-256 of the key, so they depend on nothing but the key set. A row number over the whole table
    would run in one task; the hash's leading digits instead cut the order into buckets of even size, each numbered in
    parallel and shifted by the rows in the buckets before it (one row per bucket, a bounded table).
    """
    hashed = rows.withColumn("_hash", F.sha2(F.concat_ws("\u0001", *[F.col(k).cast("string") for k in keys]), 256))
    bucketed = hashed.withColumn("_bucket", F.left("_hash", F.lit(BUCKET_HEX)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    within = Window.partitionBy("_bucket").orderBy("_hash")
    last = F.lit(0) if after is None else after.agg(F.coalesce(F.max(name), F.lit(0))).scalar()
    return (
        bucketed.withColumn("_rn", F.row_number().over(within))
        .join(F.broadcast(shifts), "_bucket")
        .withColumn(name, (last + F.col("_shift") + F.col("_rn")).cast("bigint"))
        .drop("_hash", "_bucket", "_rn", "_shift")
    )


def number_inserted(merged: DataFrame, keys: list[str], name: str, target: DataFrame) -> DataFrame:
    """Merged rows with numbers for those that an upsert has inserted (their number is null), after the target's largest.

    The merged rows are written once: old rows, new rows and sizes of buckets are three reads of them, and behind them is all that made the source.
    """
    merged = written_once(merged)
    fresh = number_new_rows(merged.where(F.col(name).isNull()).drop(name), keys, name, target)
    return merged.where(F.col(name).isNotNull()).unionByName(fresh.select(*merged.columns))
