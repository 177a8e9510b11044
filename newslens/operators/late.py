"""Latest rows of stored tables by late materialisation.

Picking one row a key needs the key and the times, but rows carry whole texts. Over a stored table the pick reads the narrow columns only, together with where
each row stands (file and number within it). What stays comes back as one bit map a file, and the second scan tests the bit of each row where it
lies: texts are read once and never sorted or shuffled, neither the winners' nor the losers'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.operators.dedup import article_key, keep_first
from newslens.session import working_path

#: Bytes of bit maps that are broadcast (a bit a row: half a thousand million rows). Beyond it the same maps are joined in pieces.
BROADCAST_BYTES = 64 << 20
#: Rows that a piece of a bit map covers.
PIECE = 1 << 16


def _word(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(64)).cast("int"))


def bit_maps(places: DataFrame) -> DataFrame:
    """(file, piece, bits array<long>, words long): a bit for each of the rows (file, at) of each piece of a file, up to the last one set."""
    piece, word = F.floor(F.col("at") / PIECE), F.floor(F.pmod("at", F.lit(PIECE)) / 64)
    set_bits = places.groupBy("file", piece.alias("piece"), word.alias("word")).agg(F.bit_or(_word(F.col("at"))).alias("bits"))
    own = set_bits.groupBy("file", "piece").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("own"))
    # words without a bit are filled in between: a word is looked up by its number
    gaps = F.transform("own", lambda e, k: F.concat(
        F.array_repeat(F.lit(0).cast("bigint"), (e["word"] - F.when(k == 0, -1).otherwise(F.get("own", k - 1)["word"]) - 1).cast("int")), F.array(e["bits"])
    ))
    return own.select("file", "piece", F.flatten(gaps).alias("bits")).withColumn("words", F.size("bits").cast("long"))


def keep_first_stored(stored: DataFrame, keys: list[Column], order: list[tuple[Column, bool]]) -> DataFrame:
    """One row a key of a table as read from Parquet files that nobody replaces meanwhile: the first by ``order``, (value, whether the
    largest is first), nulls last.

    Of rows that tie in the whole order any one stays, and only one. The places of the rows that stay are written to the shared folder.
    """
    spark = stored.sparkSession
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")]
    names = [f"key_{k}" for k in range(len(keys))]
    narrow = stored.select(
        *[key.alias(name) for key, name in zip(keys, names, strict=True)], *[value.alias(f"by_{k}") for k, (value, _) in enumerate(order)], *place
    )
    sort = [F.col(f"by_{k}").desc_nulls_last() if down else F.col(f"by_{k}").asc_nulls_last() for k, (_, down) in enumerate(order)]
    path = working_path(spark, "kept-rows")
    bit_maps(keep_first(narrow, names, sort).select("file", "at")).write.parquet(path)
    maps = spark.read.parquet(path)
    words = maps.agg(F.sum("words")).first()[0] or 0
    row = F.struct(*[F.col(f"`{c}`") for c in stored.columns]).alias("row")
    rows = stored.select(row, *place).withColumn("piece", F.floor(F.col("at") / PIECE))
    found = rows.join(F.broadcast(maps) if 8 * words <= BROADCAST_BYTES else maps, ["file", "piece"])
    bits = F.get("bits", F.floor(F.pmod("at", F.lit(PIECE)) / 64).cast("int"))
    kept = found.where(F.coalesce(bits.bitwiseAND(_word(F.col("at"))) != 0, F.lit(False)))
    return kept.select(*[F.col("row")[c].alias(c) for c in stored.columns])


def latest_event_company(stored_base: DataFrame) -> DataFrame:
    """Newest load per (event_id, company_id) of the stored base table."""
    order = [(F.col("loaded_at"), True), (F.col("ingest_batch_id"), True)]
    return keep_first_stored(stored_base, [F.col("event_id"), F.col("company_id")], order)


def latest_url_company(stored_rows: DataFrame) -> DataFrame:
    """Newest load per (canonical_url_hash, company_id) of the stored rows of both paths; a row without hash and url is its own article."""
    order = [(F.col("loaded_at"), True), (F.col("record_id"), True), (F.col("ingest_path"), False)]
    return keep_first_stored(stored_rows, [article_key("canonical_url_hash", "ingest_path", "record_id"), F.col("company_id")], order)


def stored(rows: DataFrame) -> DataFrame:
    """Rows written to the shared folder and read back: a table that the functions above can read twice."""
    path = working_path(rows.sparkSession, "rows")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
