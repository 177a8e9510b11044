"""Insert, update and replace on parquet tables, as DataFrames.

Stock Spark has no MERGE on parquet. ``upsert`` gives the merged rows; ``sources.tables`` writes them. The source is
reduced to one row per key first (the last one wins) by the same keys the join then uses, so it is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.operators.dedup import keep_first
from newslens.operators.numbering import number_inserted


def last_per_key(source: DataFrame, keys: list[str], sequence: Column) -> DataFrame:
    return keep_first(source, keys, [sequence.desc_nulls_last()])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: list[str],
    on_match: dict[str, Column] | None = None,
    on_insert: dict[str, Column] | None = None,
    small_source: bool = False,
) -> DataFrame:
    """Target rows after WHEN MATCHED UPDATE / WHEN NOT MATCHED INSERT; ``source`` has one row per key.

    ``update`` names the columns taken from the source on a match; ``on_match`` and ``on_insert`` set others (load time,
    flags). Columns given by neither keep the target's value, or the source's if it has one for a new row.

    One full outer join reads each side once and shuffles both. For a written source that is tiny beside the target,
    ``small_source`` asks for a left join and an insert of what matched nothing instead: if Spark finds the source small
    enough to broadcast, the target is not shuffled at all; if it does not, the rows are the same.
    """
    on_match, on_insert = on_match or {}, on_insert or {}
    left = target.withColumn("_old", F.lit(True)).alias("t")
    right = source.withColumn("_new", F.lit(True)).alias("s")
    condition = [F.col(f"t.{key}") == F.col(f"s.{key}") for key in keys]

    def given(name: str) -> Column:
        return F.col(f"s.{name}") if name in source.columns else F.lit(None)

    def changed(name: str) -> Column:
        return given(name) if name in update else on_match.get(name, F.col(f"t.{name}"))

    def new(name: str) -> Column:
        return on_insert.get(name, given(name))

    matched = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    if small_source:
        kept = left.join(right, condition, "left").select(
            *[F.when(matched, changed(c)).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns]
        )
        known = target.select(*keys).join(source.select(*keys), keys, "left_semi")
        added = missing(known, source, keys).alias("s").select(
            *[new(c).cast(target.schema[c].dataType).alias(c) for c in target.columns]
        )
        return kept.unionByName(added)
    inserted = F.col("_old").isNull()
    return left.join(right, condition, "full_outer").select(
        *[
            F.when(matched, changed(c)).when(inserted, new(c)).otherwise(F.col(f"t.{c}")).alias(c)
            for c in target.columns
        ]
    )


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus the source rows whose key it does not have (insert-only merge)."""
    return target.unionByName(missing(target, source, keys).select(*target.columns))


def missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target does not have."""
    return source.join(target.select(*keys), keys, "left_anti")


def upsert_articles(
    target: DataFrame, source: DataFrame, loaded_at: Column, sequence: Column, small_source: bool = False
) -> DataFrame:
    """Batch articles by (provider, url): all fields replaced, load time renewed, duplicate flag cleared; new rows numbered."""
    keys = ["provider", "url"]
    fresh = {"ingested_at": loaded_at, "is_duplicate": F.lit(False)}
    update = [c for c in target.columns if c in source.columns and c not in (*keys, "article_id", *fresh)]
    merged = upsert(target, last_per_key(source, keys, sequence), keys, update, fresh, fresh, small_source)
    return number_inserted(merged, keys, "article_id", target) if "article_id" in target.columns else merged


def upsert_mentions(target: DataFrame, source: DataFrame, created_at: Column, small_source: bool = False) -> DataFrame:
    """Mentions by (article_id, company_id); ``source`` comes from a batch matcher, so its key is unique. New rows are numbered."""
    keys = ["article_id", "company_id"]
    update = ["match_method", "confidence", "matched_text", "mention_context"]
    fresh = {"created_at": created_at}
    merged = upsert(target, source, keys, update, fresh, fresh, small_source)
    return number_inserted(merged, keys, "mention_id", target) if "mention_id" in target.columns else merged


def upsert_daily_mart(target: DataFrame, source: DataFrame, small_source: bool = False) -> DataFrame:
    """Daily mart by (metric_date, company_id); ``source`` is an aggregate by that key."""
    keys = ["metric_date", "company_id"]
    return upsert(target, source, keys, [c for c in target.columns if c not in keys], small_source=small_source)


def replace_models(existing: DataFrame, scored: DataFrame, retired: list[str]) -> DataFrame:
    """Sentiment rows after deleting the listed models and inserting new scores."""
    kept = existing.where(~F.col("model_name").isin(*retired))
    return kept.unionByName(scored, allowMissingColumns=True)
