"""Which companies a text names.

A text matches an alias when it contains it. Three plans give a text the same array of alias rows, and all that follows is shared:

* a handful of aliases is tried one by one in an expression;
* a table that passes a check of its rows and bytes travels to the texts as an index of all its aliases (``functions.patterns``), past which whole
  batches of texts go; the cost does not grow with the aliases, and there is no join and no shuffle;
* an alias table of any size is matched by a join on the leading bytes of the aliases (``joined_hits``), where no side
  is broadcast. A text only sends out stretches that pass a filter of fixed size over those bytes, past which whole batches are rolled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.functions.lookup import MAX_LITERAL_BYTES, MAX_LITERAL_ROWS, bound, literal
from newslens.functions.patterns import Patterns, spread, text_bytes
from newslens.functions.sentiment import Scorer, scored
from newslens.functions.text import mention_context

#: Leading bytes of a needle that texts and aliases meet on; with their number they fill one long.
ANCHOR = 7
#: Aliases that an expression tries one by one, and those that travel to the texts at all, in so many bytes at most. Rows are equal on all sides.
TRY_EACH_UP_TO, INDEX_UP_TO, INDEX_BYTES = 64, MAX_LITERAL_ROWS, MAX_LITERAL_BYTES
SALTS = 32
#: Size of the filter over leading bytes, whatever the alias table holds. A fuller filter lets more stretches pass, never fewer.
FILTER_BITS = 1 << 22
#: Bytes of a batch that are searched for anchors in one step.
STEP = 1 << 20

# Method name and confidence of a batch mention.
MATCH_METHOD = "alias_ilike"
MATCH_CONFIDENCE = 0.80

HIT_ARRAY = "array<struct<company_id:bigint,alias:string,needle:string>>"
MENTION_COLUMNS = ("article_id", "company_id", "match_method", "confidence", "matched_text", "mention_context")


def load_aliases(dim_aliases: DataFrame) -> DataFrame:
    """(company_id, alias_norm): aliases lower-cased for the realtime matcher."""
    return dim_aliases.select("company_id", F.lower("alias").alias("alias_norm"))


# --- alias rows: company_id, alias, needle ----------------------------------------------------------------------------


def substring_rows(aliases: DataFrame) -> DataFrame:
    """Rows of the substring matcher. A blank alias is part of every text and would match all of them; it is dropped, as is one
    without company. Of rows that are equal in lower case each counts."""
    rows = aliases.select("company_id", F.col("alias_norm").alias("alias"), F.col("alias_norm").alias("needle"))
    return rows.where(F.col("company_id").isNotNull() & (F.trim("needle") != ""))


def ilike_rows(dim_aliases: DataFrame) -> DataFrame:
    """Rows of the ILIKE matcher. ``needle`` is the longest stretch of the lower-cased alias that has no wildcard.

    Whatever matches the pattern contains the needle, so the needle can be searched for instead; the pattern itself is
    checked on what that finds. An alias of wildcards only has an empty needle, which is part of every text.
    """
    stretches = F.transform(
        F.split(F.lower("alias"), "[%_]"), lambda s: F.struct((-F.length(s)).alias("rank"), s.alias("stretch"))
    )
    rows = dim_aliases.select("company_id", "alias", F.array_min(stretches)["stretch"].alias("needle"))
    return rows.where(F.col("company_id").isNotNull() & (F.trim("alias") != ""))


def ilike_contains(text: Column, hit: Column) -> Column:
    """``text ILIKE '%' || alias || '%'`` for an already lower-cased text; ``%`` and ``_`` in the alias are wildcards.

    Most aliases have no wildcard and need no pattern.
    """
    alias = F.lower(hit["alias"])
    pattern = F.concat(F.lit("%"), F.replace(alias, F.lit("\\"), F.lit("\\\\")), F.lit("%"))
    return F.when(hit["needle"] == alias, text.contains(alias)).otherwise(F.call_function("like", text, pattern))


@dataclass(frozen=True)
class AliasIndex:
    """An alias table that travels to the texts: rows by company and alias."""

    entries: list[dict]

    @classmethod
    def load(cls, rows: DataFrame, up_to: int = INDEX_UP_TO) -> "AliasIndex | None":
        """The index of an alias table, or None if it has more rows than ``up_to`` or too many bytes. Fetches one row more at most."""
        fetched = [row.asDict() for row in rows.select("company_id", "alias", "needle").limit(up_to + 1).collect()]
        size = sum(len(row["alias"].encode()) + len(row["needle"].encode()) for row in fetched)
        if len(fetched) > up_to or size > INDEX_BYTES:
            return None
        return cls(sorted(fetched, key=lambda e: (e["company_id"], e["alias"])))

    def hits(self, lowered: Column) -> Column:
        """Array of the alias rows whose needle is part of a lower-cased text, by company and alias; a null text has none."""
        return self._each(lowered) if len(self.entries) <= TRY_EACH_UP_TO else self._batchwise(lowered)

    def _each(self, lowered: Column) -> Column:
        entries = literal(self.entries, HIT_ARRAY)
        return bound(lowered, lambda text: F.filter(entries, lambda hit: text.contains(hit["needle"])))

    def _batchwise(self, lowered: Column) -> Column:
        needles = sorted({e["needle"].encode() for e in self.entries} - {b""})
        number = {needle: k for k, needle in enumerate(needles)}
        owners = np.array([number.get(e["needle"].encode(), -1) for e in self.entries])  # -1: part of every text
        by_needle = np.argsort(owners, kind="stable")
        begins = np.searchsorted(owners[by_needle], np.arange(-1, len(needles) + 1))
        kinds = pa.struct([("company_id", pa.int64()), ("alias", pa.string()), ("needle", pa.string())])
        shared = SparkSession.active().sparkContext.broadcast((Patterns(needles), by_needle, begins, pa.array(self.entries, kinds)))

        def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            patterns, order, first, entries = shared.value
            for texts in batches:
                data, offsets = text_bytes(texts)
                if not patterns.tables:  # the first texts of a task are the sample that anchors are chosen by
                    patterns.anchored(data)
                text, needle = patterns.found(data, offsets)
                text = np.concatenate([np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False)), text])
                needle = np.concatenate([np.full(len(text) - len(needle), -1), needle])
                counts = first[needle + 2] - first[needle + 1]
                text, entry = np.repeat(text, counts), order[spread(first[needle + 1], counts)]
                by_text = np.lexsort((entry, text))
                bounds = np.searchsorted(text[by_text], np.arange(len(texts) + 1)).astype(np.int32)
                yield pa.ListArray.from_arrays(pa.array(bounds), entries.take(pa.array(entry[by_text])))

        # not deterministic in name: else a filter above it would make Spark search every text twice
        return F.arrow_udf(search, HIT_ARRAY).asNondeterministic()(lowered)


def unused(name: str, columns: list[str]) -> str:
    """A name for a scratch column that is none of ``columns``."""
    while name.lower() in {c.lower() for c in columns}:
        name = f"_{name}"
    return name


def beginning(needle: Column) -> Column:
    """The first ANCHOR bytes of a needle as a number, with how many they are above them."""
    first = F.substring(needle.cast("binary"), 1, ANCHOR)
    return F.coalesce(F.conv(F.hex(first), 16, 10).cast("bigint"), F.lit(0)) + F.octet_length(first) * F.lit(1 << 56)


def _slots(anchors: np.ndarray) -> np.ndarray:
    """The bit of the filter for each anchor."""
    return ((anchors.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS.bit_length() + 1)).astype(np.int64)


def anchors_in(data: np.ndarray, offsets: np.ndarray, lengths: list[int], passes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, anchor) of the stretches of these lengths in the texts ``data[offsets[k] : offsets[k + 1]]`` that pass the filter, each once."""
    eight = np.ndarray(len(data), ">u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    pairs = np.zeros((0, 2), np.int64)
    for step in range(int(offsets[0]), int(offsets[-1]), STEP):
        windows, parts = eight[step : min(step + STEP, int(offsets[-1]))].astype(np.uint64), [pairs]
        for length in lengths:
            if length:
                anchors = (windows >> np.uint64(64 - 8 * length)).astype(np.int64) + (length << 56)
                at = np.flatnonzero(passes[_slots(anchors)])
                text = np.searchsorted(offsets, at + step, side="right") - 1
                inside = at + step + length <= offsets[text + 1]
                parts.append(np.stack([text[inside], anchors[at[inside]]], axis=1))
        pairs = np.concatenate(parts)
        order = np.lexsort((pairs[:, 1], pairs[:, 0]))
        pairs = pairs[order][np.concatenate([[True], (np.diff(pairs[order], axis=0) != 0).any(axis=1)])[: len(order)]]
    return pairs[:, 0], pairs[:, 1]


def possible_anchors(anchored: DataFrame) -> Callable[[Column], Column]:
    """The anchors that a text holds, each once, of those that pass the filter: bits at the aliases' anchors, FILTER_BITS at most. A null text has none."""
    lengths = sorted(row[0] for row in anchored.select(F.shiftright("_anchor", 56)).distinct().collect())
    slot_of = F.arrow_udf(lambda anchors: pa.array(_slots(anchors.to_numpy(zero_copy_only=False))), "bigint")
    slots = anchored.select("_anchor").distinct().select(slot_of("_anchor").alias("slot"))
    bit = F.call_function("shiftleft", F.lit(1), F.col("slot").bitwiseAND(F.lit(7)).cast("int"))
    marked = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in slots.groupBy(F.shiftright("slot", 3).alias("byte")).agg(F.bit_or(bit).alias("bits")).collect():
        marked[row["byte"]] = row["bits"]
    shared = anchored.sparkSession.sparkContext.broadcast(marked)

    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        passes = np.unpackbits(shared.value, bitorder="little").astype(bool)
        for texts in batches:
            text, anchor = anchors_in(*text_bytes(texts), lengths, passes)
            if 0 in lengths:
                whole = np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False))
                text, anchor = np.concatenate([whole, text]), np.concatenate([np.zeros(len(whole), np.int64), anchor])
                order = np.argsort(text, kind="stable")
                text, anchor = text[order], anchor[order]
            bounds = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(bounds), pa.array(anchor, pa.int64()))

    # not deterministic in name: else a filter above it would make Spark search every text twice
    return lambda lowered: F.arrow_udf(search, "array<bigint>").asNondeterministic()(lowered)


def joined_hits(texts: DataFrame, lowered: Column, rows: DataFrame, name: str = "_hits") -> DataFrame:
    """``texts`` with the array ``name`` of the alias rows whose needle they contain, for an alias table of any size; texts without
    any fall out.

    Texts and needles meet on the first bytes of the needle, which whole batches of texts are searched for. That join sees hashes of the
    texts and numbers only; what it finds comes back to the texts as one array for each different text. So no column needs to be unique or not null.
    Bytes that are in much of the corpus are spread over ``SALTS`` tasks: the text side takes its salt from the text's hash, the
    alias side is repeated once per salt.
    """
    anchored = rows.withColumn("_anchor", beginning(F.col("needle")))
    key = unused("_key", [*texts.columns, name])
    found_name = unused("_found", [*texts.columns, name])
    both = F.struct(F.xxhash64(F.lit(0), lowered).alias("a"), F.xxhash64(F.lit(1), lowered).alias("b"))
    keyed = texts.withColumn(key, both)
    grams = keyed.select(key, F.explode(possible_anchors(anchored)(lowered)).alias("_anchor"), F.pmod(F.col(key)["a"], F.lit(SALTS)).alias("_salt"))
    counted = anchored.groupBy("company_id", "alias", "needle", "_anchor").agg(F.count(F.lit(1)).cast("int").alias("times"))
    salted = counted.withColumn("_salt", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")))
    hit = F.struct("company_id", "alias", "needle", "times")
    found = grams.join(salted, ["_anchor", "_salt"]).groupBy(key).agg(F.array_sort(F.collect_set(hit)).alias(found_name))
    contained = F.flatten(
        F.transform(
            bound(lowered, lambda text: F.filter(found_name, lambda hit: text.contains(hit["needle"]))),
            lambda hit: F.array_repeat(
                F.struct(*[hit[c].alias(c) for c in ("company_id", "alias", "needle")]), hit["times"]
            ),
        )
    )
    return keyed.join(found, key).select(*[F.col(f"`{c}`") for c in texts.columns], contained.alias(name))


def with_hits(texts: DataFrame, lowered: Column, rows: DataFrame, name: str, up_to: int = INDEX_UP_TO) -> DataFrame:
    """``texts`` with the array ``name`` of alias rows, by the plan that fits the alias table; texts without hits may fall out."""
    index = AliasIndex.load(rows, up_to)
    return texts.withColumn(name, index.hits(lowered)) if index else joined_hits(texts, lowered, rows, name)


# --- realtime matcher -------------------------------------------------------------------------------------------------


def match_substring(
    articles: DataFrame, aliases: DataFrame, *, text: str = "article_text", per_alias_hit: bool = True,
    scorer: "Scorer | DataFrame | None" = None, up_to: int = INDEX_UP_TO,
) -> DataFrame:
    """Articles joined to companies by ``alias_norm`` being part of the lower-cased text.

    One row per alias that hits, as the append tables have it; with ``per_alias_hit=False`` one row per (article,
    company). With a ``scorer`` (a function of the text, or a word list of any size) the rows get ``sentiment_score``; each matched
    article is scored once, an unmatched one never. Alias tables of up to ``up_to`` rows travel to the texts.
    """
    columns = [F.col(f"`{name}`") for name in articles.columns]
    name = unused("_companies", articles.columns)
    found = with_hits(articles, F.lower(text), substring_rows(aliases), name, up_to)
    companies = F.transform(name, lambda hit: hit["company_id"])
    matched = found.select(*columns, (companies if per_alias_hit else F.array_distinct(companies)).alias(name))
    if isinstance(scorer, DataFrame):
        matched = scored(matched.where(F.size(name) > 0), text, scorer, "sentiment_score")
    elif scorer:  # a scorer that works on batches gets null for a text that is not matched
        matched = matched.withColumn("sentiment_score", F.when(F.size(name) > 0, scorer(F.when(F.size(name) > 0, F.col(text)))))
    # explode_outer and a filter behind it: a plain explode would evaluate the match a second time as a filter
    return matched.select(
        *[F.col(f"`{c}`") for c in matched.columns if c != name],
        F.explode_outer(name).alias("company_id"),
    ).where(F.col("company_id").isNotNull())


# --- batch matchers ---------------------------------------------------------------------------------------------------


def _field_rank(fields: Column, hit: Column) -> Column:
    """1, 2 or 3 for an alias found in title, description or content; null when in none of them."""
    return (
        F.when(ilike_contains(fields["title"], hit), 1)
        .when(ilike_contains(fields["description"], hit), 2)
        .when(ilike_contains(fields["content"], hit), 3)
    )


def _lowered_fields() -> Column:
    return F.struct(*[F.lower(F.coalesce(c, F.lit(""))).alias(c) for c in ("title", "description", "content")])


def _searched(fields: Column) -> Column:
    return F.concat_ws("\n", fields["title"], fields["description"], fields["content"])


def _ranked(company: Column, rank: Column, alias: Column) -> Column:
    """Sorts best first within a company: earlier field, longer alias, alias text."""
    return F.struct(
        company.alias("company_id"), rank.alias("rank"), (-F.length(alias)).alias("shortness"), alias.alias("alias")
    )


def _with_verified_hits(articles: DataFrame, dim_aliases: DataFrame, up_to: int) -> DataFrame:
    """(article_id, title, description, content) with ``ranked``: ranked hits, each alias checked as a pattern on each field by itself."""
    own = articles.select("article_id", "title", "description", "content")
    found = with_hits(own, _searched(_lowered_fields()), ilike_rows(dim_aliases), "hits", up_to)
    both = F.struct(_lowered_fields().alias("fields"), F.col("hits"))

    def ranked(both: Column) -> Column:
        hits = F.transform(
            both["hits"], lambda hit: _ranked(hit["company_id"], _field_rank(both["fields"], hit), hit["alias"])
        )
        return F.filter(hits, lambda hit: hit["rank"].isNotNull())

    return found.select(*own.columns, bound(both, ranked).alias("ranked"))


def _mentions(matched: DataFrame) -> DataFrame:
    """Fixed columns of a batch mention from (article_id, company_id, matched_text, mention_context)."""
    return matched.select(
        "article_id",
        "company_id",
        F.lit(MATCH_METHOD).alias("match_method"),
        F.lit(MATCH_CONFIDENCE).alias("confidence"),
        "matched_text",
        "mention_context",
    )


def _exploded(articles: DataFrame, picked) -> DataFrame:
    """One row per element of ``picked(hits)``, an array of (company_id, matched_text), of the articles that have any."""
    context = mention_context("title", "description", "content").alias("mention_context")
    return (
        articles.select("article_id", context, picked.alias("picked"))
        .select("article_id", "mention_context", F.explode_outer("picked").alias("one"))
        .where(F.col("one").isNotNull())
        .select("article_id", "mention_context", "one.company_id", "one.matched_text")
    )


def match_best_alias(articles: DataFrame, dim_aliases: DataFrame, up_to: int = INDEX_UP_TO) -> DataFrame:
    """One mention per article and company with its best alias: title before description before content, then the
    longer alias, then the alias that sorts first. Every row of ``articles`` stands for itself."""

    def best(hits: Column) -> Column:
        firsts = F.filter(
            hits,
            lambda hit, at: (at == 0) | (F.get(hits, at - 1)["company_id"] != hit["company_id"]),
        )
        return F.transform(
            firsts, lambda hit: F.struct(hit["company_id"].alias("company_id"), hit["alias"].alias("matched_text"))
        )

    found = _with_verified_hits(articles, dim_aliases, up_to)
    return _mentions(_exploded(found, bound(F.sort_array("ranked"), best)))


def match_alias_list(articles: DataFrame, dim_aliases: DataFrame, up_to: int = INDEX_UP_TO) -> DataFrame:
    """One mention per article and company that lists all aliases found, distinct and in order."""

    def listed(hits: Column) -> Column:
        companies = F.array_distinct(F.transform(hits, lambda hit: hit["company_id"]))

        def aliases(company: Column) -> Column:
            own = F.filter(hits, lambda hit: hit["company_id"] == company)
            return F.array_join(F.array_sort(F.array_distinct(F.transform(own, lambda hit: hit["alias"]))), ", ")

        return F.transform(companies, lambda c: F.struct(c.alias("company_id"), aliases(c).alias("matched_text")))

    found = _with_verified_hits(articles, dim_aliases, up_to)
    return _mentions(_exploded(found, bound(F.col("ranked"), listed)))
