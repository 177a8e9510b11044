"""Licence scan by ordered signature rules, as DataFrame expressions only: one narrow pass, no shuffle.

Text becomes words in lower case with single blanks around them. A rule is tried only where a word of the text begins with its keyword. Every
detection has an interval, a priority and a label; one that lies within another of the same or a higher priority does not count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions.lookup import bound, literal
from newslens.llm.license_rules import Rule, rules

# Phrases that always count, and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE_SCORE = 0.5
CHUNK = 256  # matches whose places are added up at a time
_PRIORITIES = (1, 2, 3)


def normalised(text: Column) -> Column:
    """A-Z lower-cased, every run of other than word characters as one blank, a blank at both ends; no words: one blank."""
    spaced = F.concat(F.lit(" "), F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(" "))
    return F.regexp_replace(spaced, NOT_WORD, " ")


def blanks(text: Column) -> Column:
    """Number of blanks."""
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _word_before(words: Column, position: Column) -> Column:
    """Number of the word that begins after the blank at ``position`` (from 1)."""
    return (blanks(F.substring(words, 1, position)) - 1).cast("long")


def _added_up(items: Column, at: Column, name: str, kind: str, advance, made) -> Column:
    """What ``made(at, item)`` gives for each item, where ``at`` grows by ``advance(item)``. Every step copies the list so far, so lists must be short."""

    def step(state: Column, item: Column) -> Column:
        return F.struct((state["at"] + advance(item)).alias("at"), F.array_append(state[name], made(state["at"], item)).alias(name))

    start = F.struct(at.alias("at"), F.array().cast(f"array<{kind}>").alias(name))
    return F.aggregate(items, start, step, lambda state: state[name])


def _spans(pairs: Column) -> Column:
    """(start, stop) of matches from the gap before each and its size, by chunks: the places where chunks begin, then those within each.

    A text of some MB may hold hundreds of thousands of matches; one list of them all would be copied at each.
    """
    width = lambda pair: pair["gap"] + pair["size"]
    numbers = F.when(F.size(pairs) > 0, F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / CHUNK).cast("int"))).otherwise(F.array().cast("array<int>"))
    chunks = F.transform(numbers, lambda k: F.slice(pairs, k * CHUNK + 1, CHUNK))

    def span(at: Column, pair: Column) -> Column:
        return F.struct((at + pair["gap"]).alias("start"), (at + width(pair)).alias("stop"))

    def placed(cut: Column) -> Column:
        sizes = F.transform(cut, lambda chunk: F.aggregate(chunk, F.lit(0), lambda total, pair: total + width(pair)))
        begins = _added_up(sizes, F.lit(0), "begins", "int", lambda size: size, lambda at, _: at)
        within = lambda chunk, at: _added_up(chunk, at, "spans", "struct<start:int,stop:int>", width, span)
        return F.flatten(F.zip_with(cut, begins, within))

    return bound(chunks, placed)


def _detections(words: Column, rule_rows: Column) -> Column:
    """All matches of the rules whose keyword and core are in the text: array of (start, end, priority, score, label).

    The core is looked for once for all wordings of a name, and only rules that match split the text.
    """
    cored = lambda group: (group["core"] == "") | F.call_function("rlike", words, group["core"])
    tried = F.filter(rule_rows, lambda group: F.contains(words, group["keyword"]) & cored(group))
    every = F.flatten(F.transform(tried, lambda group: group["rules"]))

    def placed(rule: Column, found: Column) -> Column:
        between = F.transform(F.split(words, rule["pattern"], F.lit(-1)), lambda part: F.length(part))
        sizes = F.transform(found, lambda match: F.length(match))
        gaps = F.slice(between, 1, F.size(found))
        pairs = F.zip_with(gaps, sizes, lambda gap, size: F.struct(gap.alias("gap"), size.alias("size")))
        return bound(pairs, _spans)

    def matches(rule: Column) -> Column:
        found = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
        spans = bound(found, lambda found: F.when(F.size(found) > 0, placed(rule, found)))
        return F.transform(
            F.coalesce(spans, F.array().cast("array<struct<start:int,stop:int>>")),
            lambda span: F.struct(
                span["start"].alias("start"), (-span["stop"]).alias("before"), (-rule["priority"]).alias("rank"),
                span["stop"].alias("stop"), rule["priority"].alias("priority"), rule["score"].alias("score"), rule["label"].alias("label"),
            ),
        )

    return F.flatten(F.transform(every, matches))


def _surviving(detections: Column) -> Column:
    """(labels, score) of the detections that lie in none of the same or a higher priority.

    In order of start, longest first, the furthest end so far of each priority tells whether something covers the next one.
    """
    none = F.array(*[F.lit(-1)] * (len(_PRIORITIES) + 1))
    start = F.struct(none.alias("ends"), F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"))

    def step(state: Column, one: Column) -> Column:
        covered = F.element_at(state["ends"], one["priority"]) >= one["stop"]
        ends = F.transform(
            state["ends"], lambda end, k: F.when(k < one["priority"], F.greatest(end, one["stop"])).otherwise(end)
        )
        return F.struct(
            ends.alias("ends"),
            F.when(covered, state["labels"]).otherwise(F.array_union(state["labels"], F.array(one["label"]))).alias("labels"),
            F.when(covered, state["score"]).otherwise(F.greatest(state["score"], one["score"])).alias("score"),
        )

    return F.aggregate(F.array_sort(detections), start, step)


def _whole(pattern: str) -> str:
    """The pattern between the blanks of whole words."""
    return f"(?<= )(?:{pattern})(?= )"


def rule_groups(own: list[Rule]) -> Column:
    """The rules by keyword and core as one literal; their number is fixed by hand, not by the data."""
    groups: dict[tuple[str, str], list[dict]] = {}
    for rule in own:
        row = {"pattern": _whole(rule.pattern), "priority": rule.priority, "score": rule.score, "label": rule.label}
        groups.setdefault((f" {rule.keyword}", _whole(rule.core) if rule.core else ""), []).append(row)
    value = [{"keyword": keyword, "core": core, "rules": made} for (keyword, core), made in groups.items()]
    return literal(value, "array<struct<keyword:string,core:string,rules:array<struct<pattern:string,priority:int,score:double,label:string>>>>")


def scan(docs: DataFrame, own: list[Rule] | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_detections) of every row.

    Null and empty texts have no words, no labels and score 0. Rows are judged one by one: repeated ones alike, null ids like others. Other
    columns are not read. ``score``: that of the best surviving detection, at least 0.5 if a base phrase is there.
    """
    groups = rule_groups(own if own is not None else rules())
    phrases = "|".join(BASE)
    rows = docs.select("doc_id", normalised(F.col("text")).alias("words"))
    place = f" (?=(?:{phrases}) )"
    rows = rows.withColumn("n_base", F.regexp_count("words", F.lit(place)).cast("long"))
    first = F.least(*[F.nullif(F.locate(f" {phrase} ", "words"), F.lit(0)) for phrase in BASE])
    backwards = [F.nullif(F.locate(f" {phrase} "[::-1], F.reverse("words")) + len(phrase) + 1, F.lit(0) + len(phrase) + 1) for phrase in BASE]
    last = F.length("words") - F.least(*backwards) + 1
    hits = [F.when(F.contains("words", F.lit(f" {phrase} ")), F.lit(label)) for phrase, label in BASE.items()]
    base = F.array_sort(F.array_distinct(F.array_compact(F.array(*hits))))
    keywords = "|".join(sorted({rule.keyword for rule in (own if own is not None else rules())}))
    any_keyword = F.col("words").rlike(f" (?:{keywords})")
    none = F.struct(F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"), F.lit(0).alias("n"))

    def judged(detections: Column) -> Column:
        return bound(
            _surviving(detections),
            lambda state: F.struct(state["labels"].alias("labels"), state["score"].alias("score"), F.size(detections).alias("n")),
        )

    found = F.when(any_keyword, bound(_detections(F.col("words"), groups), judged)).otherwise(none)
    rows = rows.select(
        "doc_id",
        (blanks(F.col("words")) - 1).cast("long").alias("n_words"),
        "n_base",
        F.when(F.col("n_base") > 0, _word_before(F.col("words"), first)).alias("first_word"),
        F.when(F.col("n_base") > 0, _word_before(F.col("words"), last)).alias("last_word"),
        F.when(F.col("n_base") > 0, base).otherwise(F.array().cast("array<string>")).alias("base"),
        found.alias("found"),
    )
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.col("found")["labels"])), ",").alias("labels"),
        F.greatest(F.col("found")["score"], F.when(F.col("n_base") > 0, BASE_SCORE).otherwise(0.0)).alias("score"),
        F.col("found")["n"].cast("long").alias("n_detections"),
    )
