"""Sentiment labels and scores.

Two scorers over a word list (token, valence):

* ``Lexicon.core_score``: sum of the valences of all words (letters, with apostrophes between them), normalised to [-1, 1]; words are
  found in whole batches of texts (``functions.words``).
* ``Lexicon.rule_score``: the published rule set of Hutto & Gilbert (VADER, ICWSM 2014) on top of the same word list:
  degree words, negation within three words, capitals, "least", "no", contrast after "but", and punctuation. Idioms
  and emoticons are not part of it unless they are single tokens of the word list.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.functions.lookup import HashedMap, bound, bounded_rows, key_filter, key_hash
from newslens.functions.patterns import text_bytes
from newslens.functions.words import ListedWords, letters

Scorer = Callable[[Column], Column]

# Label thresholds, and the scores of model labels.
POSITIVE_FROM = 0.05
NEGATIVE_TO = -0.05
MODEL_LABEL_SCORES = {"positive": 1.0, "mixed": 0.25, "neutral": 0.0, "unknown": 0.0, "negative": -1.0}

# Constants of the published rule set.
NORMALISER = 15.0
DEGREE_STEP = 0.293
CAPS_STEP = 0.733
NEGATION_FACTOR = -0.74
NEVER_SO_FACTOR = 1.25
DISTANCE_DAMPING = (1.0, 0.95, 0.9)
EXCLAMATION_STEP = 0.292
QUESTION_STEP = 0.18
QUESTION_MAX = 0.96
BEFORE_BUT = 0.5
AFTER_BUT = 1.5

# Word lists of the published rule set.
INTENSIFIERS = (
    "absolutely amazingly awfully completely considerable considerably decidedly deeply enormous enormously entirely "
    "especially exceptional exceptionally extreme extremely fabulously fully greatly hella highly hugely incredible "
    "incredibly intensely major majorly more most particularly purely quite really remarkably so substantially "
    "thoroughly total totally tremendous tremendously uber unbelievably unusually utter utterly very"
).split()
DAMPENERS = (
    "almost barely hardly kinda kindof kind-of less little marginal marginally occasional occasionally partly scarce "
    "scarcely slight slightly somewhat sorta sortof sort-of"
).split()
NEGATIONS = (
    "aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt mightnt mustnt neither neednt "
    "never none nope nor not nothing nowhere oughtnt shant shouldnt uhuh uh-uh wasnt werent without wont wouldnt "
    "rarely seldom despite"
).split()

DEGREES = {**dict.fromkeys(INTENSIFIERS, DEGREE_STEP), **dict.fromkeys(DAMPENERS, -DEGREE_STEP)}
UNITS = 10_000  # valences are summed as whole numbers of this fraction
WORD_FACTS = "struct<v:double,d:double,neg:boolean>"


def sentiment_label(score: Column) -> Column:
    """positive, negative or neutral; no score is neutral."""
    return F.when(score >= POSITIVE_FROM, "positive").when(score <= NEGATIVE_TO, "negative").otherwise("neutral")


def ai_label_score(label: Column) -> Column:
    """Numeric score of a model's label; anything unlisted, null included, scores 0."""
    scores = F.create_map(*[F.lit(x) for pair in MODEL_LABEL_SCORES.items() for x in pair])
    return F.coalesce(F.try_element_at(scores, label), F.lit(0.0))


def ai_label_folded(label: Column) -> Column:
    """Model label folded to the three labels the reports know."""
    return F.when(label.isin("positive", "negative"), label).otherwise("neutral")


def normalised(total: Column) -> Column:
    """Sum of valences to a compound score in [-1, 1], four decimals."""
    return F.round(total / F.sqrt(total * total + F.lit(NORMALISER)), 4)


#: A word: letters of any script with their marks, and apostrophes within it.
LETTER = r"[\p{L}\p{M}]"
WORD = f"{LETTER}+(?:'{LETTER}+)*"


def word_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


class Lexicon:
    """A word list ready to be used in expressions. Build it with ``Lexicon.load``."""

    def __init__(self, units: dict[str, int], described: HashedMap):
        packed = letters(SparkSession.active().sparkContext.applicationId, LETTER)
        self._units = SparkSession.active().sparkContext.broadcast(ListedWords(units, packed))
        self._described = described

    @staticmethod
    def clean(table: DataFrame) -> DataFrame:
        """One lower-cased row per token; of several the largest valence is kept."""
        return (
            table.select(F.lower(F.trim("token")).alias("token"), F.col("valence").cast("double").alias("valence"))
            .where((F.col("token") != "") & F.col("valence").isNotNull())
            .groupBy("token")
            .agg(F.max("valence").alias("valence"))
        )

    @classmethod
    def load(cls, table: DataFrame) -> "Lexicon":
        fixed = F.split(F.lit(" ".join([*DEGREES, *NEGATIONS])), " ")
        fixed_words = table.sparkSession.range(1).select(F.explode(fixed).alias("token"), F.lit(None).alias("valence"))
        words = cls.clean(table).unionByName(fixed_words)
        units = valence_units(F.col("valence")).alias("units")
        rows = bounded_rows(words.select("token", "valence", units, key_hash("token").alias("hash")))
        if rows is None:
            raise ValueError("word list too large for an expression: use scored(), which joins such lists")
        hashes = {row["token"]: row["hash"] for row in rows}
        valences = {row["token"]: row["valence"] for row in rows if row["valence"] is not None}
        described = {
            word: {"v": valences.get(word), "d": DEGREES.get(word, 0.0), "neg": word in NEGATIONS} for word in hashes
        }
        return cls(
            {row["token"]: row["units"] for row in rows if row["units"] is not None},
            HashedMap.build(((word, hashes[word], facts) for word, facts in described.items()), WORD_FACTS),
        )

    def core_score(self, text: Column) -> Column:
        """Lexicon core: null or blank text scores 0. Valences are summed as whole ten-thousandths, so exactly."""
        shared = self._units

        def totals(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                yield pa.array(shared.value.totals(*text_bytes(texts)))

        units = F.arrow_udf(totals, "bigint")(F.lower(F.coalesce(text, F.lit(""))))
        return normalised(units / F.lit(float(UNITS)))

    def rule_score(self, text: Column) -> Column:
        """Full rule set; null or blank text scores 0."""
        return bound(F.coalesce(text, F.lit("")), self._rules)

    def _rules(self, text: Column) -> Column:
        words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
        described = F.transform(words, lambda w: bound(_bare(w), self._describe))
        return bound(described, lambda info: _compound(info, text))

    def _describe(self, word: Column) -> Column:
        """What is known of a word: lower-cased form, its entry in the table (null if it has none), all in capitals."""
        return bound(
            F.lower(word),
            lambda low: F.struct(
                low.alias("w"),
                self._described.get(low).alias("facts"),
                ((word != low) & (word == F.upper(word))).alias("caps"),
            ),
        )


def _valence(word: Column) -> Column:
    return word["facts"]["v"]


def _degree(word: Column) -> Column:
    return F.coalesce(word["facts"]["d"], F.lit(0.0))


def _negates(word: Column) -> Column:
    return F.coalesce(word["facts"]["neg"], F.lit(False)) | word["w"].contains("n't")


def valence_units(valence: Column) -> Column:
    return F.round(valence * UNITS).cast("bigint")


def _bare(word: Column) -> Column:
    """Word without the punctuation around it; very short ones are kept as they are (they may be emoticons)."""
    return bound(
        F.btrim(word, F.lit(string.punctuation)),
        lambda bare: F.when(F.length(bare) <= 2, word).otherwise(bare),
    )


def _one_of(word: Column, *choices: str) -> Column:
    return F.coalesce(word.isin(*choices), F.lit(False))


def _compound(info: Column, text: Column) -> Column:
    """Compound score of the described words of a text."""
    mixed_caps = F.exists(info, lambda t: t["caps"]) & ~F.forall(info, lambda t: t["caps"])
    but_at = F.array_position(F.transform(info, lambda t: t["w"]), "but")

    def contrasted(valence: Column, place: Column, but_at: Column) -> Column:
        weight = F.when((but_at == 0) | (place == but_at), 1.0).when(place < but_at, BEFORE_BUT).otherwise(AFTER_BUT)
        return valence * weight

    def total(seen: Column) -> Column:
        valences = F.transform(
            info, lambda token, at: contrasted(_token_valence(info, token, at, seen["mixed"]), at + 1, seen["but_at"])
        )
        return F.aggregate(valences, F.lit(0.0), lambda acc, valence: acc + valence)

    def finished(total: Column) -> Column:
        marks = _punctuation(text)
        emphasised = F.when(total > 0, total + marks).when(total < 0, total - marks).otherwise(total)
        return bound(emphasised, normalised)

    return bound(bound(F.struct(mixed_caps.alias("mixed"), but_at.alias("but_at")), total), finished)


def _punctuation(text: Column) -> Column:
    exclamations = F.least(_count(text, "!"), F.lit(4)) * EXCLAMATION_STEP
    questions = _count(text, "?")
    return exclamations + F.when(questions <= 1, 0.0).when(questions <= 3, questions * QUESTION_STEP).otherwise(
        QUESTION_MAX
    )


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _token_valence(info: Column, token: Column, at: Column, mixed: Column) -> Column:
    """Valence of one token from the word list, changed by what surrounds it; 0 for words not listed."""
    before = [F.get(info, at - distance) for distance in (1, 2, 3)]
    after = F.get(info, at + 1)
    first, second, third = (b["w"] for b in before)

    negated_by_no = (
        _one_of(first, "no") | _one_of(second, "no") | (_one_of(third, "no") & _one_of(first, "or", "nor"))
    )
    start = (
        F.when(negated_by_no, _valence(token) * NEGATION_FACTOR)
        .when((token["w"] == "no") & _valence(after).isNotNull(), 0.0)
        .otherwise(_valence(token))
    )
    value = F.when(token["caps"] & mixed, start + F.when(start > 0, CAPS_STEP).otherwise(-CAPS_STEP)).otherwise(start)
    for step, neighbour in enumerate(before):
        value = bound(value, _neighbour_rule(step, neighbour, first, second, third, mixed))
    least = _one_of(first, "least") & _valence(before[0]).isNull() & ~_one_of(second, "at", "very")
    value = bound(value, lambda v: F.when(least, v * NEGATION_FACTOR).otherwise(v))
    silent = _valence(token).isNull() | (_degree(token) != 0.0) | ((token["w"] == "kind") & _one_of(after["w"], "of"))
    return F.when(silent, F.lit(0.0)).otherwise(value)


def _neighbour_rule(step: int, neighbour: Column, first: Column, second: Column, third: Column, mixed: Column):
    """What the word ``step + 1`` places before does to a valence."""
    counts = neighbour["w"].isNotNull() & _valence(neighbour).isNull()
    word = (first, second, third)[step]

    def apply(value: Column) -> Column:
        caps = F.when(neighbour["caps"] & mixed, F.when(value > 0, CAPS_STEP).otherwise(-CAPS_STEP)).otherwise(0.0)
        degree = F.when(_degree(neighbour) == 0.0, 0.0).otherwise(
            F.when(value < 0, -_degree(neighbour)).otherwise(_degree(neighbour)) + caps
        )
        moved = value + degree * DISTANCE_DAMPING[step]
        between = [first, second][:step]
        if between:
            so = _one_of(word, "never") & _any(_one_of(b, "so", "this") for b in between)
            doubt = _one_of(word, "without") & _any(_one_of(b, "doubt") for b in between)
            turned = (
                F.when(so, moved * NEVER_SO_FACTOR)
                .when(doubt, moved)
                .when(_negates(neighbour), moved * NEGATION_FACTOR)
                .otherwise(moved)
            )
        else:
            turned = F.when(_negates(neighbour), moved * NEGATION_FACTOR).otherwise(moved)
        return F.when(counts, turned).otherwise(value)

    return apply


def _any(conditions) -> Column:
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result


def scored_by_join(df: DataFrame, text: str, table: DataFrame, name: str) -> DataFrame:
    """``df`` with the core score of a text column as ``name``, for a word list of any size.

    Only words that pass a filter of fixed size over the list leave a text, counted before they are shuffled, and what comes back to the texts is one
    sum for each different text that has any. So no column needs to be unique or not null, and a word that fills a third of the corpus
    costs one row per text. An empty word, which no list has, counts the copies of a text on the way: texts are split into words once.
    """
    words = Lexicon.clean(table)
    lowered = F.coalesce(F.col(text), F.lit(""))
    key = F.struct(F.xxhash64(F.lit(0), lowered).alias("a"), F.xxhash64(F.lit(1), lowered).alias("b"))
    keyed = df.withColumn("_key", key)
    listed = F.filter(word_tokens(lowered), key_filter(words, "token"))
    counted = (
        keyed.select("_key", F.explode(F.concat(F.array(F.lit("")), listed)).alias("token"))
        .groupBy("_key", "token")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    sums = (
        counted.join(words, "token", "left")
        .groupBy("_key")
        .agg(
            F.sum(F.col("times") * valence_units(F.col("valence"))).alias("units"),
            F.max(F.when(F.col("token") == "", F.col("times"))).alias("copies"),
        )
        .where(F.col("units").isNotNull())
        .select("_key", (F.col("units") / F.col("copies")).alias("units"))
    )
    units = F.coalesce(F.col("units"), F.lit(0))
    joined = keyed.join(sums, "_key", "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], normalised(units / F.lit(float(UNITS))).alias(name))


def scored(df: DataFrame, text: str, table: DataFrame, name: str) -> DataFrame:
    """``df`` with the core score of a text column as ``name``: in an expression if the word list is small enough, else by
    join. Both give equal scores."""
    small = bounded_rows(Lexicon.clean(table)) is not None
    if small:
        return df.withColumn(name, Lexicon.load(table).core_score(F.col(text)))
    return scored_by_join(df, text, table, name)


def lexicon_scores_by_join(articles: DataFrame, key: str, text: str, table: DataFrame) -> DataFrame:
    """Core score of each row for a word list of any size: (key, sentiment_score)."""
    return scored_by_join(articles.select(key, text), text, table, "sentiment_score").select(key, "sentiment_score")
