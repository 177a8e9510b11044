"""Language identification by mixture inference: which languages a document is written in, and in what proportions.

A language is a character model: the chance of each letter of a word after the two before it, from counts of one, two and three letters over all documents
that are learned from. A document is a mixture: each word is drawn from one of its languages. Expectation-maximisation estimates the proportions from
the words' likelihoods (after Lui, Lau & Baldwin 2014, who sample where this maximises). The set of languages grows from the best single one by the
language with the next largest proportion, as long as the likelihood gains more than a penalty for each language.

Counts are summed over all documents by Spark; only the model comes to the driver: SLOTS numbers a language, whatever the corpus holds.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.llm import arrays

UNDETERMINED = "und"
#: Counters of a language. Letter groups that share one only look more frequent.
SLOTS = 1 << 16
#: A longer stretch of letters (scripts without blanks) is several words.
LONGEST_WORD = 16
_WORD = re.compile(r"[^\W\d_]{1,%d}" % LONGEST_WORD)
#: Weight of the shorter context, and letters that are thought to exist.
BACKOFF, LETTERS = 2.0, 1000
#: Rounds of expectation-maximisation at most, the change of a proportion that ends them, and the price of one more language in
#: logarithms of the number of words.
ROUNDS, STILL, PENALTY = 50, 1e-4, 2.0
#: Languages that a task counts at once, and numbers that it keeps for words it has met.
HELD_LANGUAGES, KEPT_NUMBERS = 64, 4_000_000


def words_of(text: str) -> Counter[str]:
    """Lower-cased words of letters with their counts; other signs separate or, inside a word, are left out."""
    found = Counter(_WORD.findall(text.lower()))
    odd = [w for w in found if not w.isalpha()]  # numerals that are no digits
    for word in odd:
        times, letters = found.pop(word), "".join(filter(str.isalpha, word))
        if letters:
            found[letters] += times
    return found


def slots(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(5 x letters array of slots: one, two, three letters, contexts of one and two; the word of each letter). Its end is a letter of a word."""
    if not words:
        return np.zeros((5, 0), np.int64), np.zeros(0, np.int64)
    _, points = arrays.code_points(words)
    points = points.astype(np.uint64)
    edge = np.uint64(arrays.BREAK)
    before = np.concatenate([[edge], points[:-1]])
    second = np.where(before == edge, edge, np.concatenate([[edge, edge], points[:-2]])[: len(points)])
    keys = [points, before << np.uint64(21) | points, second << np.uint64(42) | before << np.uint64(21) | points, before, second << np.uint64(21) | before]
    made = [arrays.mixed(arrays.mixed(key + np.uint64(1)) + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)) for salt, key in enumerate(keys, 1)]
    word = np.cumsum(points == edge) - (points == edge)
    return (np.stack(made) % np.uint64(SLOTS)).astype(np.int64), word


@dataclass
class Model:
    """Languages in order and their counters: (languages x SLOTS), and the letters counted of each."""

    languages: list[str]
    counts: np.ndarray
    letters: np.ndarray

    def likelihoods(self, words: list[str]) -> np.ndarray:
        """(words x languages): logarithm of the chance of each word."""
        at, word = slots(words)
        made = np.zeros((len(words), len(self.languages)))
        for k, counts in enumerate(self.counts):
            one, two, three, after_one, after_two = (counts[row].astype(np.float64) for row in at)
            p = (one + 0.5) / (self.letters[k] + 0.5 * LETTERS)
            p = (two + BACKOFF * p) / (np.maximum(after_one, two) + BACKOFF)
            p = (three + BACKOFF * p) / (np.maximum(after_two, three) + BACKOFF)
            made[:, k] = np.bincount(word, np.log(p), len(words))
        return made


def fit(docs: DataFrame, learned: Column, text: str = "text", lang: str = "lang") -> Model:
    """The model of all rows of ``docs`` where ``learned`` holds and text and language are not null. Repeated rows count each."""
    rows = docs.where(learned & F.col(f"`{text}`").isNotNull() & F.col(f"`{lang}`").isNotNull())
    rows = rows.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.release_words()
        held: dict[str, np.ndarray] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for name, counts in held.items():
                at = np.flatnonzero(counts)
                columns = [pa.array([name] * (len(at) + 1)), pa.array(np.append(at, SLOTS).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.append(counts[at], 0))], ["lang", "slot", "n"])
            held.clear()

        for batch in batches:
            words: dict[str, Counter[str]] = {}
            for name, body in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words.setdefault(name, Counter()).update(words_of(body))
            for name, found in words.items():
                if name not in held and len(held) >= HELD_LANGUAGES:
                    yield from told()
                at, word = slots(list(found))
                weight = np.fromiter(found.values(), np.int64)[word]
                total = held.setdefault(name, np.zeros(SLOTS, np.int64))
                for row in at:
                    total += np.bincount(row, weight, SLOTS).astype(np.int64)
        yield from told()

    summed = rows.mapInArrow(count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    names = summed["lang"].to_pylist()
    languages = sorted(set(names))
    number = {name: k for k, name in enumerate(languages)}
    counts = np.zeros((len(languages), SLOTS + 1), np.float32)
    counts[[number[n] for n in names], summed["slot"].to_numpy()] = summed["n"].to_numpy()
    counts = counts[:, :SLOTS]
    return Model(languages, counts, counts.sum(axis=1, dtype=np.float64) / 5)


# --- mixtures ------------------------------------------------------------------------------------------------------------------


class Mixtures:
    """Documents as rows (document, times, likelihood of a word under each language), in order of the documents, each with a row at least."""

    def __init__(self, doc: np.ndarray, times: np.ndarray, logs: np.ndarray):
        self.doc, self.times = doc, times.astype(np.float64)
        self.starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        self.number = doc[self.starts]
        self.words = np.add.reduceat(self.times, self.starts)
        self.logs = logs - logs.max(axis=1, keepdims=True)

    def part(self, chosen: np.ndarray) -> "Mixtures":
        """The chosen documents (places in ``number``)."""
        mask = np.zeros(len(self.number), bool)
        mask[chosen] = True
        rows = np.repeat(mask, np.diff(np.append(self.starts, len(self.doc))))
        made = object.__new__(Mixtures)
        made.doc, made.times, made.logs = self.doc[rows], self.times[rows], self.logs[rows]
        made.starts = np.flatnonzero(np.concatenate([[True], made.doc[1:] != made.doc[:-1]]))
        made.number, made.words = self.number[mask], self.words[mask]
        return made

    def single(self) -> np.ndarray:
        """(documents x languages): log-likelihood under each language alone."""
        return np.add.reduceat(self.times[:, None] * self.logs, self.starts)

    def estimate(self, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(proportions, log-likelihood) of each document by expectation-maximisation over its ``allowed`` languages."""
        share = allowed / allowed.sum(axis=1, keepdims=True)
        value = np.zeros(len(self.number))
        todo, now = np.arange(len(self.number)), self
        for turn in range(ROUNDS):
            likely = np.exp(now.logs)
            owner = np.repeat(np.arange(len(now.number)), np.diff(np.append(now.starts, len(now.doc))))
            weighted = likely * share[todo][owner]
            total = np.maximum(weighted.sum(axis=1), 1e-300)
            value[todo] = np.add.reduceat(now.times * np.log(total), now.starts)
            fresh = np.add.reduceat(weighted * (now.times / total)[:, None], now.starts) / now.words[:, None]
            on = np.abs(fresh - share[todo]).max(axis=1) > STILL
            share[todo] = fresh
            if not on.any() or turn + 1 == ROUNDS:
                break
            if not on.all():
                now, todo = now.part(np.flatnonzero(on)), todo[on]
        return share, value

    def selected(self) -> np.ndarray:
        """Proportions of each document over the languages that penalised likelihood selects; 0 for the others."""
        n, languages = len(self.number), self.logs.shape[1]
        single = self.single()
        best = single.argmax(axis=1)
        allowed = np.zeros((n, languages))
        allowed[np.arange(n), best] = 1
        share, value = allowed.copy(), single[np.arange(n), best]
        if languages == 1:
            return share
        order, _ = self.estimate(np.ones((n, languages)))
        todo = np.arange(n)
        while len(todo):
            left = np.where(allowed[todo] > 0, -1, order[todo])
            more = left.argmax(axis=1)
            todo = todo[left[np.arange(len(todo)), more] * self.words[todo] > 0.5]  # half a word at least
            if not len(todo):
                break
            wider = allowed[todo].copy()
            more = np.where(wider > 0, -1, order[todo]).argmax(axis=1)
            wider[np.arange(len(todo)), more] = 1
            shares, values = self.part(todo).estimate(wider)
            gains = values - value[todo] > PENALTY * np.log(self.words[todo] + 1)
            todo, wider, shares, values = todo[gains], wider[gains], shares[gains], values[gains]
            allowed[todo], share[todo], value[todo] = wider, shares, values
        return share


def mixtures(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """(doc: struct of the columns to keep, lang_pred, score, languages array<struct<lang, share>>) of every row.

    ``languages``: the selected ones by falling share; ``lang_pred`` is the first (ties: the first by name) and ``score`` its share of the words. A text that
    is null or has no letter, and every text if nothing was learned, is ``und`` with score 0 and no languages. Nothing but the text
    is looked at; texts are whole. Repeated rows are each judged alike; an empty table gives an empty one.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept_words = max(1, KEPT_NUMBERS // max(1, len(model.languages)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.release_words()
        own = shared.value
        names, width = np.array([*own.languages, UNDETERMINED], object), len(own.languages)
        index: dict[str, int] = {}
        known = np.zeros((0, width), np.float32)

        def likelihoods(words: list[str]) -> np.ndarray:
            nonlocal known
            if len(index) > kept_words:
                index.clear()
                known = known[:0]
            fresh = [w for w in dict.fromkeys(words) if w not in index]
            if fresh:
                index.update(zip(fresh, range(len(index), len(index) + len(fresh)), strict=True))
                known = np.concatenate([known, own.likelihoods(fresh).astype(np.float32)])
            return known[[index[w] for w in words]].astype(np.float64)

        for batch in batches:
            texts = arrays.column_texts(batch, "text")
            for begin, end in arrays.blocks(texts):
                found = [words_of(t) for t in texts[begin:end]] if width else [{}] * (end - begin)
                share = np.zeros((end - begin, width + 1))
                share[:, width] = 1
                doc = np.repeat(np.arange(end - begin), [len(f) for f in found])
                if len(doc):
                    words = [w for f in found for w in f]
                    mixed = Mixtures(doc, np.array([n for f in found for n in f.values()]), likelihoods(words))
                    share[mixed.number, :width], share[mixed.number, width] = mixed.selected(), 0
                first = share.argmax(axis=1)
                score = np.where(first < width, share.max(axis=1), 0.0)
                at, language = np.nonzero(share[:, :width])
                order = np.lexsort((language, -share[at, language], at))
                at, language = at[order], language[order]
                lists = pa.StructArray.from_arrays([pa.array(names[language], pa.string()), pa.array(share[at, language])], ["lang", "share"])
                offsets = pa.array(np.searchsorted(at, np.arange(end - begin + 1)).astype(np.int32))
                columns = [batch.column("doc").slice(begin, end - begin), pa.array(names[first], pa.string()), pa.array(np.clip(score, 0, 1))]
                yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(offsets, lists)], ["doc", "lang_pred", "score", "languages"])

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, lang_pred string, score double, languages array<struct<lang:string,share:double>>")
