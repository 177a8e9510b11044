"""Byte-level BPE with numpy: many words are merged together, round by round.

A vocabulary file of the tokenizers library gives ids and merges. Text is split as the library's byte-level splitter does,
by classes of characters in arrays; equal words are encoded once per process.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm import arrays

LETTER, NUMBER, OTHER, SPACE, END, SPECIAL = 1, 2, 3, 4, 5, 6


@lru_cache(1)
def character_classes() -> np.ndarray:
    """The class of every code point."""
    classes = np.full(0x110000, OTHER, np.uint8)
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", SPACE)):
        for found in regex.finditer(pattern, everything):
            at, end = (x + 0x800 * (x >= 0xD800) for x in (found.start(), found.end() - 1))
            classes[at : end + 1] = kind
    classes[0xD800:0xE000] = OTHER
    classes[arrays.BREAK] = END
    return classes


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + rest.index(b)) for b in range(256)]


def split_words(points: np.ndarray, specials: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all words of the laid-out texts, and the class of the character there (END for the breaks).

    A run of letters, numbers or other signs is a word, with one plain space before it. Of white space before a word the last
    character stands apart. An apostrophe that begins a word takes s, t, m, d, re, ve or ll with it.
    """
    kind = character_classes()[points]
    for start, end in specials:
        kind[start:end] = SPECIAL
    size = len(points)
    new = np.ones(size, bool)
    new[1:] = kind[1:] != kind[:-1]
    after_blank = np.zeros(size, bool)
    after_blank[1:] = points[:-1] == 32
    wordly = kind <= OTHER
    starts = new & ~(wordly & after_blank) | (kind == END)
    starts[:-1] |= (kind[:-1] == SPACE) & wordly[1:]
    for start, _ in specials:
        starts[start] = True
    quote = np.flatnonzero((points == 39) & new & ~after_blank & (kind == OTHER))
    quote = quote[kind[quote + 1] == LETTER]  # a break follows every text
    if len(quote):
        one, two = points[quote + 1], points[np.minimum(quote + 2, size - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        pairs = [(one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll")]
        long = ~short & np.logical_or.reduce(pairs)
        starts[quote[short | long] + 1] = False
        starts[quote[short] + 2] = True
        starts[quote[long] + 3] = True
    at = np.flatnonzero(starts)
    return at, kind[at]


class Vocabulary:
    """Ids, merges and special texts of a tokenizers file with a byte-level BPE model."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, added = data["model"], data.get("added_tokens", [])
        ids = model["vocab"]
        symbols = byte_symbols()
        byte_of = {symbol: byte for byte, symbol in enumerate(symbols)}
        self.size = 1 + max([*ids.values(), *(token["id"] for token in added)])
        self.specials = {token["content"]: token["id"] for token in added}
        self.byte_ids = np.array([ids[symbol] for symbol in symbols], np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks = keys[order], order
        self._made = np.array([ids[a + b] for a, b in merges], np.int64)[order]
        spelled = [b""] * self.size
        for token, number in ids.items():
            spelled[number] = bytes(byte_of[c] for c in token)
        for token, number in self.specials.items():
            spelled[number] = token.encode()
        self._lengths = np.array([len(s) for s in spelled], np.int64)
        self._offsets = np.cumsum(self._lengths) - self._lengths
        self._bytes = np.frombuffer(b"".join(spelled), np.uint8)
        decimals = [f"{n},".encode() for n in range(self.size)]
        self._digit_lengths = np.array([len(s) for s in decimals], np.int64)
        self._digit_offsets = np.cumsum(self._digit_lengths) - self._digit_lengths
        self._digits = np.frombuffer(b"".join(decimals), np.uint8)
        self._words = arrays.WordCache(self.merge_words)
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)")

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, ids per word). In each round every word merges all its pairs of the lowest rank."""
        data, offsets = arrays.utf8(words)
        symbols, word = self.byte_ids[data], np.repeat(np.arange(len(words)), np.diff(offsets))
        done_symbols, done_words = [], []
        never = len(self._keys)
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            pair = symbols[:-1] * self.size + symbols[1:]
            place = np.minimum(np.searchsorted(self._keys, pair), never - 1)
            rank = np.full(len(symbols), never)
            known = (self._keys[place] == pair) & (word[1:] == word[:-1])
            rank[:-1][known] = self._ranks[place[known]]
            lowest = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(symbols)))
            best = np.repeat(lowest, lengths)
            open_ = best < never
            take = (rank == best) & open_
            twice = take[1:] & take[:-1]
            if twice.any():  # aaa: of overlapping pairs every second one
                at = np.arange(len(take))
                head = take.copy()
                head[1:] &= ~take[:-1]
                take &= (at - np.maximum.accumulate(np.where(head, at, 0))) % 2 == 0
            done_symbols.append(symbols[~open_])
            done_words.append(word[~open_])
            merged = np.flatnonzero(take)
            symbols[merged] = self._made[place[merged]]
            open_[merged + 1] = False
            symbols, word = symbols[open_], word[open_]
        if not done_words:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        word = np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return np.concatenate(done_symbols)[order], np.bincount(word, minlength=len(words))

    def encode(self, texts: list[str], cache: arrays.WordCache | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids per text)."""
        cache = cache or self._words
        joined, points = arrays.code_points(texts)
        specials = [found.span() for found in self._special.finditer(joined)] if self.specials else []
        starts, kinds = split_words(points, specials)
        ends = np.append(starts[1:], len(points))
        text = np.cumsum(kinds == END) - (kinds == END)
        special = kinds == SPECIAL
        plain = (kinds != END) & ~special
        word_starts, word_ends = starts[plain], ends[plain]
        hashes = arrays.span_hashes(arrays.prefix_sums(points), word_starts, word_ends)
        where, how_many = cache.look(hashes, lambda at: joined[word_starts[at] : word_ends[at]])
        ids = cache.numbers(where, how_many)
        lengths = np.zeros(len(starts), np.int64)
        lengths[plain] = how_many
        lengths[special] = 1
        if special.any():
            whole = np.zeros(int(lengths.sum()), np.int32)
            is_special = np.repeat(special, lengths)
            whole[~is_special] = ids
            whole[is_special] = [self.specials[joined[a:b]] for a, b in zip(starts[special], ends[special], strict=True)]
            ids = whole
        return ids, np.bincount(text, lengths, len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that the ids spell."""
        return arrays.ragged(self._bytes, self._offsets[ids], self._lengths[ids])

    def byte_lengths(self, ids: np.ndarray) -> np.ndarray:
        return self._lengths[ids]

    def decimals(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids in decimal digits, each followed by a comma, and the number of bytes of each."""
        lengths = self._digit_lengths[ids]
        return arrays.ragged(self._digits, self._digit_offsets[ids], lengths), lengths


@lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    """One per process and file, with its cache of words."""
    return Vocabulary(path)


def _sums(lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the lengths of each text's ids, as offsets."""
    total = np.concatenate([[0], np.cumsum(lengths)])
    return total[np.concatenate([[0], np.cumsum(counts)])]


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, token_ids array<int>) of every row's whole text.

    A null text is the empty text and has no ids; rows stand for themselves, also repeated ones and null ids; other
    columns are not read. One narrow pass, no shuffle.
    """
    kind = docs.select(id_column).schema[0].dataType.simpleString()

    def work(batch: pa.RecordBatch):
        texts = arrays.column_texts(batch, "t")
        for begin, end in arrays.blocks(texts):
            ids, counts = vocabulary(path).encode(texts[begin:end])
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("i").slice(begin, end - begin), lists], ["i", "token_ids"])

    rows = docs.select(F.col(id_column).alias("i"), F.col(text_column).alias("t"))
    return arrays.map_batches(rows, work, f"i {kind}, token_ids array<int>", words=True).withColumnRenamed("i", id_column)


def decode(encoded: DataFrame, path: str, id_column: str = "doc_id") -> DataFrame:
    """(id, text) spelled by ``token_ids``; bytes that are not UTF-8 become replacement characters, null ids no text."""
    kind = encoded.select(id_column).schema[0].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("token_ids")
        words, texts = vocabulary(path), []
        for ids in lists:
            values = ids.values
            texts.append(words.decode(values.to_numpy()).tobytes().decode("utf-8", "replace") if values is not None else "")
        return pa.RecordBatch.from_arrays([batch.column("i"), pa.array(texts, pa.string())], ["i", "text"])

    rows = encoded.select(F.col(id_column).alias("i"), "token_ids")
    return arrays.map_batches(rows, work, f"i {kind}, text string").withColumnRenamed("i", id_column)


def round_trip_digests(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): what ``encode`` and ``decode`` give, as digests, in one pass.

    Null and empty texts have no tokens and the digests of the empty text; repeated rows are repeated.
    """
    kind = docs.select(id_column).schema[0].dataType.simpleString()

    def work(batch: pa.RecordBatch):
        texts, words = arrays.column_texts(batch, "t"), vocabulary(path)
        for begin, end in arrays.blocks(texts):
            ids, counts = words.encode(texts[begin:end])
            spelled, digits = words.decode(ids), words.decimals(ids)
            at, digit_at = _sums(words.byte_lengths(ids), counts).tolist(), _sums(digits[1], counts).tolist()
            spelled, digits = memoryview(spelled), memoryview(digits[0])
            listed, decoded = [], []
            for k in range(end - begin):
                listed.append(hashlib.sha256(digits[digit_at[k] : max(digit_at[k], digit_at[k + 1] - 1)]).hexdigest())
                text = bytes(spelled[at[k] : at[k + 1]]).decode("utf-8", "replace")
                decoded.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("i").slice(begin, end - begin), pa.array(counts), pa.array(listed), pa.array(decoded)],
                ["i", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_column).alias("i"), F.col(text_column).alias("t"))
    schema = f"i {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrays.map_batches(rows, work, schema, words=True).withColumnRenamed("i", id_column)
