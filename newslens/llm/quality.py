"""Quality rules: plain counts of a text, and how well public vocabularies fit it, judged against its own language.

Two vocabularies measure a text: a byte-level BPE (tokens a word, entropy of the tokens) and a piece vocabulary with byte
fallback (characters a token, share of tokens that are single bytes). A document is rejected if a measure lies outside the
band around the median of its language; entropy is compared within the language and the number of tokens (by powers of two), as longer
texts have more, with the nearest sizes where a size has too few texts. Medians are taken over all different texts, so that copies of one text weigh as one.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.functions.lookup import bounded_rows
from newslens.llm import arrays
from newslens.llm.bpe import vocabulary

#: (measure, lowest, highest) times the median of the group; None: no bound.
BANDS = (
    ("tokens_per_word", 0.6, 1.4),
    ("chars_per_token", 0.7, 1.5),
    ("token_entropy", 0.92, 1.2),
)
#: The share of byte tokens may exceed the language's median by so much.
MORE_FALLBACK = 0.15
#: Bands are weighed: those of a language with n different texts count n, those of the script of the text (all languages) so much, and in the same way those
#: of a script against fixed ones. So no group is too small to be judged, and one more text moves an edge a little instead of switching a rule on.
WEIGHT = 10
#: A size of a language (power of two of the tokens) with fewer different texts takes in the nearest sizes until there are enough.
LEAST_TEXTS = 30
#: Scripts by the code point at which a range of them begins ("" is none).
SCRIPTS = (
    (0x0, ""), (0x41, "latin"), (0x5B, ""), (0x61, "latin"), (0x7B, ""), (0xC0, "latin"), (0x250, ""), (0x370, "greek"), (0x400, "cyrillic"),
    (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x780, ""), (0x900, "indic"), (0xE00, "thai"), (0xE80, ""), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, ""), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, ""), (0x3040, "kana"), (0x3100, ""), (0x3400, "han"), (0xA000, ""),
    (0xAC00, "hangul"), (0xD7B0, ""), (0xF900, "han"), (0xFB00, ""),
)
#: Lowest and highest that the two public vocabularies give on sound texts, for Latin script and for any other; entropy is
#: bounded below by a line over the power of two of the tokens.
FIXED_BANDS = {
    "tokens_per_word": {"latin": (0.8, 4.5), "": (0.5, 1e6)},
    "chars_per_token": {"latin": (1.5, 7.0), "": (0.2, 16.0)},
    "fallback_share": {"latin": (0.0, 0.3), "": (0.0, 1.0)},
}
FIXED_ENTROPY, ENTROPY_A_SIZE = 3.5, 0.15
UNKNOWN = "und"
SALTS = 64

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = ("tokens_per_word", "chars_per_token", "fallback_share", "token_entropy")
_SYMBOLS = [ord(c) for c in "#*$%&|<>"]


@lru_cache(2)
def _pieces(path: str) -> arrays.WordCache:
    """For each word its number of tokens and how many of them are single bytes."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    is_byte = np.array([processor.is_byte(k) for k in range(processor.get_piece_size())])

    def work(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = processor.encode(words, num_threads=1)
        lengths = np.array([len(ids) for ids in found])
        flat = is_byte[np.array([n for ids in found for n in ids] or [0])]
        ends = np.concatenate([[0], np.cumsum(flat[: lengths.sum()])])[np.concatenate([[0], np.cumsum(lengths)])]
        return np.stack([lengths, np.diff(ends)], axis=1).reshape(-1), np.full(len(words), 2)

    return arrays.WordCache(work)


def _later_copies(hashes: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Which hashes are equal to an earlier one of their group."""
    order = np.lexsort((hashes, groups))
    same = np.zeros(len(hashes), bool)
    same[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (groups[order[1:]] == groups[order[:-1]])
    return same


def _repeated(hashes: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Which hashes are found twice or more in their group."""
    order = np.lexsort((hashes, groups))
    equal = (hashes[order[1:]] == hashes[order[:-1]]) & (groups[order[1:]] == groups[order[:-1]])
    twice = np.zeros(len(hashes), bool)
    twice[order[1:]] |= equal
    twice[order[:-1]] |= equal
    return twice


def measure(texts: list[str], byte_path: str, piece_path: str) -> dict[str, np.ndarray]:
    """Counts and measures of each text; nothing but zeros for a text without words."""
    n = len(texts)
    joined, points = arrays.code_points(texts)
    breaks = np.flatnonzero(points == arrays.BREAK)
    sums = arrays.prefix_sums(points)
    doc_starts = np.concatenate([[0], breaks[:-1] + 1]) if n else breaks

    def of(at: np.ndarray) -> np.ndarray:
        return np.searchsorted(breaks, at)

    def per_text(at: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(of(at), weights, n)

    wordly = ~((points == 32) | (points >= 9) & (points <= 13) | (points == arrays.BREAK))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], wordly, [False]]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    word_of, hashes = of(starts), arrays.span_hashes(sums, starts, ends)
    n_words = np.bincount(word_of, minlength=n)

    windows = np.flatnonzero(word_of[2:] == word_of[:-2])
    three = hashes[windows] * np.uint64(3) ^ arrays.mixed(hashes[windows + 1]) * np.uint64(5) ^ arrays.mixed(~hashes[windows + 2])
    hit = windows[_repeated(arrays.mixed(three), word_of[windows])]
    covered = np.zeros(len(starts) + 3, bool)
    for k in range(3):
        covered[hit + k] = True

    cuts = np.flatnonzero((points == 10) | (points == arrays.BREAK))
    line_starts = np.concatenate([[0], cuts[:-1] + 1]) if n else cuts
    word_count = np.concatenate([[0], np.cumsum(wordly)])
    lines = word_count[cuts] > word_count[line_starts]
    line_starts, line_ends = line_starts[lines], cuts[lines]
    again = _later_copies(arrays.span_hashes(sums, line_starts, line_ends), of(line_starts))

    begins, names = zip(*SCRIPTS, strict=True)
    kinds = {name: k for k, name in enumerate(dict.fromkeys(names))}  # "" is 0
    kind = np.array([kinds[name] for name in names])[np.searchsorted(begins, points, side="right") - 1]
    kind[points == arrays.BREAK] = 0
    lettered = np.flatnonzero(kind)
    shares = np.bincount(of(lettered) * len(kinds) + kind[lettered], minlength=n * len(kinds)).reshape(n, len(kinds))
    script = np.array(list(kinds))[shares.argmax(axis=1)]

    cache = _pieces(piece_path)
    where, _ = cache.look(hashes, lambda at: joined[starts[at] : ends[at]])
    pairs = cache.numbers(where, np.full(len(where), 2)).reshape(-1, 2)
    pieces, bytes_ = (np.bincount(word_of, pairs[:, k], n) for k in range(2))

    ids, counts = vocabulary(byte_path).encode(texts)
    doc = np.repeat(np.arange(n), counts)
    keys, times = np.unique(doc.astype(np.int64) << 32 | ids.astype(np.int64), return_counts=True)
    share = times / np.maximum(counts, 1)[keys >> 32]
    entropy = -np.bincount(keys >> 32, share * np.log2(share), n)
    word_chars = np.bincount(word_of, ends - starts, n)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": per_text(np.flatnonzero(np.isin(points, _SYMBOLS))),
        "n_dup_lines": per_text(line_starts[again]),
        "n_repeat_words": np.bincount(word_of, covered[: len(starts)], n),
        "n_tokens": counts,
        "tokens_per_word": counts / np.maximum(n_words, 1),
        "chars_per_token": word_chars / np.maximum(pieces, 1),
        "fallback_share": bytes_ / np.maximum(pieces, 1),
        "token_entropy": entropy,
        "script": script,
        "text_hash": arrays.span_hashes(sums, doc_starts, breaks).view(np.int64),
    }


def measured(docs: DataFrame, byte_path: str, piece_path: str, keep: list[str], text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc: struct of the columns to keep, lang, script of most letters, counts, measures) of every row, in one narrow pass over whole texts.

    Kept columns stay in their own struct, so that no name can clash.
    """
    language = F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)) if lang in docs.columns else F.lit(UNKNOWN)
    doc = F.struct(*[F.col(f"`{c}`") for c in keep])
    rows = docs.select(doc.alias("doc"), language.alias("lang"), F.col(text).alias("text"))
    types = {c: "long" for c in (*COUNTS, "n_tokens", "text_hash")} | {c: "double" for c in MEASURES}

    def work(batch: pa.RecordBatch):
        texts = arrays.column_texts(batch, "text")
        for begin, end in arrays.blocks(texts):
            found = measure(texts[begin:end], byte_path, piece_path)
            own = [batch.column(c).slice(begin, end - begin) for c in ("doc", "lang")] + [pa.array(found["script"].tolist(), pa.string())]
            made = [pa.array(found[c].astype(np.int64 if t == "long" else np.float64)) for c, t in types.items()]
            yield pa.RecordBatch.from_arrays([*own, *made], ["doc", "lang", "script", *types])

    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, lang string, script string, " + ", ".join(f"{c} {t}" for c, t in types.items())
    return arrays.map_batches(rows, work, schema, words=True)


def _with_medians(rows: DataFrame, medians: DataFrame, keys: list[str]) -> DataFrame:
    """Medians to all rows: broadcast where their number has been checked, else spread over salts, as one language can be most rows."""
    small = bounded_rows(medians)
    if small is not None:
        return rows.join(F.broadcast(rows.sparkSession.createDataFrame(small, medians.schema)), keys, "left")
    salted = medians.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return rows.withColumn("salt", F.pmod("text_hash", F.lit(SALTS))).join(salted, [*keys, "salt"], "left").drop("salt")


def _pools(single: DataFrame) -> DataFrame:
    """(lang, size, for_size): which sizes of a language make up the median of each size: itself, then the nearest until there are LEAST_TEXTS."""
    sizes = single.groupBy("lang", "size").agg(F.count(F.lit(1)).alias("n"))
    other = sizes.select(F.col("lang").alias("own_lang"), F.col("size").alias("for_size"))
    pairs = sizes.join(other, F.col("lang") == F.col("own_lang")).withColumn("apart", F.abs(F.col("size") - F.col("for_size")))
    nearer = Window.partitionBy("lang", "for_size").orderBy("apart").rangeBetween(Window.unboundedPreceding, -1)
    return pairs.withColumn("nearer", F.coalesce(F.sum("n").over(nearer), F.lit(0))).where(F.col("nearer") < LEAST_TEXTS).select("lang", "size", "for_size")


def _fixed(measure: str, side: int) -> Column:
    bands = FIXED_BANDS[measure]
    return F.when(F.col("script") == "latin", bands["latin"][side]).otherwise(bands[""][side])


def _weighed(n: str, own: Column, other: Column) -> Column:
    """The edge of a group of ``n`` texts, weighed against that of a wider one; no texts, no edge of its own."""
    count = F.coalesce(F.col(n), F.lit(0))
    return F.when(count > 0, (count * own + WEIGHT * other) / (count + WEIGHT)).otherwise(other)


def judged(rows: DataFrame) -> DataFrame:
    """Add ``base_failed`` and ``kept`` to a written table of measured rows.

    The medians are a row for each language, each script, and each power of two of a language's tokens. Documents without words fail; a null language is a
    language of its own. Medians are of numbers rounded to thousandths, so they are the same however the rows are dealt.
    """
    if "script" not in rows.columns:
        rows = rows.withColumn("script", F.lit(""))
    rows = rows.withColumn("size", F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))))
    rows = rows.withColumn(
        "base_failed", (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    )
    narrow = rows.where(~F.col("base_failed")).select("lang", "script", "size", "text_hash", *MEASURES)
    single = narrow.groupBy("text_hash", "lang").agg(*[F.first(c).alias(c) for c in ("script", "size", *MEASURES)])
    middle = lambda of, *names: [F.count(F.lit(1)).alias(f"n_{of}"), *[F.percentile(F.round(c, 3), 0.5).alias(f"{of}_{c}") for c in names]]
    by_lang = single.groupBy("lang").agg(*middle("lang", *FIXED_BANDS))
    by_script = single.groupBy("script").agg(*middle("script", *FIXED_BANDS))
    pooled = _with_medians(single, _pools(single), ["lang", "size"])
    by_size = pooled.groupBy("lang", F.col("for_size").alias("size")).agg(*middle("size", "token_entropy"))
    found = rows
    for medians, keys in ((by_lang, ["lang"]), (by_script, ["script"]), (by_size, ["lang", "size"])):
        found = _with_medians(found, medians, keys)
    factors = {name: (low, high) for name, low, high in BANDS}
    inside = []
    for name in FIXED_BANDS:
        for side in (0, 1):
            edge = lambda of: F.col(f"{of}_{name}") * factors[name][side] if name in factors else F.col(f"{of}_{name}") + side * MORE_FALLBACK  # noqa: E731, B023
            line = _weighed("n_lang", edge("lang"), _weighed("n_script", edge("script"), _fixed(name, side)))
            if name in factors or side:
                inside.append(F.col(name) <= line if side else F.col(name) >= line)
    low, high = factors["token_entropy"]
    size = F.col("size").cast("double")
    inside.append(F.col("token_entropy") >= _weighed("n_size", F.col("size_token_entropy") * low, FIXED_ENTROPY + ENTROPY_A_SIZE * size))
    inside.append(F.col("token_entropy") <= _weighed("n_size", F.col("size_token_entropy") * high, size + 1))
    return found.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.least(*inside), F.lit(False)))


def quality(docs: DataFrame, byte_path: str, piece_path: str, path: str, keep: list[str]) -> DataFrame:
    """(kept columns, counts, measures, base_failed, kept) of every row of ``docs``; ``path``: folder for the measured rows.

    Null texts have no words and fail. Repeated rows are judged alike and all returned. An empty table gives none.
    """
    rows = arrays.written(measured(docs, byte_path, piece_path, keep), path)
    return judged(rows).select("doc", *COUNTS, "n_tokens", *MEASURES, "base_failed", "kept")
