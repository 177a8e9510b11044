"""Token ids as packed bytes, made with the tokenizers library."""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from newslens.llm import arrays
from newslens.llm.bpe import Vocabulary, vocabulary


#: Ids that a process keeps for words it has met: the library is slow on single words, so more than elsewhere.
LIBRARY_NUMBERS = 4_000_000


@lru_cache(4)
def _library_words(path: str) -> tuple[Vocabulary, arrays.WordCache]:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def work(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [encoding.ids for encoding in tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([n for ids in found for n in ids], np.int64), np.array([len(ids) for ids in found], np.int64)

    return vocabulary(path), arrays.WordCache(work, LIBRARY_NUMBERS)


def library_encode(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, ids per text) by the tokenizers library, which is called once for each new word.

    The words are those that the library's own splitter makes, so the ids are those of the whole texts.
    """
    words, cache = _library_words(path)
    return words.encode(texts, cache)


def id_type(path: str) -> str:
    """Type of packed ids: two bytes if the vocabulary allows it, else four."""
    return "<u2" if vocabulary(path).size <= 1 << 16 else "<u4"
