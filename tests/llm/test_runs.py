"""Runs of words against brute force."""

import hashlib
import random
from zlib import crc32

import numpy as np
import pytest

from newslens.llm import runs
from newslens.llm.queries import op13_runs

SF = "/root/testdata/sf0.001"


def brute_lyndon(symbols):
    found = []
    for i in range(len(symbols)):  # up to the next smaller suffix
        found.append(next((j - i for j in range(i + 1, len(symbols)) if symbols[j:] < symbols[i:]), len(symbols) - i))
    return found


def brute_runs(words, least=12):
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        same = [words[i] == words[i + q] for i in range(n - q)]
        i = 0
        while i < len(same):
            if same[i]:
                j = i
                while j < len(same) and same[j]:
                    j += 1
                length = j - i + q
                part = words[i : i + length]
                smaller = any(all(part[k] == part[k + p] for k in range(length - p)) for p in range(1, q))
                if length >= max(least, 2 * q) and not smaller:
                    found.append((i, length, q))
                i = j
            else:
                i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def sequences():
    rng = random.Random(3)
    yield from ([], [1], [1, 1], [1] * 13, [1, 2] * 7, list(range(30)), list(range(30, 0, -1)))
    for size in (12, 20, 40, 80):
        for letters in (2, 3, 6):
            yield [rng.randrange(letters) for _ in range(size)]
    for _ in range(25):  # nested and neighbouring repetitions
        part = [rng.randrange(3) for _ in range(rng.randrange(1, 9))]
        made = part * rng.randrange(2, 6)
        yield [rng.randrange(9) for _ in range(rng.randrange(4))] + (made + [rng.randrange(3)]) * rng.randrange(1, 4) + part
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 150:
        fib.append(fib[-1] + fib[-2])
    yield fib[-1]
    yield [bin(k).count("1") % 2 for k in range(128)]  # no cubes


def test_lyndon_arrays():
    for symbols in sequences():
        assert runs.lyndon_array(symbols).tolist() == brute_lyndon(symbols), symbols


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_against_brute_force(least):
    every = list(sequences())
    for symbols in every:
        assert [tuple(r) for r in runs.runs(np.array(symbols, np.int64), least).tolist()] == brute_runs(symbols, least), symbols
    words = [[str(s).encode() for s in symbols] for symbols in every]
    assert [[tuple(r) for r in found.tolist()] for found in runs.text_runs(words, least)] == [brute_runs(s, least) for s in every]


def test_time_grows_with_the_words():
    period = list(range(3000)) * 20 + [7] * 50_000
    found = runs.runs(np.array(period, np.int64))
    assert [0, 60_000, 3000] in found.tolist() and [60_000, 50_000, 1] in found.tolist()


def expected(doc_id, text):
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in text or "").split(" ") if w]
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    dropped = {k for s, length, q in found for k in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(" ".join(w for k, w in enumerate(words) if k not in dropped)),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_on_edges(spark, tmp_path):
    rng = random.Random(9)
    data = [(1, None), (2, ""), (3, " \t\r\n "), (None, "a b " * 9), (4, "é x y é x y " * 8), (4, "z " * 40), (4, "z " * 40)]
    for k in range(10, 150):  # a tenth of the ids are rewritten
        data.append((k, " ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(1, 120)))))
    data.append((500, "lorem ipsum dolor\n" * 30 + "x " * 20))
    columns = "doc_id long, text string, id string, runs string, collapsed string, best int"
    spark.createDataFrame([(i, t, "i", "r", "c", 1) for i, t in data], columns).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r[c] for c in COLUMNS) for r in op13_runs(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((expected(i, t) for i, t in data), key=str)
    spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op13_runs(spark, f"{tmp_path}/none").columns == COLUMNS and op13_runs(spark, f"{tmp_path}/none").count() == 0


def test_query_on_the_documents(spark):
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in op13_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        if len((text or "").split()) < 700:
            assert got[doc_id] == expected(doc_id, text)
