"""Language mixtures: held-out accuracy, proportions of mixed texts, the estimates against plain Python."""

import math
import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from newslens.llm import language_mix as lm
from newslens.llm.queries import op12_languages

SF = "/root/testdata/sf0.001"


def made_language(seed):
    rng = random.Random(seed)
    letters = rng.sample("abcdefghijklmnopqrstuvwxyzéöñß", 14)
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    return lambda n, rng: " ".join(rng.choice(words) for _ in range(n))


LANGUAGES = {name: made_language(k) for k, name in enumerate(["aa", "bb", "cc"])}


def test_slots_are_those_of_each_word_alone():
    words = ["a", "ab", "größe", "日本", "zz"]
    at, word = lm.slots(words)
    for k, w in enumerate(words):
        alone, _ = lm.slots([w])
        assert (at[:, word == k] == alone).all() and alone.shape[1] == len(w) + 1


def test_words():
    assert lm.words_of("Der der Ⅷ½x 12ab_c² !") == {"der": 2, "x": 1, "ab": 1, "c": 1}
    assert sum(lm.words_of("日" * 50).values()) == 4 and not lm.words_of("12 ... ½ ²")


def test_estimate_against_plain_python():
    rng = np.random.default_rng(2)
    doc = np.repeat(np.arange(5), [1, 4, 9, 30, 2])
    times, logs = rng.integers(1, 5, len(doc)), rng.normal(scale=3, size=(len(doc), 3))
    share, _ = lm.Mixtures(doc, times, logs).estimate(np.ones((5, 3)))
    for d in range(5):
        rows = [(t, [math.exp(x) for x in row]) for t, row in zip(times[doc == d].tolist(), logs[doc == d].tolist(), strict=True)]
        p = [1 / 3] * 3
        for _ in range(lm.ROUNDS):
            sums = [0.0] * 3
            for t, likely in rows:
                total = sum(a * b for a, b in zip(p, likely, strict=True))
                sums = [s + t * a * b / total for s, a, b in zip(sums, p, likely, strict=True)]
            fresh = [s / sum(t for t, _ in rows) for s in sums]
            still = max(abs(a - b) for a, b in zip(fresh, p, strict=True)) <= lm.STILL
            p = fresh
            if still:
                break
        assert np.allclose(share[d], p, atol=1e-9)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    data = [(k, LANGUAGES[name](rng.randrange(5, 80), rng), name) for k in range(300) for name in [rng.choice(sorted(LANGUAGES))]]
    mixed = [(1000 + k, f"{LANGUAGES['aa'](60, rng)} {LANGUAGES['bb'](30 + 2 * k, rng)}", None) for k in range(10)]
    odd = [(2000, None, "aa"), (2001, "", "aa"), (2002, "12 34 !? ½", "bb"), (None, LANGUAGES["cc"](9, rng), "cc"), (2003, LANGUAGES["bb"](20_000, rng), None)]
    return data, mixed, odd


def test_mixtures_and_edges(spark, corpus, tmp_path):
    data, mixed, odd = corpus
    ddl = "doc_id long, text string, lang string, doc string, score string, languages string"
    every = [(*row, "d", "s", "l") for row in data + mixed + odd + data[:3]]
    docs = spark.createDataFrame(every, ddl).repartition(3)
    model = lm.fit(docs, F.col("doc_id") % 2 == 0)
    assert model.languages == ["aa", "bb", "cc"]
    found = {r["doc"]["doc_id"]: r for r in lm.mixtures(docs, model, ["doc_id", "languages"]).collect()}
    for i, _, name in data:
        assert found[i]["lang_pred"] == name and found[i]["score"] > 0.9, i
    for k, (i, _, _) in enumerate(mixed):
        shares = {s["lang"]: s["share"] for s in found[i]["languages"]}
        assert set(shares) == {"aa", "bb"} and abs(shares["aa"] - 60 / (90 + 2 * k)) < 0.1
    for i in (2000, 2001, 2002):
        assert (found[i]["lang_pred"], found[i]["score"], found[i]["languages"]) == ("und", 0.0, [])
    assert found[None]["lang_pred"] == "cc" and found[2003]["lang_pred"] == "bb"

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = op12_languages(spark, str(tmp_path)).collect()
    assert len(rows) == len(every)
    for r in rows:
        assert r["held_out"] == (r["doc_id"] is None or crc32(str(r["doc_id"]).encode()) % 5 == 0)
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op12_languages(spark, f"{tmp_path}/none").collect() == []
    docs.withColumn("lang", F.lit(None).cast("string")).write.parquet(f"{tmp_path}/unlabelled/documents.parquet")
    assert {r["lang_pred"] for r in op12_languages(spark, f"{tmp_path}/unlabelled").collect()} == {"und"}


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("lang").alias("truth"))
    rows = op12_languages(spark, sf).join(docs, "doc_id").where("held_out and truth is not null").collect()
    right = sum(r["lang_pred"] == r["truth"] for r in rows)
    assert len(rows) > 100 and right / len(rows) > 0.98
