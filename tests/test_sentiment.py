"""Scores against a plain Python form of the published rules."""

import math
import random
import re
import string

from pyspark.sql import functions as F

from newslens.functions import sentiment as s
from newslens.functions.sentiment import Lexicon

WORDS = {"good": 1.9, "great": 3.1, "bad": -2.5, "awful": -2.0, "no": -1.2, "kind": 2.4, "least": 0.7, ":)": 2.0}


def half_up(x):
    return math.copysign(math.floor(abs(x) * 10000 + 0.5) / 10000, x) if x else 0.0


def rule_score(text):
    words = []
    for raw in text.split():
        bare = raw.strip(string.punctuation)
        words.append(raw if len(bare) <= 2 else bare)
    low = [w.lower() for w in words]
    capital = [w.isupper() for w in words]
    mixed = any(capital) and not all(capital)

    def negated(w):
        return w in s.NEGATIONS or "n't" in w

    def word(i):
        return low[i] if i >= 0 else ""

    scores = []
    for i, w in enumerate(low):
        follows = low[i + 1] if i + 1 < len(low) else ""
        if w in s.DEGREES or w not in WORDS or (w == "kind" and follows == "of"):
            scores.append(0.0)
            continue
        v = WORDS[w]
        if w == "no" and follows in WORDS:
            v = 0.0
        if word(i - 1) == "no" or word(i - 2) == "no" or (word(i - 3) == "no" and word(i - 1) in ("or", "nor")):
            v = WORDS[w] * -0.74
        if capital[i] and mixed:
            v += 0.733 if v > 0 else -0.733
        for back, damp in ((1, 1.0), (2, 0.95), (3, 0.9)):
            j = i - back
            if j < 0 or low[j] in WORDS:
                continue
            degree = s.DEGREES.get(low[j], 0.0)
            if degree:
                if v < 0:
                    degree = -degree
                if capital[j] and mixed:
                    degree += 0.733 if v > 0 else -0.733
                v += degree * damp
            between = [word(i - b) for b in range(1, back)]
            if low[j] == "never" and any(b in ("so", "this") for b in between):
                v *= 1.25
            elif low[j] == "without" and "doubt" in between:
                pass
            elif negated(low[j]):
                v *= -0.74
        if word(i - 1) == "least" and "least" not in WORDS and word(i - 2) not in ("at", "very"):
            v *= -0.74
        scores.append(v)
    if "but" in low:
        turn = low.index("but")
        scores = [v * (0.5 if i < turn else 1.5 if i > turn else 1.0) for i, v in enumerate(scores)]
    total = sum(scores)
    marks = min(text.count("!"), 4) * 0.292
    questions = text.count("?")
    marks += 0.0 if questions <= 1 else questions * 0.18 if questions <= 3 else 0.96
    total += marks if total > 0 else -marks if total < 0 else 0.0
    return total / math.sqrt(total * total + 15)


def core_score(text):
    total = sum(round(WORDS.get(w, 0) * 10000) for w in re.findall("[a-z]+", text.lower())) / 10000
    return total / math.sqrt(total * total + 15)


def sentences(count=400):
    rng = random.Random(3)
    pool = [*WORDS, "movie", "very", "not", "isn't", "never", "so", "this", "without", "doubt", "but", "barely", "at"]
    pool += ["or", "nor", "of", "kind", "GOOD", "VERY", "BAD", "great!", "bad?", "(awful)", "a", "ok", "least", "extremely"]
    return [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 14))) + rng.choice(["", "!", "!!!!!", "??", "?????"])
            for _ in range(count)]


def lexicon(rows, words=WORDS):
    return Lexicon.load(rows(list(words.items()), "token string, valence double"))


def check(rows, score, expected):
    texts = sentences()
    df = rows([(t,) for t in texts], "t string").select("t", score(F.col("t")).alias("x"))
    for row in df.collect():
        assert abs(row["x"] - expected(row["t"])) < 0.00006, row["t"]


def test_rules_follow_the_published_method(rows):
    check(rows, lexicon(rows).rule_score, rule_score)


def test_core_is_the_sum_of_valences(rows):
    check(rows, lexicon(rows).core_score, core_score)


def test_rule_directions(rows):
    score = lexicon(rows).rule_score
    texts = ["good", "very good", "barely good", "not good", "GOOD movie", "good!", "good but bad", "", " ", None]
    df = rows([(t,) for t in texts], "t string").select(score(F.col("t")).alias("x"))
    good, very, barely, negated, capital, marked, turned, *blank = (r["x"] for r in df.collect())
    assert very > good > barely > 0 > negated and capital > good and marked > good and turned < 0
    assert blank == [0.0, 0.0, 0.0]


def test_labels(rows):
    df = rows([(0.05,), (-0.05,), (0.0499,), (None,)], "x double").select(s.sentiment_label(F.col("x")))
    assert [r[0] for r in df.collect()] == ["positive", "negative", "neutral", "neutral"]


def test_model_labels(rows):
    labels = ["positive", "mixed", "neutral", "unknown", "negative", "other", None]
    df = rows([(x,) for x in labels], "x string").select(s.ai_label_score(F.col("x")), s.ai_label_folded(F.col("x")))
    assert [tuple(r) for r in df.collect()] == [
        (1.0, "positive"), (0.25, "neutral"), (0.0, "neutral"), (0.0, "neutral"), (-1.0, "negative"), (0.0, "neutral"),
        (0.0, "neutral"),
    ]


def test_score_by_join_equals_expression(rows):
    texts = rows([(i, t) for i, t in enumerate(sentences(100) + [None, ""])], "k bigint, t string")
    table = rows(list(WORDS.items()), "token string, valence double")
    joined = {r["k"]: r["sentiment_score"] for r in s.lexicon_scores_by_join(texts, "k", "t", table).collect()}
    direct = {r["k"]: r["x"] for r in texts.select("k", lexicon(rows).core_score(F.col("t")).alias("x")).collect()}
    assert joined == direct


def test_words_of_any_script_and_with_apostrophes_score(rows):
    table = rows([("don't", -2.0), ("sch\u00f6n", 2.5), ("\u0445\u043e\u0440\u043e\u0448\u043e", 1.5)], "token string, valence double")
    texts = rows([(1, "DON'T"), (2, "Sch\u00f6n."), (3, "'\u0445\u043e\u0440\u043e\u0448\u043e'"), (4, "don"), (None, None)], "k bigint, t string")
    direct = s.scored(texts, "t", table, "x")
    joined = s.scored_by_join(texts, "t", table, "x")
    assert sorted(map(str, direct.collect())) == sorted(map(str, joined.collect()))
    got = {r.k: r.x for r in direct.collect()}
    assert got[1] < 0 < got[3] < got[2] and got[4] == got[None] == 0.0


def test_word_list_beyond_the_limit_is_joined(rows, monkeypatch):
    monkeypatch.setattr(s, "bounded_rows", lambda df: None)
    table = rows(list(WORDS.items()), "token string, valence double")
    texts = rows([(None, t) for t in sentences(40)] * 2, "k bigint, t string")
    got = sorted(r.x for r in s.scored(texts, "t", table, "x").collect())
    monkeypatch.undo()
    assert got == sorted(r.x for r in s.scored(texts, "t", table, "x").collect())


def test_words_in_batches_are_those_of_the_pattern(spark, rows, monkeypatch):
    import numpy as np
    import pyarrow as pa

    from newslens.functions import words
    from newslens.functions.patterns import text_bytes

    rng = random.Random(3)
    drawn = lambda: "".join(rng.choice("aB''é語 \u0301𝒜İ-1") for _ in range(rng.randint(0, 30)))
    texts = [*(drawn() for _ in range(300)), None, "", "a", "'", "a'", "'a", "b" * 20, "best's", "ǅ'ａ"]
    listed = [("a", 1.0), ("b", 2.5), ("a'b", -3.0), ("é", 0.5), ("語", 0.25), ("b" * 20, 4.0), ("best's", 3.2), ("a\u0301", -0.7), ("no word", 9.0)]
    table = rows(listed, "token string, valence double")
    df = rows(list(enumerate(texts)), "id int, text string")
    value = dict(listed)
    tokens = df.select("id", s.word_tokens(F.coalesce("text", F.lit(""))).alias("w")).orderBy("id").collect()
    expected = [round(sum(round(value.get(w, 0) * 10_000) for w in r.w)) for r in tokens]
    packed = words.letters(spark.sparkContext.applicationId, s.LETTER)
    index = words.ListedWords({w: round(v * 10_000) for w, v in listed}, packed)
    lowered = [r.t for r in df.select("id", F.lower("text").alias("t")).orderBy("id").collect()]
    for step in (1, 40, 1 << 20):
        monkeypatch.setattr(words, "STEP", step)
        data, offsets = text_bytes(pa.array(["a b", *lowered])[1:])
        assert index.totals(data, np.asarray(offsets)).tolist() == expected
    scores = df.select("id", Lexicon.load(table).core_score(F.col("text")).alias("x"))
    assert "ArrowEvalPython" in scores._jdf.queryExecution().optimizedPlan().toString()
    joined = s.lexicon_scores_by_join(df, "id", "text", table)
    assert sorted(map(tuple, scores.collect())) == sorted(map(tuple, joined.collect()))


def test_the_join_of_a_word_list_reads_texts_twice_and_keeps_listed_words_only(rows):
    texts = rows([(1, "good good no-one"), (2, "good good no-one"), (3, None), (None, "nothing listed")], "id int, text string")
    scores = s.lexicon_scores_by_join(texts, "id", "text", rows(list(WORDS.items()), "token string, valence double"))
    plan = scores._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2 and "filter(regexp_extract_all" in plan
    both = half_up(2.6 / math.sqrt(2.6 * 2.6 + 15))
    assert sorted(map(tuple, scores.collect()), key=str) == sorted([(1, both), (2, both), (3, 0.0), (None, 0.0)], key=str)
