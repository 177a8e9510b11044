"""The matchers against plain Python, on each of their plans."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import tuples

from newslens.functions.patterns import Patterns, text_bytes
from newslens.operators import matching
from newslens.operators.dimensions import ALIASES

ARTICLES = "article_id bigint, title string, description string, content string"


@pytest.fixture(params=["each", "index", "join"])
def up_to(request, monkeypatch):
    """Each of the three plans."""
    if request.param == "index":
        monkeypatch.setattr(matching, "TRY_EACH_UP_TO", 0)
    return 0 if request.param == "join" else 10**5


def sample(seed=7, count=60):
    """Texts over a tiny alphabet, so that overlaps, repeats and near hits are frequent; one text has most rows' words."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abAé_%\\ ") for _ in range(rng.randint(1, 9)))
    field = lambda: None if rng.random() < 0.15 else " ".join(word() for _ in range(rng.randint(0, 12)))
    articles = [(i, field(), field(), field()) for i in range(count)]
    hot = ("ab ba aab", "bab abab", "aé b")
    articles += [(count + i, *hot) for i in range(count // 2)]
    aliases = [(i % 7, word().strip() or "a") for i in range(40)] + [(1, " "), (2, ""), (3, "a_b"), (4, "%"), (5, "__")]
    return articles, sorted(set(aliases))


def like(text, alias):
    """ILIKE '%alias%' without escape character."""
    pattern = "".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in alias.lower())
    return re.search(pattern, (text or "").lower(), re.S) is not None


def test_substring(rows, up_to):
    articles, aliases = sample()
    texts = [(i, " ".join(x or "" for x in fields).strip()) for i, *fields in articles]
    names = matching.load_aliases(rows(aliases, "company_id bigint, alias string"))
    matched = matching.match_substring(rows(texts, "event_id bigint, article_text string"), names, up_to=up_to)
    expected = sorted(
        (i, t, c) for i, t in texts for c, a in aliases if a.strip(" ") and a.lower() in t.lower()
    )
    assert sorted(tuples(matched.select("event_id", "article_text", "company_id"))) == expected
    once = matching.match_substring(
        rows(texts, "event_id bigint, article_text string"), names, per_alias_hit=False, up_to=up_to
    )
    assert sorted(tuples(once.select("event_id", "article_text", "company_id"))) == sorted(set(expected))


def found_aliases(articles, aliases):
    """(article, company) to [(field rank, alias)]."""
    hits = {}
    for i, *fields in articles:
        for company, alias in aliases:
            if not alias.strip(" "):
                continue
            ranks = [rank for rank, field in enumerate(fields, 1) if like(field, alias)]
            if ranks:
                hits.setdefault((i, company), []).append((ranks[0], alias))
    return hits


def test_best_alias(rows, up_to):
    articles, aliases = sample(11)
    got = matching.match_best_alias(rows(articles, ARTICLES), rows(aliases, "company_id bigint, alias string"), up_to)
    expected = {
        key: min(found, key=lambda h: (h[0], -len(h[1]), h[1].encode()))[1]
        for key, found in found_aliases(articles, aliases).items()
    }
    assert {(r.article_id, r.company_id): r.matched_text for r in got.collect()} == expected
    assert got.count() == len(expected)


def test_alias_list(rows, up_to):
    articles, aliases = sample(13)
    got = matching.match_alias_list(rows(articles, ARTICLES), rows(aliases, "company_id bigint, alias string"), up_to)
    expected = {
        key: ", ".join(sorted({a for _, a in found}, key=lambda a: a.encode()))
        for key, found in found_aliases(articles, aliases).items()
    }
    assert {(r.article_id, r.company_id): r.matched_text for r in got.collect()} == expected
    assert got.count() == len(expected)


def test_alias_across_fields_hits_the_stream_matcher_only(rows):
    article = rows([(1, "about big", "blue today", None)], ARTICLES)
    aliases = rows([(5, "big blue")], "company_id bigint, alias string")
    joined = rows([(1, "about big blue today")], "event_id bigint, article_text string")
    assert matching.match_substring(joined, matching.load_aliases(aliases)).count() == 1
    assert matching.match_best_alias(article, aliases).count() == 0


def test_plain_substring_semantics(rows):
    aliases = rows([(1, "Meta")], "company_id bigint, alias string")
    text = rows([(1, "Metal prices fell"), (2, "nothing")], "event_id bigint, article_text string")
    assert tuples(matching.match_substring(text, matching.load_aliases(aliases)).select("event_id")) == [(1,)]


def test_match_is_scored_once_and_only_if_matched(rows):
    from pyspark.sql import functions as F

    aliases = matching.load_aliases(rows([(1, "x"), (1, "y"), (2, "z")], "company_id bigint, alias string"))
    text = rows([(1, "x y"), (2, "none"), (3, "z")], "event_id bigint, article_text string")
    scored = matching.match_substring(text, aliases, scorer=lambda t: F.length(t).cast("double"))
    assert tuples(scored.select("event_id", "company_id", "sentiment_score"), "event_id") == [
        (1, 1, 3.0), (1, 1, 3.0), (3, 2, 1.0),
    ]


def test_no_aliases_no_rows(rows, up_to):
    aliases = matching.load_aliases(rows([], "company_id bigint, alias string"))
    text = rows([(1, "x y"), (2, None)], "event_id bigint, article_text string")
    assert matching.match_substring(text, aliases, up_to=up_to).count() == 0


def test_scratch_columns_do_not_clash(rows, up_to):
    text = rows([(1, "x y", "h", "k")], "event_id bigint, article_text string, _hits string, _companies string")
    aliases = matching.load_aliases(rows([(1, "X"), (None, "y")], "company_id bigint, alias string"))
    assert tuples(matching.match_substring(text, aliases, up_to=up_to)) == [(1, "x y", "h", "k", 1)]


def test_null_texts_and_long_alias_lists(rows, up_to):
    data = [(1, None), (2, ""), (3, "nine lives of a cat"), (4, "nine lives of a catalogue " * 3000)]
    names = [(k, f"alias number {k}") for k in range(300)] + [(7, "lives of a catalogue n"), (8, "t"), (9, "CAT"), (9, "cat"), (None, "t")]
    aliases = matching.load_aliases(rows(names, "company_id bigint, alias string"))
    got = matching.match_substring(rows(data, "event_id bigint, article_text string"), aliases, up_to=up_to)
    assert sorted(tuples(got.select("event_id", "company_id"))) == [(3, 8), (3, 9), (3, 9), (4, 7), (4, 8), (4, 9), (4, 9)]


def test_a_table_of_too_many_bytes_does_not_travel(rows, monkeypatch):
    aliases = matching.substring_rows(matching.load_aliases(rows([(1, "x" * 50), (2, "y")], "company_id bigint, alias string")))
    assert matching.AliasIndex.load(aliases) is not None
    monkeypatch.setattr(matching, "INDEX_BYTES", 60)
    assert matching.AliasIndex.load(aliases) is None


def test_the_join_rolls_whole_batches_past_its_filter(rows):
    aliases = matching.load_aliases(rows([(1, "ab"), (2, "語文 x")], "company_id bigint, alias string"))
    text = rows([(1, "ab")], "event_id bigint, article_text string")
    plan = matching.match_substring(text, aliases, up_to=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "ArrowEvalPython" in plan


@pytest.mark.parametrize("step", [5, 1 << 20])
def test_anchors_against_plain_python(step, monkeypatch):
    monkeypatch.setattr(matching, "STEP", step)
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcé語") for _ in range(rng.randint(0, 40))) for _ in range(80)] + [None, "", "語" * 9]
    lengths, passes = [1, 3, 7], np.ones(matching.FILTER_BITS, bool)
    number = lambda stretch: (len(stretch) << 56) + int.from_bytes(stretch, "big")
    raw = [(text or "").encode() for text in texts]
    expected = {(k, number(t[i : i + n])) for k, t in enumerate(raw) for n in lengths for i in range(len(t) - n + 1)}
    found = matching.anchors_in(*text_bytes(pa.array(["ab", *texts])[1:]), lengths, passes)
    got = list(zip(*(column.tolist() for column in found), strict=True))
    assert got == sorted(expected)
    passes[:] = False
    passes[matching._slots(np.array([number(b"abc")]))] = True
    only = matching.anchors_in(*text_bytes(pa.array(texts)), lengths, passes)
    assert {(k, number(b"abc")) for k, t in enumerate(raw) if b"abc" in t} <= set(zip(*(column.tolist() for column in only), strict=True))


def test_patterns_against_plain_python():
    rng = random.Random(2)
    word = lambda top: "".join(rng.choice("abcé語") for _ in range(rng.randint(1, top)))
    texts = [word(60) for _ in range(150)] + ["", "a" * 30, None, "語" * 9]
    patterns = sorted({word(14).encode() for _ in range(400)} | {b"a", b"aaaaaaaaaaaaaaaaaaaaaaaaa"})
    array = pa.array(["ab", *texts])[1:]  # a slice: offsets do not begin at zero
    for sample in (b"", "語abc".encode() * 50):
        index = Patterns(patterns).anchored(np.frombuffer(sample, np.uint8))
        got = list(zip(*(column.tolist() for column in index.found(*text_bytes(array))), strict=True))
        assert got == [(t, p) for t, text in enumerate(texts) for p, pattern in enumerate(patterns) if text and pattern in text.encode()]


def test_the_rarest_stretch_is_the_anchor():
    index = Patterns([b"international xq", b"international zz"]).anchored(np.frombuffer(b"international news " * 99, np.uint8))
    (width, _, anchors, _, _, _, _) = index.tables[0]
    assert width == 8 and all(b"x" in int(a).to_bytes(8, "little") or b"z" in int(a).to_bytes(8, "little") for a in anchors)


def test_two_companies_per_seed_alias():
    tickers = [ticker for ticker, _, _ in ALIASES]
    assert len(ALIASES) == 16 and len(set(tickers)) == 12
    assert sorted(t for t in set(tickers) if tickers.count(t) == 2) == ["AMD", "GOOGL", "IBM", "META"]
