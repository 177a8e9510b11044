"""Quality rules, licence scan, line dedup and main text against plain Python."""

import collections
import random
import re
import statistics

import public_tokenizers
import pytest

from newslens.llm import arrays, html_text, license_rules, license_scan, line_dedup, quality
from newslens.llm.license_rules import rules
from newslens.session import working_path

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = [None, "", " \n\t", "one", "a b c a b c a b c", "x\nx\nx\n\n", "#*$ % & | < >", "é ü\xa0ñ　ö", "long " * 30_000, "w\x85w w\x1cw"]


def brute_counts(text):
    words = WORD.findall(text or "")
    windows = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_edges(spark):
    docs = spark.createDataFrame([(k, t, None, 1) for k, t in enumerate(EDGES)] + [(0, None, None, 1)], "doc_id long, text string, lang string, kept int")
    rows = quality.quality(docs, BYTES, PIECES, working_path(spark, "test-quality"), docs.columns).collect()
    assert len(rows) == len(EDGES) + 1
    for row in rows:
        counts = brute_counts(row.doc.text)
        assert tuple(row[c] for c in quality.COUNTS) == counts
        assert row.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert row.doc.kept == 1 and not (row.base_failed and row.kept)
    assert quality.quality(docs.limit(0), BYTES, PIECES, working_path(spark, "test-quality"), ["doc_id"]).count() == 0


@pytest.mark.parametrize("bounded", [True, False])
def test_quality_keeps_clean_documents_and_rejects_junk(spark, bounded, monkeypatch):
    if not bounded:
        monkeypatch.setattr(quality, "bounded_rows", lambda df: None)
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality(docs, BYTES, PIECES, working_path(spark, "test-quality"), ["doc_id"]).select("doc.doc_id", "kept", "base_failed")
    table = collections.Counter((r.quality, r.base_failed, r.kept) for r in rows.join(labels, "doc_id").collect())
    assert table[1, False, False] == 0
    assert table[0, False, True] <= 0.1 * sum(n for (q, _, _), n in table.items() if q == 0)


@pytest.mark.parametrize("bounded", [True, False])
def test_quality_of_rare_sizes_is_judged_by_the_nearest(spark, bounded, monkeypatch):
    if not bounded:
        monkeypatch.setattr(quality, "bounded_rows", lambda df: None)
    made = [(k, 1000, 8.0) for k in range(40)] + [(40, 9000, 3.0), (41, 9000, 8.2), (42, 40_000, 3.0)]
    names = [*quality.COUNTS, "n_tokens", "text_hash", *quality.MEASURES]
    rows = [("en", 500, 2000, 0, 0, 0, n, k, 1.3, 4.0, 0.0, entropy) for k, n, entropy in made]
    df = spark.createDataFrame(rows, "lang string, " + ", ".join(f"{c} {'double' if c in quality.MEASURES else 'long'}" for c in names))
    kept = {r.text_hash: r.kept for r in quality.judged(df).collect()}
    assert kept == {k: k not in (40, 42) for k in range(43)}


def kept_in_plain_python(rows):
    """{text_hash: kept} of measured rows, by the words of the docstrings."""
    size = lambda r: max(1, r["n_tokens"]).bit_length() - 1
    sound = {r["text_hash"]: r for r in rows if r["n_words"] >= 50 and 100 * r["n_repeat_words"] <= 50 * r["n_words"]}
    single = {(r["text_hash"], r["lang"]): r for r in rows if r["text_hash"] in sound}.values()

    def edge(members, name, side, wider):
        if not members:
            return wider
        middle = statistics.median(round(r[name], 3) for r in members)
        own = middle + side * quality.MORE_FALLBACK if name == "fallback_share" else middle * {b[0]: b for b in quality.BANDS}[name][1 + side]
        return (len(members) * own + quality.WEIGHT * wider) / (len(members) + quality.WEIGHT)

    def pool(r):
        own = [s for s in single if s["lang"] == r["lang"]]
        for apart in range(64):
            near = [s for s in own if abs(size(s) - size(r)) <= apart]
            if len(near) >= quality.LEAST_TEXTS or len(near) == len(own):
                return near

    verdicts = {}
    for key, r in sound.items():
        ok = True
        for name in quality.FIXED_BANDS:
            for side in (0, 1):
                fixed = quality.FIXED_BANDS[name]["latin" if r["script"] == "latin" else ""][side]
                script = edge([s for s in single if s["script"] == r["script"]], name, side, fixed)
                line = edge([s for s in single if s["lang"] == r["lang"]], name, side, script)
                if (name, side) != ("fallback_share", 0):
                    ok &= r[name] <= line if side else r[name] >= line
        near = pool(r)
        ok &= r["token_entropy"] >= edge(near, "token_entropy", 0, quality.FIXED_ENTROPY + quality.ENTROPY_A_SIZE * size(r))
        ok &= r["token_entropy"] <= edge(near, "token_entropy", 1, size(r) + 1)
        verdicts[key] = ok
    return {r["text_hash"]: verdicts.get(r["text_hash"], False) for r in rows}


def test_quality_against_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = arrays.written(quality.measured(docs, BYTES, PIECES, ["doc_id"]), working_path(spark, "test-quality"))
    found = {r.text_hash: r.kept for r in quality.judged(rows).collect()}
    assert found == kept_in_plain_python([r.asDict() for r in rows.collect()]) and 0 < sum(found.values()) < len(found)


def test_quality_judges_alike_in_groups_of_any_size(spark):
    rng = random.Random(6)
    stems = "Die Regierung hat am Dienstag beschlossen Steuern für kleine und mittlere Unternehmen zu senken um Wachstum zu fördern".split()
    german = [" ".join(rng.choice(stems) + rng.choice(["", "en", "ung"]) for _ in range(120)) for _ in range(31)]
    junk = " ".join("".join(rng.choice("qxzvkjwpbgm") for _ in range(rng.randrange(3, 8))) for _ in range(120))
    for peers in (0, 1, 29, 30, 31):
        data = [(-1, junk, "de")] + [(k, t, "de") for k, t in enumerate(german[:peers])]
        docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
        rows = quality.quality(docs, BYTES, PIECES, working_path(spark, "test-quality"), ["doc_id"]).collect()
        assert {r.doc.doc_id: r.kept for r in rows} == {i: i >= 0 for i, _, _ in data}, peers


def test_scripts():
    texts = ["ein Wort", "слово word слова", "日本 語の", "12 !", "", "عربي"]
    assert quality.measure(texts, BYTES, PIECES)["script"].tolist() == ["latin", "cyrillic", "han", "", "", "arabic"]


def brute_scan(text):
    fold = str.maketrans(license_scan.UPPER, license_scan.LOWER)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(fold))
    at, base = [], set()
    for phrase, label in license_scan.BASE.items():
        parts = phrase.split()
        for k in range(len(words)):
            if words[k : k + len(parts)] == parts:
                at.append(k)
                base.add(label)
    joined = " " + " ".join(words) + " "
    found = set()
    for rule in rules():
        if f" {rule.keyword}" in joined:
            found |= {(*m.span(), rule.priority, rule.score, rule.label) for m in re.finditer(f"(?<= )(?:{rule.pattern})(?= )", joined)}
    labels, score, seen = set(base), 0.5 if at else 0.0, set()
    for one in sorted(found):
        if any(o[:3] != one[:3] and o[0] <= one[0] and o[1] >= one[1] and o[2] >= one[2] for o in found) or one[:3] in seen:
            continue
        seen.add(one[:3])
        labels.add(one[4])
        score = max(score, one[3])
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


LICENSES = [
    "Licensed under CC BY-NC 4.0.", "Released under the MIT License. CC-BY CC BY", "cc by cc by cc by", "The MİT license é license", "mit",
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0. mit license apache license",
    "SPDX-License-Identifier: GPL-2.0-only all rights reserved", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "gnu general public licenses", "apache\nlicense", "mit license " * 3000, None, "", "...",
]


def test_license_scan(spark):
    docs = spark.createDataFrame([(k, t, 1.0) for k, t in enumerate(LICENSES)] + [(None, "cc by", 0.0), (0, LICENSES[0], 1.0)], "doc_id long, text string, score double")
    texts = dict(enumerate(LICENSES)) | {None: "cc by"}
    rows = license_scan.scan(docs).collect()
    assert len(rows) == docs.count()
    for row in rows:
        if row.doc_id != 11:  # the long one: its own count below
            assert tuple(row[1:8]) == brute_scan(texts[row.doc_id])
        else:
            assert (row.n_base, row.first_word, row.last_word, row.labels) == (3000, 0, 5998, "mit")
    assert license_scan.scan(docs.limit(0)).count() == 0


def test_places_of_matches_across_chunks(spark):
    """Places added up by chunks are those added up one by one, at and around the borders of chunks."""
    from pyspark.sql import functions as F

    rng = random.Random(5)
    lists = {n: [(rng.randrange(9), rng.randrange(1, 30)) for _ in range(n)] for n in (0, 1, 255, 256, 257, 513, 2000)}
    made = spark.createDataFrame(list(lists.items()), "n int, pairs array<struct<gap:int,size:int>>")
    for n, spans in made.select("n", license_scan._spans(F.col("pairs"))).collect():
        at, expected = 0, []
        for gap, size in lists[n]:
            expected.append((at + gap, at + gap + size))
            at += gap + size
        assert [tuple(span) for span in spans] == expected


def test_license_rules_are_hundreds_and_sound():
    own = rules()
    assert len(own) > 300 and all(re.compile(rule.pattern) for rule in own)
    assert not [rule for rule in own if not re.search(rf"(?<![a-z0-9]){re.escape(rule.keyword)}", rule.pattern)]


def samples(parsed):
    """A phrase for every choice of alternatives and optional parts of a parsed pattern."""
    made = [""]
    for kind, value in parsed:
        if str(kind) == "LITERAL":
            own = [chr(value)]
        elif str(kind) == "NOT_LITERAL":
            own = ["x"]
        elif str(kind) == "IN":
            own = [chr(v if str(k) == "LITERAL" else v[0]) for k, v in value]
        elif str(kind) == "SUBPATTERN":
            own = samples(value[3])
        elif str(kind) == "BRANCH":
            own = [phrase for branch in value[1] for phrase in samples(branch)]
        else:
            assert str(kind) == "MAX_REPEAT"
            own = ([""] if value[0] == 0 else []) + [max(value[0], 1) * phrase for phrase in samples(value[2])]
        made = [before + after for before in made for after in own]
    return made


def test_license_rules_match_nothing_without_their_keyword():
    for label, keyword, pattern in license_rules._table(license_rules.NAMES) + license_rules._table(license_rules.SIGNATURES):
        phrases = samples(re._parser.parse(pattern))
        assert all(re.fullmatch(pattern, phrase) for phrase in phrases)
        assert not [(label, phrase) for phrase in phrases if f" {keyword}" not in f" {phrase} "]


def test_license_cores_gate_all_wordings_of_a_name(spark):
    from dataclasses import replace

    names = [rule for rule in rules() if rule.core]
    assert len(names) == len(license_rules.WORDINGS) * len(license_rules._table(license_rules.NAMES))
    texts = ["licensed under the gnu gpl v3 or later mit", "open general public domain", "subject to the terms of the mit license bsd style license", "gplv2"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plain = license_scan.scan(docs, [replace(rule, core="") for rule in rules()])
    assert sorted(license_scan.scan(docs).collect()) == sorted(plain.collect())
    wrong = [replace(rule, core="never there") for rule in names]  # a rule whose core is missing is not tried
    assert {r.n_detections for r in license_scan.scan(docs, wrong).collect()} == {0}


def test_license_scan_finds_every_alternative(spark):
    texts = {1: "licensed under the GNU Library General Public License v2", 2: "not without the express written permission of the owner"}
    got = {r.doc_id: r.labels for r in license_scan.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert "lgpl-2.0" in got[1] and "gpl-2.0" not in got[1].split(",") and got[2] == "proprietary"


def brute_lines(rows, least, keep_first):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans(license_scan.UPPER, license_scan.LOWER))
    docs = {}
    for i, t in rows:
        for pos, line in enumerate((t or "").split("\n")):
            if key(line):
                docs.setdefault(key(line), set()).add((i, t or ""))
    gone = {k for k, d in docs.items() if len(d) >= least}
    made, seen = {}, set()
    for i, t in rows:
        kept = []
        for line in (t or "").split("\n"):
            k = key(line)
            if k not in gone or keep_first and k not in seen:
                kept.append(line)
            seen.add(k)
        made[i] = "\n".join(kept)
    return made


@pytest.mark.parametrize("least, keep_first", [(1, True), (3, False), (3, True)])
@pytest.mark.parametrize("parts", ["1", "16"])
def test_line_dedup(spark, least, keep_first, parts):
    rows = [(1, " Common \na\n\na"), (2, "COMMON\nb\n"), (3, "common\nc"), (4, None), (5, ""), (6, "common"), (7, "x\nx\nx\nunique é"), (8, "b\nB \nÉ")]
    rows += [(20 + k, f"hot\nown {k}\nhot") for k in range(60)]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, bitmap string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        bitmaps = line_dedup.keep_bitmaps(docs, working_path(spark, "test-lines"), least, keep_first)
        got = {r.doc_id: r.text or "" for r in line_dedup.deduplicated(docs, bitmaps).collect()}
        digests = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.digests(docs, bitmaps).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected = brute_lines(rows, least, keep_first)
    assert got == expected
    for i, t in rows:
        assert digests[i][0] == (t or "").count("\n") + 1
    twice = docs.unionByName(docs)
    assert line_dedup.deduplicated(twice, bitmaps).count() == 2 * len(rows)
    assert line_dedup.keep_bitmaps(docs.limit(0), working_path(spark, "test-lines")).count() == 0


def test_main_text_of_held_out_pages():
    field, right, total = html_text.default_field(), 0, 0
    for blocks, labels in html_text.labelled_pages(150, seed=99):
        right += sum(a == b for a, b in zip(field.states(blocks), labels, strict=True))
        total += len(labels)
    assert right >= 0.98 * total


def test_main_text_of_supplied_pages(spark):
    import html

    rows = html_text.main_text(spark.read.parquet(f"{SF}/pages.parquet")).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for row in rows:
        article = re.search(r"(?s)<article>(.*?)(</article>|$)", pages[row.page_id])[1]
        parts = [html.unescape(re.sub(r"<[^>]*>", " ", part)).split() for part in re.split(r"</?(?:p|h1)>", article)]
        assert row.text == "\n\n".join(" ".join(part) for part in parts if part) and row.n_chars == len(row.text)


def test_leaves_and_edges(spark):
    page = "<p>a&amp;b <i>c</i><br>d<p>e<!-- x > --><script>if (a<b) '<p>'</script> f<ul><li>1<li>2</ul><a title='>'>z</a>"
    assert [leaf.text for leaf in html_text.leaves(page)] == ["a&b c d", "e f", "1", "2", "z"]
    texts = lambda page: [leaf.text for leaf in html_text.leaves(page)]
    assert texts("<article><p>a <svg/> b</p><p>c <math/> d</p><p>e</p></article>") == ["a b", "c d", "e"]
    assert texts("<p>a<svg><title>t</title><text>no</text><path d='M0'/></svg>b</p><svg><g><p>c</p>") == ["ab", "c"]
    assert texts("<head><title>t</title><meta charset=utf-8><style>s</style><p>a</p>b") == ["a", "b"]
    assert texts("<html><head><title>t</title><link rel=x>\n  plain text <b>c</b>") == ["plain text c"]
    assert texts("<html><head><script>x</script></head><body>a</body></html>") == ["a"]
    assert texts("""<p class=lead">He said "yes, of course" to everyone.</p><p title='a>b' id = "x>y">c</p><p data-x=">d</p>""") == [
        'He said "yes, of course" to everyone.', "c", "d",
    ]
    assert texts("<p>x <math><mi>a</mi><mo>+</mo><mi>b</mi></math> y</p><xmp>a &amp; <b></xmp>z") == ["x a+b y", "a &amp; <b>", "z"]
    assert html_text.leaves("") == [] and html_text.leaves("<<<>\x00<p") != None  # noqa: E711
    assert len(html_text.leaves("<div>" * 3000 + "x")) == 1 and html_text.leaves("<a href=\"" * 5000) is not None
    docs = spark.createDataFrame([(1, None, None, 3), (2, "u", "", 3), (2, "u", "", 3), (None, "v", "<article><p>Some text here.</p></article>", 3)], "page_id long, url string, html string, text int")
    got = html_text.main_text(docs).collect()
    assert sorted(r.text for r in got) == ["", "", "", "Some text here."]
    assert html_text.main_text(docs.limit(0)).count() == 0
