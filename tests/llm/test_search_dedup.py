"""Top-k, near duplicates, long repeats and the pipeline against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest

import corpus_pipeline
from newslens.llm import near_dups, repeats, top_k
from newslens.llm.components import components
from newslens.session import working_path

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("block_rows", [7, 10_000])
def test_top_k(spark, block_rows):
    rng = np.random.default_rng(5)
    vectors = [(k, rng.normal(size=8).tolist(), "v") for k in range(150)] + [(200 + k, [0.25] * 8, "v") for k in range(30)]
    bad = [(300, None, "v"), (301, [None, *[0.1] * 7], "v"), (302, [float("nan")] * 8, "v"), (303, [float("inf")] * 8, "v"), (None, [1.0] * 8, "v")]
    odd = [(400, [1.0, 2.0], "v"), (410, [2.0, 1.0], "v"), (500, [], "v"), (420, [0.0] * 8, "v")]
    df = spark.createDataFrame(vectors + bad + odd + vectors[:3], "vec_id long, embedding array<double>, v string")
    whole = top_k.whole_numbers(df, "vec_id", "embedding")
    got = top_k.top_k(whole, whole.where("vec_id % 10 = 0"), 5, block_rows).collect()
    rows = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v, _ in vectors + odd + vectors[:3]]
    expected = []
    for q in sorted({i for i, _ in rows if i % 10 == 0}):
        mine = next(v for i, v in rows if i == q)
        scored = sorted((-sum(a * b for a, b in zip(mine, v, strict=True)), i) for i, v in rows if i != q and len(v) == len(mine))
        expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:5], 1)]
    assert sorted(tuple(r) for r in got) == sorted(expected)
    assert top_k.top_k(whole.limit(0), whole.limit(0)).count() == 0


def test_threshold_stops_early():
    rng = np.random.default_rng(1)
    block = top_k.Block(np.arange(4000), rng.integers(-50, 50, (4000, 6)))
    block.search(-1, np.array([100, 0, 0, 0, 0, 1]), 5)
    assert block.search(-1, np.array([100, 0, 0, 0, 0, 1]), 5)[2] < 2000


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (7, 7), (9, 8), (8, 10), (10, 11), (11, 12), (1, 3), (1, 2)] + [(100 + k, 101 + k) for k in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long"), working_path(spark, "test-cc")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4} | dict.fromkeys(range(8, 13), 8) | dict.fromkeys(range(100, 141), 100)
    assert components(spark.createDataFrame([], "u long, v long"), working_path(spark, "test-cc")).count() == 0


def shingle_set(text):
    words = [w for w in (text or "").lower().replace("\n", " ").replace("\t", " ").split(" ") if w]
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())


def test_near_duplicates_of_made_texts(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(300)]

    def changed(words, times):
        words = list(words)
        for _ in range(times):
            words[rng.randrange(len(words))] = word()
        return " ".join(words)

    shared = [word() for _ in range(60)]
    rows = [(1, " ".join(base)), (2, " ".join(base).upper()), (3, changed(base, 3)), (4, changed(base, 5)), (5, None), (6, ""), (7, "few words"), (8, "Few  words")]
    rows += [(100 + k, " ".join(shared + [word() for _ in range(60)])) for k in range(40)]
    rows += [(200, " ".join(base[150:] + base[:150])), (9, "other words"), (None, " ".join(base)), (1, " ".join(base))]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, node int")
    found = near_dups.classes(docs, working_path(spark, "test-near"))
    got = collections.defaultdict(set)
    for r in found.collect():
        got[r.doc_id].add(r.class_id)
    assert all(got[i] == {1} for i in (1, 2, 3, 4, None)) and got[5] == got[6] == {5} and got[7] == got[8] == {7}
    assert got[9] == {9} and all(got[100 + k] == {100 + k} for k in range(40))
    assert got[200] == {200}  # the same parts in another order are no near duplicate
    kept = near_dups.one_of_each(docs, found).collect()
    assert sorted(r.doc_id for r in kept) == sorted([1, 5, 7, 9, 200, *range(100, 140)]) and kept[0].node == 0
    assert near_dups.classes(docs.limit(0), working_path(spark, "test-near")).count() == 0


def test_near_duplicates_lose_no_link(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r.class_id for r in near_dups.classes(docs, working_path(spark, "test-near")).collect()}
    sets = {r.doc_id: shingle_set(r.text) for r in docs.collect()}
    holders, common = collections.defaultdict(list), collections.Counter()
    for i, own in sets.items():
        for s in own:
            holders[s].append(i)
    for own in holders.values():
        common.update((a, b) for k, a in enumerate(own) for b in own[k + 1 :])
    links = [(a, b) for (a, b), n in common.items() if n / (len(sets[a]) + len(sets[b]) - n) >= 0.8]
    assert len(links) > 50 and all(got[a] == got[b] for a, b in links)
    linked = {i for pair in links for i in pair}
    assert all(got[i] == i for i in sets if i not in linked and sets[i])


@pytest.mark.parametrize("held, parts", [(50_000, "8"), (700, "24")])
def test_near_duplicates_behind_a_template(spark, held, parts, monkeypatch):
    monkeypatch.setattr(near_dups, "HELD", held)
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(8))
    texts = []
    for size in (230, 250):  # of 300 shingles: any two are at 0.62 and 0.71
        template = [word() for _ in range(size + 4)]
        for _ in range(600):
            own = [word() for _ in range(300 - size)]
            twin = own[: 268 - size] + [word() for _ in range(32)]  # at 0.807
            texts += [" ".join(template + own), " ".join(template + twin)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    docs = spark.createDataFrame([(i, texts[k]) for i, k in enumerate(order)], "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r.doc_id: r.class_id for r in near_dups.classes(docs, working_path(spark, "test-near")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    sets = [shingle_set(texts[k]) for k in order]
    holders, common = collections.defaultdict(list), np.zeros((len(sets), len(sets)), np.int32)
    for i, own in enumerate(sets):
        for s in own:
            holders[s].append(i)
    for own in holders.values():
        if len(own) > 1:
            common[np.ix_(own, own)] += 1
    sizes = np.array([len(own) for own in sets])
    links = np.argwhere(np.triu(common / (sizes[:, None] + sizes - common) >= 0.8, 1)).tolist()
    assert len(links) == 1200
    assert got == {i: i for i in range(len(sets))} | {b: a for a, b in links}


def brute_repeats(texts):
    data = [(t or "").encode() for t in texts]
    counts = collections.Counter(d[k : k + 200] for d in data for k in range(len(d) - 199))
    made = []
    for d in data:
        gone = np.zeros(len(d) + 1, int)
        for k in range(len(d) - 199):
            if counts[d[k : k + 200]] > 1:
                gone[k : k + 200] = 1
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        made.append((len(d), int(gone.sum()), int((np.diff(np.concatenate([[0], gone])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return made


@pytest.mark.parametrize("parts", ["2", "24"])
def test_long_repeats(spark, parts, monkeypatch):
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdeé \n") for _ in range(n))
    passage, line = text(260), text(120)
    texts = [None, "", "x" * 199, "x" * 200, "x" * 201, "ab" * 300, "abc " * 500, text(900), passage, passage[:199], passage[1:201] + "!" + passage[3:240]]
    texts += [text(300) + passage + text(300), text(50) + passage[20:] + text(400), passage[:230] + text(80) + passage[30:]]
    texts += [text(rng.randint(0, 300)) + line + text(rng.randint(0, 300)) for _ in range(40)] + ["y" * 90 + line + "z" * 90] * 2 + ["y" * 90 + line + "z" * 89 + "w"]
    texts += ["und " * k + text(30) for k in range(40, 70, 3)]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, spans int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        spans = repeats.repeated_spans(docs, working_path(spark, "test-repeats"))
        got = {r.doc_id: tuple(r)[1:] for r in repeats.digests(docs, spans).collect()}
        assert [got[k] for k in range(len(texts))] == brute_repeats(texts)
        monkeypatch.setattr(repeats, "HOT_ROWS", 5)
        hot = repeats.repeated_spans(docs, working_path(spark, "test-repeats"))
        assert {r.doc_id: tuple(r)[1:] for r in repeats.digests(docs, hot).collect()} == got
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    out = repeats.without_repeats(docs, spans)
    assert out.columns == docs.columns and out.count() == len(texts)
    assert repeats.repeated_spans(docs.limit(0), working_path(spark, "test-repeats")).count() == 0


def test_repeated_rows_repeat_each_other(spark):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh ") for _ in range(500))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text[:150])], "doc_id long, text string")
    spans = repeats.repeated_spans(docs, working_path(spark, "test-repeats"))
    assert sorted((str(r.doc_id), r.n_removed) for r in repeats.digests(docs, spans).collect()) == [("1", 500), ("1", 500), ("None", 0)]


def test_pipeline_stages(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    docs, sizes = source, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = working_path(spark, f"test-{name}")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == source.columns
        sizes.append(docs.count())
    assert sizes[0] < source.count() and sizes[0] == sizes[1] >= sizes[2] == sizes[3] > 100
    places = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert places.select("doc_id").distinct().count() == sizes[3]


def test_pipeline_with_edges(spark):
    rows = [(1, None, None, None, None, 5), (None, "", "en", "s", 0, 5), (2, "a " * 80, "en", "s", 160, 5), (2, "a " * 80, "en", "s", 160, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, doc int")
    for made in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, made, SF).count() >= 0
