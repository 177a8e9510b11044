"""BPE, token files and packing against the tokenizers library and exact round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from newslens.llm import arrays, bpe, packing, token_files
from newslens.session import working_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = (
    "' 's 're 'll 't 'd 'm a B é ß 1 ² ٣ ! … — <|endoftext|> re s ll 日本 🙂 ſ".split()
    + [" ", "  ", "\n", "\t", "　", "\xa0", "́", "\x1c", "\x85", ""]
)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts_of(seed, count):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 25))) for _ in range(count)]


def split_ids(texts):
    ids, counts = bpe.vocabulary(PATH).encode(texts)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


def test_encodes_like_the_library(library):
    texts = texts_of(1, 4000) + ["", "a" * 5000, "ab" * 777, "=" * 301, "don't we'll", "  'sabc's's"]
    assert split_ids(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_every_kind_of_character_is_classed_like_the_library(library):
    points = [*range(0x3000), *range(0xA000, 0xD800), *range(0xE000, 0x12000), *range(0x1F000, 0x20000)]
    texts = [f"a{chr(p)} 1{chr(p)}!{chr(p)}" for p in points]
    assert split_ids(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_small_caches_and_blocks_change_nothing(library):
    vocabulary, texts = bpe.Vocabulary(PATH), texts_of(2, 300)
    cache = arrays.WordCache(vocabulary.merge_words, limit=10)
    for begin, end in arrays.blocks(texts, 50):
        ids, _ = vocabulary.encode(texts[begin:end], cache)
        assert ids.tolist() == [n for t in texts[begin:end] for n in library.encode(t, add_special_tokens=False).ids]


def test_round_trip_over_rows(spark, library):
    rows = [(1, "Hello  <|endoftext|> wörld"), (1, "Hello  <|endoftext|> wörld"), (None, None), (2, ""), (3, "x" * 300_000)]
    docs = spark.createDataFrame([(*r, 0, "z") for r in rows], "doc_id long, text string, token_ids int, i string")
    encoded = bpe.encode(docs, PATH)
    expected = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids) for i, t in rows)
    assert sorted((str(r.doc_id), r.token_ids) for r in encoded.collect()) == expected
    assert sorted((str(r.doc_id), r.text) for r in bpe.decode(encoded, PATH).collect()) == sorted((str(i), t or "") for i, t in rows)
    empty = docs.limit(0)
    assert bpe.encode(empty, PATH).count() == 0 and bpe.round_trip_digests(empty, PATH).count() == 0


def test_pack_and_unpack_ranks():
    ranks = np.array([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, 5], np.uint32)
    for size in range(len(ranks) + 1):
        assert token_files.unpack(*token_files.pack(ranks[:size]), size).tolist() == ranks[:size].tolist()


def test_token_files(spark, library):
    rows = [(5, "b b b"), (2, None), (None, "x"), (2, ""), (9, "long " * 4000), (7, "é<|endoftext|>"), (9, "long " * 4000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, shard int")
    files = token_files.write(docs, PATH, working_path(spark, "test-token-files"), end_id=0)
    ids = lambda t: [*library.encode(t or "", add_special_tokens=False).ids, 0]
    assert sorted(map(str, ((r.doc_id, r.token_ids) for r in files.documents().collect()))) == sorted(str((i, ids(t))) for i, t in rows)
    start = 0
    digests = sorted(files.digests().collect(), key=lambda r: r.start)
    assert [r.doc_id for r in digests] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    for row in digests:
        assert row.start == start
        start += row.n_tokens
    crcs = sorted(zlib.crc32(np.array(ids(t), "<u4").tobytes()) for _, t in rows)
    assert sorted(r.ids_crc32 for r in digests) == crcs
    nothing = token_files.write(docs.limit(0), PATH, working_path(spark, "test-token-files"), end_id=0)
    assert nothing.digests().count() == 0


def fill(plan):
    total = np.zeros(plan.sequences, int)
    for length, _, how_many, first, each, _ in plan.places:
        np.add.at(total, first + np.arange(how_many) // each, length)
    return total


@pytest.mark.parametrize("low, high, size", [(1, 1024, 30_000), (300, 700, 8000), (1, 60, 5000), (1024, 1025, 10), (1, 1025, 300)])
def test_packing_is_nearly_full(low, high, size):
    lengths = np.random.default_rng(3).integers(low, high, size)
    plan = packing.plan_lengths(np.bincount(lengths, minlength=1025))
    assert sum(p[2] for p in plan.places) == size and fill(plan).max() <= 1024 and fill(plan).min() > 0
    assert plan.sequences <= 1.02 * -(-lengths.sum() // 1024) + 5


def test_packing_of_few_sizes_is_optimal():
    assert packing.plan_lengths(np.bincount([600] * 1000 + [300] * 500, minlength=1025)).sequences == 1000
    assert packing.plan_lengths(np.bincount([512] * 11, minlength=1025)).sequences == 6
    assert packing.plan_lengths(np.zeros(1025, int)).sequences == 0


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)] and packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(6, 4) == [(0, 2), (2, 4)] and packing.cut(8, 4) == [(0, 4), (4, 4)]


def test_pack_rows(spark, library):
    rows = [(1, "a b c " * 700), (2, None), (None, "hey"), (2, None), (3, "word " * 40)] + [(10 + k, "same text") for k in range(40)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, part int").repartition(5)
    made, places = packing.pack(docs, PATH, working_path(spark, "test-packing"), end_id=2, capacity=64)
    got = places.collect()
    used = {}
    for row in got:
        for k in range(row.offset, row.offset + row.length):
            assert used.setdefault((row.sequence_id, k), row) is row
    for sequence in {s for s, _ in used}:
        assert [k for s, k in sorted(used) if s == sequence] == list(range(sum(s == sequence for s, _ in used)))
    assert len(got) == made.count()
    whole = [n for t in ("a b c " * 700,) for n in library.encode(t, add_special_tokens=False).ids] + [2]
    pieces = sorted((r for r in made.collect() if r.doc_id == 1), key=lambda r: r.piece)
    assert np.concatenate([np.frombuffer(p.ids, "<u2") for p in pieces]).tolist() == whole
    packed = packing.sequences(made, places)
    assert packed.count() == len({r.sequence_id for r in got})
    assert packing.pack(docs.limit(0), PATH, working_path(spark, "test-packing"), end_id=2)[1].count() == 0
