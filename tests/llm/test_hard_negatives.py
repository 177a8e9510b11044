"""Hard negatives against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from newslens.llm import hard_negatives as hn
from newslens.session import working_path

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, anchor, percent=80):
    """rows: (vec_id, label, whole numbers)."""
    found, seen = [], set()
    last = lambda i: (i is None, i or 0)
    for i, label, v in rows:
        if i is None or not anchor(i) or (i, label, tuple(v)) in seen:
            continue
        seen.add((i, label, tuple(v)))
        others = [(-sum(a * b for a, b in zip(v, w, strict=True)), last(j), j, other) for j, other, w in rows if j != i and len(w) == len(v)]
        others.sort(key=lambda o: o[:2])
        for p, _, positive, _ in [o for o in others if o[3] == label][:5]:
            fit = [o for o in others if o[3] != label and percent * -p <= 100 * -o[0] <= 100 * -p][:5]
            found += [(i, positive, rank, o[2], -p, -o[0]) for rank, o in enumerate(fit, 1)]
    return sorted(found, key=str)


def whole(rows, scale):
    ok = lambda x: x is not None and math.isfinite(x)
    return [(i, label, [math.floor(scale * x) for x in v]) for i, v, label in rows if label is not None and v is not None and all(map(ok, v))]


@pytest.mark.parametrize("block_rows", [40, 100_000])
def test_mined_against_brute_force(spark, block_rows):
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(4, 8))
    data = [(k, (middles[k % 4] * (k % 3 > 0) + rng.normal(size=8)).tolist(), int(k % 5)) for k in range(300)]
    data += [(1000 + k, [0.5] * 8, int(k % 3)) for k in range(60)]  # one common vector
    data += data[:2] + [(None, [0.5] * 8, 1), (None, [0.25] * 8, 2), (1100, [0.0] * 8, 1), (1110, [1.0, 2.0], 1), (1111, [1.0, 2.0], 2), (1112, [2.0, 2.0], 1)]
    data += [(2000, None, 1), (2010, [None, *[0.1] * 7], 1), (2020, [float("nan")] * 8, 1), (2030, [float("-inf")] * 8, 1), (2040, [0.5] * 8, None), (2050, [], 1), (2051, [], 2)]
    df = spark.createDataFrame([(*row, "x", "y") for row in data], "vec_id long, embedding array<double>, label int, own string, v string")
    rows = hn.whole_numbers(df, 256, "vec_id", "embedding", F.col("label"))
    got = hn.mine(rows, F.col("vec_id") % 10 == 0, working_path(spark, "test-mine"), block_rows=block_rows)
    assert got.columns == COLUMNS
    expected = brute(whole(data, 256), lambda i: i % 10 == 0)
    assert len(expected) > 300
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected
    assert hn.mine(rows.limit(0), F.col("vec_id") % 10 == 0, working_path(spark, "test-mine")).count() == 0


def test_large_numbers_are_exact(spark):
    data = [(k, [float(10**9 + k), float(k)], k % 2) for k in range(20)]
    rows = hn.whole_numbers(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int"), 1, "vec_id", "embedding", F.col("label"))
    got = hn.mine(rows, F.col("vec_id") % 5 == 0, working_path(spark, "test-mine"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(whole(data, 1), lambda i: i % 5 == 0)


def test_walks_stop_early():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-20, 20, (20_000, 8)) * np.where(rng.random(20_000) < 0.05, 10, 1)[:, None]
    block = hn.Block(np.arange(20_000), np.zeros(20_000, bool), np.zeros(20_000, np.int64), vectors)
    members = rng.integers(95, 105, (10, 8))
    needs = [[hn.Need.between(hn.LOWEST, hn.HIGHEST)] for _ in members]
    hn.walk(block, np.arange(10) - 100, np.zeros(10, np.int64), members, needs, True, 5)
    assert block.read < 10 * 20_000 / 4
    for member, (need,) in zip(members, needs, strict=True):
        assert sorted((vectors @ member).tolist())[-5:] == sorted(need.scores.tolist())
