"""Mined negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linfit.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, is_anchor, p=5, k=3, least=50, most=95):
    rows = {(i, tuple(v), c) for i, v, c in rows if i is not None and v is not None and c is not None and all(x is not None and math.isfinite(x) for x in v)}
    rows = [(i, v, tuple(math.floor(256 * x) for x in v), c) for i, v, c in rows]
    out = []
    for a in rows:
        if not is_anchor(a[0]):
            continue
        near = [(-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[3]) for b in rows if b is not a and len(b[1]) == len(a[1])]
        near.sort()
        for s, i, _ in [x for x in near if x[2] == a[3]][:p]:
            fit = [x for x in near if x[2] != a[3] and least * -s <= -100 * x[0] <= most * -s][:k]
            out += [(a[0], i, r + 1, x[1], -s, -x[0]) for r, x in enumerate(fit)]
    return sorted(out)


def got(df):
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert df.columns == list(columns)
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    rows = [(i, [rng.choice([-0.5, 0.1, 0.25, 0.7]) for _ in range(4)], rng.randrange(3)) for i in range(400)]
    rows += [(1000 + i, [0.5, 0.25, 0.5, 0.125], i % 4) for i in range(40)]
    rows += [(2000 + i, [0.3, 0.1 * i], i % 2) for i in range(12)] + [(2100, [], 1), (2102, [], 0)]
    rows += [(5, [0.7] * 4, 1), (5, [0.7] * 4, 1), (10, [0.7, 0.7, 0.7, -0.5], 2), rows[20], rows[20]]
    rows += [(None, [0.1] * 4, 1), (3000, None, 1), (3010, [0.1] * 4, None), (3020, [None, 0.1, 0.1, 0.1], 1), (3030, [math.nan, 0.1, 0.1, 0.1], 1), (3040, [math.inf, 0.1, 0.1, 0.1], 1), (3050, [0.0] * 4, 1)]
    return rows


def test_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit(c) for c in ("key", "block", "rank", "score", "v", "dim")})
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 200
    assert got(negatives.mine(df, F.col("vec_id") % 10 == 0)) == want


def test_small_blocks_and_flushes_change_nothing(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name, value in (("ROWS", 37), ("ANCHORS", 7)):
        monkeypatch.setattr(negatives, name, value)
    want = brute(rows, lambda i: i % 10 == 0, 4, 2, 30, 90)
    assert got(negatives.mine(df, F.col("vec_id") % 10 == 0, 4, 2, 30, 90)) == want


def test_nothing_is_broadcast(spark, rows, monkeypatch):
    plans, stored = [], negatives.stored

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(negatives, "stored", seen)
    found = negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sum("Join" in p for p in plans) >= 3
    assert not any("Broadcast" in p for p in plans)


def test_few_rows(spark):
    one = spark.createDataFrame([(0, [1.0, 0.0], 1)], SCHEMA)
    assert got(negatives.mine(one, F.col("vec_id") >= 0)) == []
    assert got(negatives.mine(one.limit(0), F.col("vec_id") >= 0)) == []
    some = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.6], 2)]
    df = spark.createDataFrame(some, SCHEMA)
    assert got(negatives.mine(df, F.col("vec_id") == 0)) == [(0, 1, 1, 2, 65536, math.floor(0.6 * 256) * 256)]


def test_scores_are_exact_or_raise():
    rng = np.random.default_rng(1)
    a, b = (np.floor(rng.normal(size=(6, 5)) * 1e8) for _ in range(2))
    want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
    assert negatives.scores(a, b).tolist() == want
    assert negatives.scores(np.zeros((2, 0)), np.zeros((3, 0))).tolist() == [[0] * 3] * 2
    with pytest.raises(ValueError, match="56 bits"):
        negatives.scores(np.full((1, 1), 2.0**40), np.full((1, 1), 2.0**40))
    with pytest.raises(ValueError, match="too large"):
        negatives.scores(np.full((1, 1), np.inf), np.ones((1, 1)))


def test_best_merges_as_one_sort():
    rng = np.random.default_rng(2)
    best, whole = negatives._Best(3), []
    for _ in range(40):
        part = tuple(rng.integers(0, top, 9000) for top in (50, 20, 100, 5))
        best.add(*part)
        whole += zip(*(p.tolist() for p in part), strict=True)
    want = []
    for g in range(50):
        want += sorted((x for x in whole if x[0] == g), key=lambda x: (-x[1], x[2], x[3]))[:3]
    assert list(zip(*(p.tolist() for p in best.result()), strict=True)) == want
