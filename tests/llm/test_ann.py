"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from linfit.llm import ann

SHAPE = "vec_id long, embedding array<float>, score string, list int"


def brute(rows, k=10):
    """query -> [(vec_id, distance)]"""
    ok = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = min(ok.get(i, v), v)
    lengths = [len(v) for v in ok.values()]
    dim = max(sorted(set(lengths)), key=lengths.count) if lengths else 0
    ok = {i: np.array(v, np.float32).astype(float) for i, v in ok.items() if len(v) == dim}
    out = {}
    for q, x in ok.items():
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in ok.items() if i != q)
            out[q] = [(i, d) for d, i in near[:k]]
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "s", 1) for r in rows], SHAPE)


def results(df):
    out = {}
    for r in sorted(ann.nearest(df, F.col("vec_id") % 100 == 0).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 40))
    rows = [(i, (centres[i % 30] + rng.normal(size=40)).tolist()) for i in range(4000)]
    rows += [(4000 + i, rows[0][1]) for i in range(600)]  # a vector that many rows share
    want, got = brute(rows), results(table(spark, rows))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.9
    at = dict(rows)
    for q, found in got.items():
        assert len(found) == 10 and found == sorted(found, key=lambda f: (f[1], f[0]))
        x = np.array(at[q], np.float32).astype(float)
        for i, d in found:
            assert d == pytest.approx(np.sqrt(((np.array(at[i], np.float32).astype(float) - x) ** 2).sum()), rel=1e-12)
    assert [i for i, _ in got[0]] == list(range(4000, 4010))


def test_small_tables_are_exact(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0])]
    rows += [(6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    rows += [(100, [1.0, 0.0]), (2, [0.0, 5.0]), (-100, [3.0, 3.0])]
    got, want = results(table(spark, rows)), brute(rows)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert results(table(spark, [])) == {} and results(table(spark, [(100, [1.0])])) == {}


def test_scan_abandons_but_finds():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(2000, 64))
    turn = ann.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    r = (v @ turn).astype(np.float32)
    blocks = [r[:, c : c + 16] for c in range(0, 64, 16)]
    hit = 0
    for q in range(40):
        ids, far = ann.scan(v[q], v[q] @ turn, q, np.arange(2000), v, blocks, 10)
        d = ((v - v[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hit += len(set(ids) & set(np.argsort(d)[:10]))
    assert hit / 400 > 0.98
