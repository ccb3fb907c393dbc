"""Mixing: targets, balance, probabilities, and the rows of the mix."""

import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from linfit.llm import mixing


def shared_out(sizes, most=3):
    """Targets by sharing the excess again until no source is above its cap."""
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: Fraction(1 + i % 3) for i, s in enumerate(order)}
    full: set = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        goal = {s: Fraction(most * sizes[s]) if s in full else left * weight[s] / free for s in order}
        above = {s for s in order if s not in full and goal[s] > most * sizes[s]}
        if not above:
            return goal
        full |= above


def test_targets_match_repeated_sharing():
    rng = random.Random(1)
    for _ in range(200):
        names = [f"s{i}" for i in range(rng.randrange(1, 9))] + [None] * rng.randrange(2)
        sizes = {s: rng.choice([0, 1, 5, 100, 10_000]) for s in names}
        if sum(sizes.values()):
            assert mixing.targets(sizes) == shared_out(sizes)


def test_walk_keeps_count_words_and_probabilities():
    rng = np.random.default_rng(2)
    sizes = np.concatenate([rng.integers(1, 50, 40), rng.integers(500, 900, 3)])
    p = np.full(len(sizes), 0.3)
    taken = np.zeros(len(sizes))
    for seed in range(600):
        q = mixing.walk(sizes, p, random.Random(seed))
        assert q @ sizes == pytest.approx(p @ sizes, abs=1e-3) and q.sum() == pytest.approx(p.sum(), abs=1e-5)
        assert ((q > 0) & (q < 1)).sum() <= 2
        taken += mixing.land(sizes, q, random.Random(seed + 10_000))
    assert np.abs(taken / 600 - 0.3).max() < 0.1


@pytest.fixture(scope="module")
def found(documents):
    return mixing.mix(documents).collect()


def test_rows_sizes_and_limits(documents, found):
    texts = documents.select("doc_id", "text", "source").collect()
    count = lambda t: len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t or "") if w])
    assert Counter((r.doc_id, r.size) for r in found) == Counter((r.doc_id, count(r.text)) for r in texts)
    sizes = defaultdict(int)
    for r in texts:
        sizes[r.source] += count(r.text)
    goal = {s: float(t) for s, t in mixing.targets(dict(sizes)).items()}
    assert {r.target for r in found} == set(goal.values())
    assert all(r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0) for r in found)


def test_reruns_agree_and_the_mix_has_the_rows(documents, found):
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
    again = mixing.mix(documents.repartition(5)).collect()
    assert sorted(map(key, found)) == sorted(map(key, again))
    rows = mixing.mixed(documents)
    assert rows.columns == documents.columns
    times = Counter(r.doc_id for r in rows.select("doc_id").collect())
    want = Counter()
    for r in found:
        if r.size:
            want[r.doc_id] += r.taken // r.size
    empty = {r.doc_id for r in found if not r.size}
    assert {k: v for k, v in times.items() if k not in empty} == {k: v for k, v in want.items() if v}


def test_sources_come_near_their_targets(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randrange(1, 80), f"s{i % 4}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    total = defaultdict(int)
    goal = {}
    for r in mixing.mix(df).collect():
        total[r.source_size, r.target] += r.taken
        goal[r.source_size, r.target] = r.target
    for k, t in goal.items():
        assert total[k] == pytest.approx(t, rel=0.002)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(none).collect() == [] and mixing.mixed(none).collect() == []
