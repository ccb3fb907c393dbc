"""Connected components against union-find."""

import random

from linfit.llm.common import components


def test_components_match_union_find(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 560)]
    edges += [(rng.randrange(1000, 1300), rng.randrange(1000, 1300)) for _ in range(160)]
    edges += [(7, 7), (None, 8), (9, None), (560, 500), (100, 101)]
    parent = {}

    def top(v):
        parent.setdefault(v, v)
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    df = spark.createDataFrame(edges, "a long, b long")
    found = components(df, "test").collect()
    assert {r.id: r.root for r in found} == {v: top(v) for v in parent}
    assert len(found) == len(parent)
    assert components(df.limit(0), "none").collect() == []
