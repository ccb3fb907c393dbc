"""Exact and near dedup against brute force."""

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from linfit.llm import exact, near


def test_exact_classes_match_brute_force(documents):
    rows = documents.select("doc_id", "text").collect()
    plain = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in rows]
    groups: dict[str, list] = {}
    for r, t in zip(rows, plain, strict=True):
        groups.setdefault(t, []).append(r.doc_id)
    want = []
    for r, t in zip(rows, plain, strict=True):
        ids = [i for i in groups[t] if i is not None]
        sha = hashlib.sha256(t.encode()).hexdigest()
        want.append((str(r.doc_id), str(min(ids) if ids else None), len(groups[t]), sha))
    found = exact.exact_classes(documents).collect()
    got = [(str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in found]
    assert sorted(got) == sorted(want)
    # One row of each text stays, even where its doc_id repeats.
    kept = [r.text_sha256 for r in found if r.kept]
    assert sorted(kept) == sorted(set(r.text_sha256 for r in found))
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_kept_documents_have_their_columns(documents):
    out = exact.keep_first(documents)
    assert out.columns == documents.columns
    assert out.count() == exact.exact_classes(documents).where("kept").count()


def test_many_runs_merge(spark):
    rows = [(i, f"text {i % 37}") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    found = exact.exact_classes(df).collect()
    assert all(r.keep_id == r.doc_id % 37 and r.kept == (r.doc_id < 37) for r in found)
    _, merged = exact.digest_classes(df, fan_in=2)
    assert merged.count() == 37


def test_lengths_under_one_digest_must_agree():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict(
        {
            "shard": pa.array([0, 0], pa.int32()),
            "run": pa.array([0, 0], pa.int64()),
            "digest": pa.array([b"x" * 32] * 2, pa.binary()),
            "n_chars": pa.array([3, 4], pa.int64()),
            "doc_id": pa.array([1, 2], pa.int64()),
            "at": pa.array([0, 1], pa.int64()),
            "docs": pa.array([1, 1], pa.int64()),
        }
    )
    with pytest.raises(ValueError, match="one digest"):
        list(exact._merge(iter([batch])))


def matched(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row
        row = [0]
        for j, y in enumerate(b):
            row.append(max(before[j + 1], row[-1], before[j] + (x == y)))
    return row[-1]


def alike(x: str, y: str) -> bool:
    a, b = x.split(), y.split()
    if not a or not b:
        return False
    k = 5
    p = [tuple(a[i : i + min(k, len(a))]) for i in range(max(1, len(a) - k + 1))]
    q = [tuple(b[i : i + min(k, len(b))]) for i in range(max(1, len(b) - k + 1))]
    m = matched(p, q)
    return m / (len(p) + len(q) - m) >= near.SIMILARITY - 1e-12


def copies(rng: random.Random) -> list[tuple[int, str]]:
    words = [f"w{i}" for i in range(400)]
    out = []
    for base in range(12):
        text = [rng.choice(words) for _ in range(rng.randrange(3, 120))]
        for _ in range(rng.randrange(1, 7)):
            own = list(text)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(words)
            out.append(" ".join(own))
    boiler = " ".join(rng.choice(words) for _ in range(20))
    out += [f"{boiler} {' '.join(rng.choice(words) for _ in range(30))}" for _ in range(20)]
    # One large group of near copies of one text.
    text = [rng.choice(words) for _ in range(100)]
    for i in range(60):
        own = list(text)
        own[i] = "changed"
        out.append(" ".join(own))
    rng.shuffle(out)
    return list(enumerate(out))


def test_near_classes_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 16)
    rows = copies(random.Random(3))
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, x), (j, y) in combinations(rows, 2):
        if x == y or alike(x, y):
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in near.near_classes(df).collect()}
    assert {i: r.class_id for i, r in found.items()} == {i: root(i) for i, _ in rows}
    assert all(r.kept == (r.doc_id == r.class_id) for r in found.values())
    sizes = {c: sum(root(i) == c for i, _ in rows) for c in set(map(root, parent))}
    assert all(r.class_size == sizes[r.class_id] for r in found.values())


def test_near_edge_cases(spark, documents):
    found = near.near_classes(documents)
    assert found.count() == documents.count()
    alone = found.where("doc_id in (900001, 900002, 900003)").collect()
    assert all(r.kept and r.class_size == 1 for r in alone)
    out = near.keep_first(documents)
    assert set(out.columns) == set(documents.columns)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert near.near_classes(none).collect() == [] and exact.exact_classes(none).collect() == []


def test_alignment_equals_dynamic_programming():
    rng = random.Random(5)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randrange(40))]
        b = [rng.randrange(6) for _ in range(rng.randrange(40))]
        assert near.aligned(a, b, 60) == matched(a, b)


def test_word_hashes_do_not_depend_on_chunks(monkeypatch):
    texts = ["one two  three", None, "", "\t x\n", "long " * 500, "é" * 3000 + " end"]
    whole = near.WordHasher()(texts)
    monkeypatch.setattr(near, "CHUNK", 64)
    for a, b, t in zip(whole, near.WordHasher()(texts), texts, strict=True):
        assert np.array_equal(a, b) and len(a) == len((t or "").encode().split())


A = "one text of seven quite plain words"
B = "some other text that has nothing in common with it"


def test_repeated_and_null_ids(spark):
    rows = [(1, A), (1, B), (2, B), (None, A), (None, A), (3, ""), (4, None), (3, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = near.near_classes(df).collect()
    got = sorted((str(r.doc_id), str(r.class_id), r.class_size, r.kept) for r in found)
    assert got == sorted([("1", "1", 1, True), ("1", "1", 2, True), ("2", "1", 2, False), ("None", "None", 1, True), ("None", "None", 1, True), ("3", "3", 2, True), ("3", "3", 2, True), ("4", "4", 1, True)])
    assert len({r.class_text for r in found if r.doc_id in (1, 2)}) == 2
    kept = sorted(map(str, near.keep_first(df).collect()))
    assert kept == sorted(map(str, df.where("not (doc_id <=> 2)").collect()))


def test_stages_take_columns_of_any_name(spark):
    names = ("digest", "keep_digest", "keep_doc", "times", "row", "gone_doc", "gone_text", "_digest", "_n", "_keep_id", "words", "plan_size", "copy", "_id", "_words", "rejected", "lang_pred", "Size")
    from linfit.llm import langid, mixing

    rows = [(i, f"text {i % 7} " + "word " * (20 + i % 7), "en", f"s{i % 2}") for i in range(30)]
    rows += [(None, "x y z", None, None)] * 3 + [(5, None, "fr", "s1")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df = df.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for stage in (exact.keep_first, near.keep_first, mixing.mixed, langid.drop_rejected):
        out = stage(df)
        assert out.columns == df.columns
        for r in out.collect():
            assert all(r[n] == (None if r.doc_id is None else f"{n}{r.doc_id}") for n in names)
    assert exact.keep_first(df).count() == 9
