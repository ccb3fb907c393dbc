"""Neighbours, forms and counts of words against brute force."""

import random
import re
import zlib
from collections import Counter

from linfit.llm import variants

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def count(rows):
    total = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def holes(w):
    return [(w[:i] + w[i + 1 :], i) for i in range(len(w))]


def neighbours(words):
    near = {w: set() for w in words}
    gaps = {}
    for w in words:
        for rest, i in holes(w):
            gaps.setdefault((rest, i), set()).add(w)
            if rest in near:
                near[w].add(rest)
                near[rest].add(w)
    for some in gaps.values():
        for w in some:
            near[w] |= some - {w}
    return near


def forms(counts, times=10):
    near, form = neighbours(counts), {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= times * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        f = form[w]
        out.append((w, f, root, counts[w], len(near[w]), f and counts[f]))
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_counts_match_brute_force(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    rows += [(7, "Àéïõü×÷Þ ÀÉÏÕÜ×÷Þ"), (8, "x" * 50_000 + " short " + "y" * 7), (9, "y" * 7 + "ā" + "y" * 7), (None, "Wholeword wholeword")]
    rows += [(i, "sevenly eightful") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = {r.word: r.n for r in variants.word_counts(docs).collect()}
    assert found == count(rows) and len(found) > 100


def test_forms_match_brute_force_on_documents(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    counts = count(rows)
    df = variants.spelling_forms(variants.word_counts(documents))
    assert got(df) == forms(counts)
    assert variants.spelling_forms(variants.word_counts(documents.limit(0))).collect() == []


def test_forms_match_brute_force_on_dense_and_long_words(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("ab") for _ in range(rng.randrange(7, 11))) for _ in range(600)}
    for _ in range(150):
        w = "".join(rng.choice("abcdé") for _ in range(rng.choice([7, 8, 15, 31, 64, 200])))
        words.add(w)
        for _ in range(3):
            i = rng.randrange(len(w))
            words.add(rng.choice([w[:i] + w[i + 1 :], w[:i] + "z" + w[i:], w[:i] + "z" + w[i + 1 :]]))
    words = sorted(w for w in words if len(w) >= 7)
    counts = {w: rng.choice([2, 3, 30, 300, 3000, 30_000]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    want = forms(counts)
    assert got(variants.spelling_forms(df)) == want
    assert max(sum(r[5] is not None for r in want), 0) > 100
    assert any(f and root != f for _, f, root, *_ in want)


def test_nothing_is_broadcast(spark, monkeypatch):
    plans, stored = [], variants.stored

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(variants, "stored", seen)
    counts = spark.createDataFrame([("spelling", 100), ("speling", 5), ("spellings", 2)], "word string, n long")
    found = variants.spelling_forms(counts)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert got(found) == [("speling", "spelling", "spelling", 5, 1, 100), ("spelling", None, "spelling", 100, 2, None), ("spellings", "spelling", "spelling", 2, 1, 100)]
    assert sum("Join" in p for p in plans) >= 4
    assert not any("Broadcast" in p for p in plans)


def test_one_and_no_word(spark):
    one = spark.createDataFrame([("lonesome", 4)], "word string, n long")
    assert got(variants.spelling_forms(one)) == [("lonesome", None, "lonesome", 4, 0, None)]
    assert got(variants.spelling_forms(one.limit(0))) == []
