"""Window search against a plain search, table by table and as a whole."""

import hashlib
import random
import re

import pytest

from linfit.llm import decontam
from linfit.llm.decontam import BLOCK, Tables, folded, windows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(docs, items, n=10):
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[tuple(w[i : i + size])]
        names = sorted(str(i) for i in found - {None})
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((str(doc), len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out)


def got(df):
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return sorted((str(r[0]), *r[1:]) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def items(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    rows += [(1001, None), (1002, ""), (1003, "?! ..."), (1004, "Zq"), (1005, "the of"), (1006, "a b a b a b a b a b a b a"), (None, "lone item words"), (1007, rows[0][1]), (0, "another text of item zero"), (1008, "Ünïcode ünïcode 漢字 words")]
    return rows


def test_folding_matches_the_contract():
    texts = ["", "  ", "a", "A-b\x00c\x7fD", "É é×ÿ_9", "x" * 50, "\n", "trailing "]
    flat = folded([t.encode() for t in texts]).tobytes()
    assert flat[-BLOCK:] == b"\0" * BLOCK
    parts = flat[:-BLOCK].split(b"\0")[1:-1]
    assert [p.decode() for p in parts] == [" " + "".join(w + " " for w in words(t)) for t in texts]


def test_tables_find_every_occurrence():
    rng = random.Random(5)
    for trial in range(30):
        alphabet = "ab" if trial % 2 else "abcdefgh"
        text = folded([("".join(rng.choice(alphabet + " ") for _ in range(rng.randrange(3000)))).encode() for _ in range(3)])
        flat = text.tobytes()
        some = set()
        for _ in range(40):
            size, at = rng.choice([1, 3, 7, 8, 9, 20, 150]), rng.randrange(max(1, len(flat) - BLOCK))
            p = flat[at : at + size]
            if len(p) == size and b"\0" not in p:
                some.add(p)
        some |= {b"zzz", b"abababab"}
        for size in {len(p).bit_length() for p in some}:
            patterns = [p for p in some if len(p).bit_length() == size]
            import numpy as np

            places, numbers = Tables(patterns, np.arange(len(patterns))).occurrences(text)
            want = {(m.start(), i) for i, p in enumerate(patterns) for m in re.finditer(b"(?=" + re.escape(p) + b")", flat[:-BLOCK])}
            found = list(zip(places.tolist(), numbers.tolist(), strict=True))
            assert len(found) == len(set(found)) and set(found) == want


def test_windows_of_short_and_null_items():
    assert windows_of(None, 10) == windows_of(b" ?! ", 10) == set()
    assert windows_of(b"One two", 10) == {b" one two "}
    assert windows_of(b"a b c", 2) == {b" a b ", b" b c "}


def test_report_matches_brute_force(spark, documents, items):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    long = items[2][1].upper().replace(" ", "\n--\n")
    rows += [(5001, "before " + long + " after"), (5002, items[0][1] + " " + items[0][1]), (5003, "zq"), (5004, "Of the of. The OF"), (5005, "a b " * 40), (5006, "pad " * 20_000 + items[3][1]), (5007, " ".join(words(items[4][1])[:9])), (5008, "x" * 300_000 + " zq"), (None, items[1][1]), (5009, "lone item words; ünïcode ünïcode 漢字 words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items)
    assert sum(r[5] for r in want) > 10
    assert got(decontam.report(docs, benchmark)) == want


def test_shards_do_not_change_the_result(spark, documents, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = decontam.overlaps(documents, benchmark)
    parts = decontam.overlaps(documents, benchmark, shard_bytes=4000)
    assert len(list(decontam.shards(benchmark, size=4000))) > 3
    key = lambda r: (str(r.doc_id), r.n_words, [tuple(s) for s in r.spans], r.items)
    assert sorted(map(key, whole.collect())) == sorted(map(key, parts.collect()))


def test_empty_tables_and_kept_columns(spark, documents, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.report(documents.limit(0), benchmark).collect() == []
    none = decontam.report(documents, benchmark.limit(0)).collect()
    assert len(none) == documents.count() and not any(r.contaminated or r.n_items for r in none)
    odd = documents.withColumnsRenamed({"kept": "row", "score": "spans", "size": "items", "n": "Text_"})
    clean = decontam.drop_contaminated(odd, benchmark)
    assert clean.columns == odd.columns
    hit = sum(r.contaminated for r in decontam.report(documents, benchmark).collect())
    assert clean.count() == documents.count() - hit
    assert {r.spans for r in clean.select("spans").collect()} == {"score"}
