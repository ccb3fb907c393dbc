"""Line dedup against brute force over all pairs of lines."""

import random

import pytest
from pyspark.sql import functions as F

from linfit.llm import lines

SCHEMA = "doc_id long, text string, place int, kept string"


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def edited(line: str, n: int, rng: random.Random) -> str:
    for _ in range(n):
        i = rng.randrange(len(line) + 1)
        line = rng.choice([line[:i] + line[i + 1 :], line[:i] + rng.choice("abxé") + line[i:], line[:i] + "y" + line[i + 1 :]])
    return line


def brute(rows):
    """doc -> (n_lines, n_dropped, n_links, dropped)."""
    spots = []
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        for place, line in enumerate((text or "").replace("\r\n", "\n").split("\n")):
            if line.strip(" "):
                spots.append((doc, place, line.strip(" ")))
    texts = sorted({s[2] for s in spots})
    parent = {t: t for t in texts}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    links = dict.fromkeys(texts, 0)
    for i, a in enumerate(texts):
        for b in texts[:i]:
            longer = max(len(a), len(b))
            most = 0 if longer < 6 else 1 if longer < 12 else 2
            if abs(len(a) - len(b)) <= most and distance(a, b) <= most:
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    seen, out = set(), {}
    for doc, place, line in spots:
        n, d, k, at = out.get(doc, (0, 0, 0, []))
        again = root(line) in seen
        seen.add(root(line))
        out[doc] = (n + 1, d + again, k + links[line], at + [place] * again)
    for doc, _ in rows:
        out.setdefault(doc, (0, 0, 0, []))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    bases = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(1, 60))).strip() or "a" for _ in range(25)]
    out = []
    for doc in range(60):
        picked = [edited(rng.choice(bases), rng.randrange(4), rng) for _ in range(rng.randrange(5))]
        out.append((doc, "\n".join(picked + ["", "common line"])))
    out += [(60, None), (61, ""), (62, "  \n\n"), (63, "z" * 900), (64, "z" * 899 + "y"), (65, "x\r\n" + "q" * 30)]
    out += [(66, "q" * 29 + "p"), (None, "common line\nonly here, in a row without an id"), (5, None)]
    return [(d, t) for d, t in out if (d, t) != (5, None)]


def test_report_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, text string")
    report = lines.dedup_report(df).collect()
    found = {r.doc_id: (r.n_lines, r.n_dropped, r.n_links, r.dropped) for r in report}
    assert len(report) == len(found)
    # Rows given twice are one document.
    assert found == brute(rows)


def test_short_lines_match_brute_force(spark):
    rng = random.Random(8)
    bases = ["".join(rng.choice("abé.") for _ in range(n)) for n in range(3, 16) for _ in range(3)]
    rows = [(i, "\n".join(edited(rng.choice(bases), rng.randrange(3), rng) for _ in range(12))) for i in range(40)]
    rows += [(900, "Heti eror anesti.\nÉonchan ou le.\nabcde"), (901, "Heti, eror anesti.\nÉonchan | le.\nabcdf")]
    found = {r.doc_id: (r.n_lines, r.n_dropped, r.n_links, r.dropped) for r in lines.dedup_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute(rows)
    assert found == want and want[901][1] >= 2


def test_lines_that_share_a_long_part_are_not_compared_pair_by_pair(spark, monkeypatch):
    rng = random.Random(15)
    made = {}
    stored = lines.stored
    monkeypatch.setattr(lines, "stored", lambda df, name: made.setdefault(name, stored(df, name)) if name == "line-candidates" else stored(df, name))
    base = "".join(rng.choice("abcdé ") for _ in range(89)) + "z"
    # All share the first third and are far apart elsewhere, but for a planted copy of every tenth.
    group = [base[:30] + "".join(rng.choice(c + "xy") for c in base[30:]) for _ in range(200)]
    copies = [edited(line, 2, rng) for line in group[::10]]
    rows = [(i, line) for i, line in enumerate(group + copies)]
    found = {r.doc_id: (r.n_lines, r.n_dropped, r.n_links, r.dropped) for r in lines.dedup_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute(rows)
    assert sum(r[2] for r in found.values()) >= 2 * len(copies)
    assert made["line-candidates"].count() < 1000  # 220 lines make 24,090 pairs


def test_every_round_finds_all_near_lines(spark):
    rng = random.Random(16)
    for n in (5, 9, 12, 14, 40):
        base = "".join(rng.choice("abé") for _ in range(n))
        texts = sorted({base, *(edited(base, 1 + i % 2, rng) for i in range(60))} - {""})
        df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id long, line string").withColumn("n", F.length("line"))
        want = set()
        for i, a in enumerate(texts):
            for j, b in enumerate(texts[:i]):
                longer = max(len(a), len(b))
                if distance(a, b) <= (0 if longer < 6 else 1 if longer < 12 else 2):
                    want.add((j, i))
        for scale in lines.SCALES:
            pairs, _ = lines._candidates(df, scale, last=True)
            assert want <= {(r.a, r.b) for r in pairs.collect()}, (n, scale)


def test_distance_is_exact(spark):
    rng = random.Random(9)
    pairs = [("", ""), ("", "ab"), ("abc", ""), ("ab", "ba"), ("é日a", "日aé")]
    for _ in range(400):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 12)))
        pairs.append((a, edited(a or "a", rng.randrange(5), rng)))
    df = spark.createDataFrame(pairs, "a string, b string")
    for edits in (1, 2, 3):
        got = df.select("a", "b", lines.within_edits(F.col("a"), F.col("b"), edits).alias("ok")).collect()
        assert all(r.ok == (distance(r.a, r.b) <= edits) for r in got)


def test_pairs_within_two_edits_pass_the_ends_test(spark):
    rng = random.Random(12)
    pairs = []
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 9)))
        b = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 9)))
        pairs.append((a, b, 0))
    cut = lines.middles(spark.createDataFrame(pairs, "x string, y string, n int")).collect()
    df = spark.createDataFrame([(r.x, r.y) for r in cut], "x string, y string")
    for r in df.select("x", "y", lines.may_be_near(F.col("x"), F.col("y")).alias("ok")).collect():
        assert r.ok or distance(r.x, r.y) > 2, r


def test_very_long_lines(spark):
    rows = [(1, "z" * 60_000), (2, "z" * 59_999 + "y"), (3, "y" * 60_000)]
    found = {r.doc_id: (r.n_links, r.dropped) for r in lines.dedup_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: (1, []), 2: (1, [0]), 3: (0, [])}


def test_lines_leave_the_text_and_other_columns_stay(spark):
    rows = [(1, "first line here\nsecond", 7, "k"), (2, "first line here\nthird", 8, None), (3, None, 9, "z")]
    out = lines.dedup_lines(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "place", "kept"]
    assert sorted(map(tuple, out.collect())) == [(1, rows[0][1], 7, "k"), (2, "third", 8, None), (3, None, 9, "z")]


def test_columns_of_any_name_and_repeated_rows(spark):
    names = ("_id", "_gone", "_row", "gone", "gone_doc", "gone_row", "id", "line", "row", "key", "most")
    rows = [(1, "a line of some length\nsecond"), (2, "a line of some lengths\nthird"), (2, "a line of some lengths\nthird"), (None, "third")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit(n) for n in names})
    out = lines.dedup_lines(df)
    assert out.columns == df.columns
    assert sorted(str(r.text) for r in out.collect()) == sorted(["a line of some length\nsecond", "third", "third", ""])
    assert all(r[n] == n for r in out.collect() for n in names)


def test_empty_table_and_native_plan(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert lines.dedup_report(empty).collect() == []
    assert lines.dedup_lines(empty).collect() == []
    plan = lines.dedup_report(empty)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
