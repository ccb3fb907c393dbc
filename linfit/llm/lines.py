"""Line deduplication by a segment-partition edit join, with DataFrame operations only.

Two lines are near copies if at most ``EDITS`` edits, fewer for short lines, lead from one to the
other. A line is cut into one segment more than that, one of which an edited copy must hold
unchanged, at a place that the two lengths and the edits to the left and right of it leave open.
So each line stands in an index under its segments, by length and number, and probes the index of
each length it may meet with the few substrings that can match. Lines that meet under a segment
that many share are compared by all but two of more segments instead, and again by finer ones.
Candidates are verified by an edit distance that keeps, for each number of edits, the reachable
diagonals of the band as the bits of one integer.

Lines that are near copies, directly or through others, form a class, of which the first line
(by doc_id, then place) stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfit.llm.common import components, stored, unused

EDITS = 2
#: Edits that are allowed grow with the length of the longer line: none below the first of these
#: lengths, one from there on, two from the next.
LENGTHS = (6, 12)
#: Segments of a line, as a multiple of the edits and one more, in each round of the join; the lines
#: of a key that more than ``CROWD`` lines are indexed under go to the next round.
SCALES, CROWD = (1, 2, 4), 4
_LAST = (1 << 63) - 1


def allowed(length: Column) -> Column:
    """Edits that two lines may be apart, the longer of which has ``length`` characters."""
    out = F.lit(0)
    for edits, least in enumerate(LENGTHS, 1):
        out = F.when(length >= least, edits).otherwise(out)
    return out


def _spared(edits: int, parts: int, probe: bool) -> Column:
    """The segments (from 0) that edits may lie in, ``a`` and ``b``, and where the rest then stands.

    Between ``a`` and ``b`` the probing line is shifted by ``s``, behind them by ``less``, what it
    is longer by. Two edits are one in each of two segments, or both in neighbours.
    """
    rows = []
    for less in range(edits + 1 if probe else 1):
        for a in range(parts):
            if edits == 1:
                rows.append((1, a, a, 0, less))
                continue
            for b in range(a + 1, parts):
                apart = probe and b > a + 1
                rows += [(2, a, b, s, less) for s in (range(max(-1, less - 1), 2) if apart else [0])]
    each = ("struct({} as e, {} as a, {} as b, {} as s, {} as less)".format(*r) for r in rows)
    return F.expr(f"array({', '.join(each)})")


def _keys(texts: DataFrame, scale: int, probe: bool) -> DataFrame:
    """(id, key): a hash of all segments but those that edits may lie in, for each choice of these.

    A line has ``scale`` times as many segments as edits and one more; finer ones make more keys,
    each of more of the line. Equal keys of a probe and an indexed line, of the same length or up
    to ``EDITS`` less, make a candidate, and near copies share one at any ``scale``.
    """
    n, (one, two) = F.col("n"), LENGTHS
    once, twice = (_spared(e, (e + 1) * scale, probe) for e in (1, 2))
    if probe:
        every = F.when(n >= two, twice).when(n >= one, once)
    else:  # a line is met by longer ones, which have up to that many more characters
        every = F.when(n >= two, twice).when(n >= two - 2, F.concat(once, twice)).when(n >= one - 1, once)
    # Four bytes a character, so that a part is cut out without counting characters.
    rows = texts.withColumn("code", F.encode("line", "UTF-32")).select("id", "n", "code", F.explode(every).alias("at"))
    rows = rows.select("id", "n", "code", "at.*")
    e, a, b, s, less = (F.col(f) for f in ("e", "a", "b", "s", "less"))
    other, parts = n - less, (e + 1) * scale

    def edge(i: Column) -> Column:
        """Where the i-th segment (from 0) begins; the last ones are longer by one."""
        return F.call_function("div", other, parts).cast("int") * i + F.greatest(F.lit(0), i - parts + other % parts)

    def cut(start: Column, end: Column) -> Column:
        return F.substring(F.col("code"), start * 4 + 1, F.greatest(end - start, F.lit(0)) * 4)

    # In a line shorter than its segments' shifts this cuts something else, which only makes a
    # candidate more.
    pieces = cut(F.lit(0), edge(a)), cut(edge(a + 1) + s, edge(b) + s), cut(edge(b + 1) + less, n)
    return rows.select("id", F.xxhash64(other, e, a, b, *pieces).alias("key"))


def _candidates(texts: DataFrame, scale: int, last: bool) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of the lines that share a key which few lines are indexed under, and the lines
    to compare by finer segments: those that share one with more than ``CROWD``, none in the last
    round. A near pair under such a key has both its lines among these."""
    probes, index = _keys(texts, scale, True).withColumnRenamed("id", "from"), _keys(texts, scale, False)
    other = index.withColumnRenamed("key", "same").hint("shuffle_hash")
    met = probes.join(other, (F.col("key") == F.col("same")) & (F.col("from") != F.col("id")), "left_semi")
    met = stored(met, "line-probes")
    own = stored(index.join(met.select("key").distinct(), "key", "left_semi"), "line-index")
    crowded = own.groupBy("key").agg(F.count("*").alias("lines")).where(F.col("lines") > (_LAST if last else CROWD))
    crowded = stored(crowded.select("key"), "line-crowds")
    few = own.join(crowded, "key", "left_anti")
    pairs = met.join(few.hint("shuffle_hash"), "key").where(F.col("from") != F.col("id"))
    pairs = pairs.select(F.least("from", "id").alias("a"), F.greatest("from", "id").alias("b"))
    among = met.join(crowded, "key", "left_semi").select(F.col("from").alias("id"))
    among = among.union(own.join(crowded, "key", "left_semi").select("id")).distinct()
    return pairs, texts.join(among, "id", "left_semi")


def _common(a: Column, b: Column, room: Column, part) -> Column:
    """How many characters, up to ``room``, two lines have in common at one end, by halving."""
    def longer(n: Column, step: Column) -> Column:
        more = n + step
        return F.when((more <= room) & (part(a, more) == part(b, more)), more).otherwise(n)

    steps = F.array(*(F.lit(1 << k) for k in range(30, -1, -1)))
    return F.aggregate(steps, F.lit(0), longer)


def middles(pairs: DataFrame) -> DataFrame:
    """``x`` and ``y`` without the characters that both begin with, and then both end with."""
    pairs = pairs.withColumn("room", F.least(F.length("x"), F.length("y")))
    head = _common(F.col("x"), F.col("y"), F.col("room"), lambda s, n: F.substring(s, F.lit(1), n))
    pairs = pairs.withColumn("head", head)
    pairs = pairs.withColumn("room", F.col("room") - F.col("head"))
    pairs = pairs.withColumn("tail", _common(F.col("x"), F.col("y"), F.col("room"), F.right))
    cut = [
        F.substring(F.col(c), F.col("head") + 1, F.length(c) - F.col("head") - F.col("tail")).alias(c)
        for c in ("x", "y")
    ]
    return pairs.select(*(c for c in pairs.columns if c not in ("x", "y", "head", "tail", "room")), *cut)


def may_be_near(a: Column, b: Column) -> Column:
    """What two edits or fewer imply where both ends differ: the first and the last character of
    the alignment are edits, so all between them is equal. False for nearly all other pairs."""
    def inner(s: Column, first: int, last: int) -> Column:
        return F.substring(s, F.lit(first + 1), F.length(s) - first - last)

    ends = [(1, 1), (1, 0), (0, 1)]
    out = F.length(a) + F.length(b) <= 4
    for fa, fb in ends:
        for la, lb in ends:
            out = out | (inner(a, fa, la) == inner(b, fb, lb))
    return out


def within_edits(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Whether at most ``edits`` edits lead from ``a`` to ``b``, null if one is null.

    Bit d + edits of number e is set when the first i characters of ``a`` and the first i + d of
    ``b`` are e edits apart at most; each step takes one character of ``a``.
    """
    full = (1 << (2 * edits + 1)) - 1
    first = [1 << edits]
    for _ in range(edits):
        first.append((first[-1] | first[-1] << 1) & full)
    # The state carries the characters of ``b``, so that they are split only once.
    bits = F.array(*(F.lit(v) for v in first))
    zero = F.struct(F.lit(0).alias("i"), F.split(b, "").alias("y"), bits.alias("r"))

    def step(row: Column, mine: Column) -> Column:
        hits = [
            F.when(F.get(row["y"], row["i"] + d) == mine, F.lit(1 << (d + edits))).otherwise(F.lit(0))
            for d in range(-edits, edits + 1)
        ]
        match = hits[0]
        for h in hits[1:]:
            match = match.bitwiseOR(h)

        def after(match: Column) -> Column:
            out: list[Column] = []
            for e in range(edits + 1):
                now = row["r"][e].bitwiseAND(match)
                if e:
                    before = row["r"][e - 1]
                    now = now.bitwiseOR(before).bitwiseOR(F.shiftright(before, 1))
                    now = now.bitwiseOR(F.shiftleft(out[e - 1], 1)).bitwiseAND(F.lit(full))
                out.append(now)
            return F.array(*out)

        # A transformed array of one element, so that the match is worked out once.
        bits = F.transform(F.array(match), after)[0]
        return F.struct((row["i"] + 1).alias("i"), row["y"].alias("y"), bits.alias("r"))

    n, m = F.length(a), F.length(b)
    last = F.aggregate(F.split(a, ""), zero, step)["r"][edits]
    # No character of ``a`` is read where it is empty.
    last = F.when(n == 0, F.lit(first[-1])).otherwise(last)
    reached = F.call_function("shiftright", last, m - n + edits).bitwiseAND(F.lit(1)) == 1
    return F.when(F.abs(m - n) > edits, F.lit(False)).otherwise(reached)


def _lines(text: Column) -> Column:
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n"), lambda s: F.trim(s))


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, row, place, line, id, other): the lines that are not empty, spaces trimmed.

    ``id`` and ``other`` are hashes of the line, ``row`` is one of the text.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("row"),
        # Trimmed before they are dealt out, so that no later expression trims a line again.
        F.posexplode(_lines(F.col("text"))).alias("place", "line"),
    ).where("line <> ''")
    return rows.withColumn("id", F.xxhash64("line")).withColumn("other", F.xxhash64(F.lit(1), "line"))


def edit_links(lines: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of the hashes of all different lines that are near copies.

    ``lines`` has ``line``; copies of a line are brought down to one before anything is probed.
    """
    distinct = lines.select("line").distinct().withColumn("n", F.length("line"))
    distinct = stored(distinct, "line-texts").withColumn("id", F.xxhash64("line"))
    pairs, rest = _candidates(distinct, SCALES[0], last=False)
    for scale in SCALES[1:]:
        rest = stored(rest, "line-crowd")
        if rest.isEmpty():
            break
        more, rest = _candidates(rest, scale, last=scale == SCALES[-1])
        pairs = pairs.union(more)
    pairs = stored(pairs.distinct(), "line-candidates")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    texts = distinct.select("id", "line").join(ids.hint("shuffle_hash"), "id", "left_semi")
    texts = stored(texts, "line-met")
    left = texts.select(F.col("id").alias("a"), F.col("line").alias("x"))
    right = texts.select(F.col("id").alias("b"), F.col("line").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    both = both.withColumn("most", allowed(F.greatest(F.length("x"), F.length("y"))))
    # What two lines begin and end with costs no edit; the rest is mostly a few characters. It is
    # stored, or the filter would be worked out within the very expressions that cut it.
    x, y = F.col("x"), F.col("y")
    cut = middles(both.where(F.abs(F.length("x") - F.length("y")) <= F.col("most")))
    cut = stored(cut, "line-middles").where(may_be_near(x, y))
    near = F.lit(False)
    for edits in range(1, EDITS + 1):
        near = F.when(F.col("most") == edits, within_edits(x, y, edits)).otherwise(near)
    return stored(cut, "line-ends").where(near).select("a", "b")


def line_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, row, place, links, kept): the places of lines that have copies or links.

    A line that stands in one place and is a near copy of none is kept and not listed.
    """
    lines = line_rows(docs)
    links = stored(edit_links(lines), "line-links")
    ends = links.select(F.col("a").alias("id")).union(links.select("b"))
    degree = ends.groupBy("id").agg(F.count("*").alias("links"))
    known = components(links, "line").join(degree, "id")
    # Rows alike in doc_id and text are one document, so their places are too.
    spots = stored(lines.select("doc_id", "row", "place", "id", "other").distinct(), "line-places")
    # Equal lines first: one row each, wherever they stand.
    where = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("d"), F.col("row").alias("r"), F.col("place").alias("p"))
    equal = spots.groupBy("id", "other").agg(F.min(where).alias("first"), F.count("*").alias("n"))
    equal = equal.join(known, "id", "left").where("n > 1 or root is not null")
    equal = stored(equal, "equal-lines")
    heads = equal.where("root is not null").groupBy("root").agg(F.min("first").alias("head"))
    equal = equal.join(heads, "root", "left").select(
        "id", "other", F.coalesce("head", "first").alias("head"), F.coalesce("links", F.lit(0)).cast("long").alias("links")
    )
    # The few lines that stand in very many places are split by the planner: the other side is narrow.
    found = spots.join(equal, ["id", "other"])
    return found.select("doc_id", "row", "place", "links", (where == F.col("head")).alias("kept"))


def dedup_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, n_links, dropped (places from 0).

    Lines are what stands between line breaks, without spaces around it; empty ones are neither
    counted nor dropped. Two lines are near copies if they are equal, or if the edits between them
    are no more than the longer one's length allows (see ``LENGTHS``). Of a class the first line
    stays, by doc_id, text hash and place. ``n_links`` counts, for each line, the different lines
    that are near copies of it. Rows alike in doc_id and text are one document. Null and empty
    texts have no lines; lines of any length are compared whole. Null doc_ids come after all
    others. An empty table gives an empty table.
    """
    each = line_classes(docs).groupBy("doc_id", "row").agg(
        F.sum((~F.col("kept")).cast("long")).alias("n_dropped"),
        F.sum("links").alias("n_links"),
        F.sort_array(F.collect_list(F.when(~F.col("kept"), F.col("place")))).alias("dropped"),
    )
    n_lines = F.size(F.filter(_lines(F.col("text")), lambda s: s != "")).cast("long")
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), n_lines.alias("n_lines")).distinct()
    same = every.doc_id.eqNullSafe(each.doc_id) & (every.row == each.row)
    return every.join(each, same, "left").select(
        every.doc_id,
        "n_lines",
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines taken out of ``text`` that are near copies of an earlier line.

    Columns may have any names; a text that loses no line stays as it is, and every row of a
    repeated document loses the same lines. Nulls, empty and long texts as in ``dedup_report``.
    """
    doc, row, gone = (unused(c, docs.columns) for c in ("gone_doc", "gone_row", "gone"))
    drop = line_classes(docs).where("not kept").groupBy(F.col("doc_id").alias(doc), F.col("row").alias(row))
    drop = drop.agg(F.collect_set("place").alias(gone))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(row))
    lines = F.transform(F.split("text", "\r?\n"), lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    left = F.filter(lines, lambda s: ~F.array_contains(F.col(gone), s["i"]))
    text = F.array_join(F.transform(left, lambda s: s["line"]), "\n")
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(text).alias("text")
    joined = docs.join(drop.hint("shuffle_hash"), same, "left")
    return joined.select(*(text if c == "text" else F.col(c) for c in docs.columns))
