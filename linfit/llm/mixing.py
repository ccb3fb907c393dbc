"""Mixing sources to target weights by balanced sampling with the cube method.

A source with target t and size s takes each of its documents floor(t / s) times, and once more
with probability p = t / s - floor(t / s). Which documents are taken once more is decided by the
cube method: the vector of probabilities walks at random inside the cube [0, 1]^n, along
directions that keep both the number of documents and the number of words, until all but two
coordinates are 0 or 1. The walk runs in blocks of a source, then in blocks of what those left
open, and so on, until two documents of the source are left; these land by the cheapest of the
random choices that keep their probabilities.
"""

from __future__ import annotations

import random
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linfit.llm.common import stored, unused

WEIGHTS = (1, 2, 3)
#: A document is taken this many times at most, so a source's target stops at as many sizes.
MOST = 3
#: Documents that walk at one time.
BLOCK = 2000
#: Longest documents of a block, each of which is decided against all others at once.
HEAVY = 64
#: Sources that there may be: their totals meet at the driver.
MAX_SOURCES = 1_000_000
SEED = 7
_TINY = 1e-9


def word_count(text: Column) -> Column:
    """Runs of characters that are not blank; null has none."""
    runs = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(runs, F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], most: int = MOST, weights=WEIGHTS) -> dict:
    """Target of each source: a share of all sizes by weight, capped, the excess shared again.

    Sources in code point order, null last, get the weights in turn.
    """
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(order)}
    # Those with the least room for their weight are capped first.
    by_room = sorted(order, key=lambda s: most * sizes[s] / weight[s])
    left, shares = Fraction(sum(sizes.values())), sum(weight.values(), Fraction(0))
    out: dict[str | None, Fraction] = {}
    for s in by_room:
        share = left * weight[s] / shares
        out[s] = min(share, Fraction(most * sizes[s]))
        left -= out[s]
        shares -= weight[s]
    return out


def _step(p: np.ndarray, u: np.ndarray, rng: random.Random) -> np.ndarray:
    """Move along ``u`` to a face of the cube, by a chance that keeps the expected place."""
    with np.errstate(divide="ignore", invalid="ignore"):
        up = np.where(u > 0, (1 - p) / u, np.where(u < 0, -p / u, np.inf)).min()
        down = np.where(u > 0, p / u, np.where(u < 0, (p - 1) / u, np.inf)).min()
    p = p + u * (up if rng.random() * (up + down) < down else -down)
    return np.where(p < _TINY, 0.0, np.where(p > 1 - _TINY, 1.0, p))


def _settle_heavy(sizes: np.ndarray, p: np.ndarray, rng: random.Random) -> np.ndarray:
    """Decide the longest documents first, each balanced by all others in small parts."""
    p = p.copy()
    for x in np.argsort(-sizes, kind="stable")[:HEAVY]:
        while 0 < p[x] < 1:
            at = np.flatnonzero((p > 0) & (p < 1))
            if len(at) <= 3:
                return p
            w = p[at] * (1 - p[at])
            a = np.stack([np.ones(len(at)), sizes[at].astype(float)])
            own = at == x
            part = np.linalg.lstsq((a * w) @ a.T, a[:, own][:, 0], rcond=None)[0]
            u = own - w * (part @ a)
            # No room is left for the others to make up for this one.
            if u[own][0] < 1e-6:
                break
            p[at] = _step(p[at], u, rng)
            if (p[at] > 0).all() and (p[at] < 1).all():
                break
    return p


def walk(sizes: np.ndarray, p: np.ndarray, rng: random.Random) -> np.ndarray:
    """Flight phase: probabilities of which at most two are still neither 0 nor 1.

    After the longest documents, three open ones at a time: ``u`` spans the moves that keep
    their count and words.
    """
    p = np.where(p < _TINY, 0.0, np.where(p > 1 - _TINY, 1.0, p))
    p = _settle_heavy(sizes, p, rng).tolist()
    size = sizes.tolist()
    open_: list[int] = []
    for k in range(len(p)):
        if not 0 < p[k] < 1:
            continue
        open_.append(k)
        while len(open_) == 3 or len(open_) == 2 and size[open_[0]] == size[open_[1]]:
            if len(open_) == 3:
                x, y, z = (size[i] for i in open_)
                u = [float(z - y), float(x - z), float(y - x)]
                if not any(u):
                    u = [1.0, -1.0, 0.0]
            else:
                u = [1.0, -1.0]
            up = min((1 - p[i]) / v if v > 0 else -p[i] / v for i, v in zip(open_, u, strict=True) if v)
            down = min(p[i] / v if v > 0 else (p[i] - 1) / v for i, v in zip(open_, u, strict=True) if v)
            step = up if rng.random() * (up + down) < down else -down
            for i, v in zip(open_, u, strict=True):
                p[i] += step * v
            for i in open_:
                if not _TINY < p[i] < 1 - _TINY:
                    p[i] = float(round(p[i]))
            open_ = [i for i in open_ if 0 < p[i] < 1]
    return np.array(p, float)


def land(sizes: np.ndarray, p: np.ndarray, rng: random.Random) -> np.ndarray:
    """Decide the last two documents: their probabilities hold, and words move least.

    With one free number, the chance that both are taken, the mean squared change in words is
    least at an end of its range.
    """
    at = np.flatnonzero((p > 0) & (p < 1))
    p = p.copy()
    if len(at) == 1:
        p[at] = float(rng.random() < p[at[0]])
    elif len(at) == 2:
        a, b = p[at]
        x, y = (float(v) for v in sizes[at])
        mean = a * x + b * y
        cost = {(0, 0): mean**2, (1, 0): (x - mean) ** 2, (0, 1): (y - mean) ** 2, (1, 1): (x + y - mean) ** 2}
        best = None
        for both in (max(0.0, a + b - 1), min(a, b)):
            chance = {(1, 1): both, (1, 0): a - both, (0, 1): b - both, (0, 0): 1 - a - b + both}
            total = sum(chance[k] * cost[k] for k in cost)
            if best is None or total < best[0]:
                best = total, chance
        draw, acc = rng.random(), 0.0
        for k, chance in best[1].items():
            acc += chance
            if draw < acc:
                break
        p[at] = k
    return p


def _decide(last: bool, seed: int):
    def run(key, rows):
        source, block, level = key
        # Long documents first: what they leave open is made up for by shorter ones.
        rows = rows.sort_values(["size", "h", "doc_id"], ascending=[False, True, True])
        rng = random.Random(f"{seed}:{source!r}:{block}:{level}")
        sizes = rows["unit"].to_numpy(np.int64)
        p = walk(sizes, rows["p"].to_numpy(float), rng)
        return rows.assign(p=land(sizes, p, rng) if last else p)

    return run


def mixing_plan(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, rows, source_size, target, copies): how often groups are taken.

    A group is the rows with one doc_id, source and size, of which there may be several where
    doc_ids repeat or are null; ``copies`` is the sum of their multiplicities. Reruns agree:
    chance depends on the seed and on hashes of the group only. Raises ValueError beyond
    ``MAX_SOURCES`` sources.
    """
    units = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    units = stored(units.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")), "mix-units")
    per = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("units")
    )
    per = per.limit(MAX_SOURCES + 1).collect()
    if len(per) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    goal = targets({r.source: r.source_size for r in per})
    table = []
    for r in per:
        times = goal[r.source] / r.source_size if r.source_size else Fraction(0)
        base = times.numerator // times.denominator
        table.append((r.source, r.source_size, float(goal[r.source]), int(base), float(times - base), -(-r.units // BLOCK)))
    spark = docs.sparkSession
    shape = "_source string, source_size long, target double, base long, extra double, blocks long"
    goals = F.broadcast(spark.createDataFrame(table, shape))  # a row for each source
    rows = units.join(goals, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    # Of c equal rows, floor(c * p) are taken once more for certain; one row is left to chance.
    certain = F.floor(F.col("rows") * F.col("extra") + _TINY).cast("long")
    rows = (
        rows.withColumn("copies", F.col("rows") * F.col("base") + certain)
        .withColumn("p", F.greatest(F.lit(0.0), F.col("rows") * F.col("extra") - certain))
        .withColumn("unit", F.col("size"))
        .withColumn("h", F.xxhash64("doc_id", "source", "size", F.lit(seed)))
    )
    left = max((t[5] for t in table), default=1)
    level, done = 0, []
    while True:
        last = left <= 1
        # Blocks of about BLOCK documents; each leaves two, so their number falls a thousandfold.
        per_block = F.greatest(F.lit(1), F.ceil(F.col("blocks") / (BLOCK // 2) ** level))
        block = F.pmod(F.xxhash64("h", F.lit(level)), per_block).cast("long")
        keyed = rows.withColumn("block", block).withColumn("level", F.lit(level))
        out = keyed.groupBy("source", "block", "level").applyInPandas(_decide(last, seed), keyed.schema)
        out = stored(out.drop("block", "level"), f"mix-level-{level}")
        if last:
            done.append(out)
            break
        done.append(out.where("p = 0 or p = 1"))
        rows = out.where("p > 0 and p < 1")
        left = -(-left // (BLOCK // 2))
        level += 1
    plan = done[0]
    for more in done[1:]:
        plan = plan.unionByName(more)
    return plan.select(
        "doc_id",
        "source",
        "size",
        "rows",
        "source_size",
        "target",
        (F.col("copies") + F.col("p").cast("long")).alias("copies"),
    )


def _per_row(plan: DataFrame, n: Column) -> Column:
    """Times that the n-th row of its group is taken."""
    rest = F.col("copies") - F.floor(F.col("copies") / F.col("rows")) * F.col("rows")
    return (F.floor(F.col("copies") / F.col("rows")) + (n <= rest).cast("long")).cast("long")


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted).

    Null texts have size 0, a null source is a source of its own. Rows alike in doc_id, source
    and size share what the mix takes of them; texts of any length count whole. Ties are broken
    by hashes of doc_id, source and size. An empty table gives an empty table.
    """
    plan = mixing_plan(docs, seed)
    each = plan.withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    times = _per_row(plan, F.col("n"))
    return each.select("doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"))


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: each document as often as it is taken, with all its columns.

    Joined to the narrow plan by doc_id, source and size, so texts are shuffled once and never
    sorted; of several rows alike in these the ones with the least texts are taken more often.
    Columns may have any names. Nulls, repeated rows, ties and empty tables as in
    ``mixing_plan``; texts of any length are taken whole.
    """
    names = {c: unused(f"plan_{c}", docs.columns) for c in ("doc_id", "source", "size", "rows", "copies")}
    plan = mixing_plan(docs, seed).where("copies > 0").select(*(F.col(c).alias(n) for c, n in names.items()))
    several = not plan.where(F.col(names["rows"]) > 1).isEmpty()
    words = unused("words", docs.columns)
    same = (
        F.col("doc_id").eqNullSafe(F.col(names["doc_id"]))
        & F.col("source").eqNullSafe(F.col(names["source"]))
        & (F.col(words) == F.col(names["size"]))
    )
    joined = docs.withColumn(words, word_count(F.col("text"))).join(plan.hint("shuffle_hash"), same)
    rows, copies = F.col(names["rows"]), F.col(names["copies"])
    times = unused("times", docs.columns)
    taken = joined.where(rows == 1).withColumn(times, copies.cast("int"))
    if several:
        group = Window.partitionBy("doc_id", "source", words).orderBy("text")
        more = F.floor(copies / rows) + (F.row_number().over(group) <= F.pmod(copies, rows)).cast("long")
        taken = taken.unionByName(joined.where(rows > 1).withColumn(times, more.cast("int")))
    # Named apart from every column of the documents.
    copy = unused("copy", docs.columns)
    taken = taken.where(F.col(times) > 0).select(*docs.columns, F.explode(F.sequence(F.lit(1), times)).alias(copy))
    return taken.drop(copy)
