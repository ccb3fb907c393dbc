"""Toxicity by cumulative-link ordinal regression over sparse text features.

Features are words and their beginnings, chosen by how surely toxic training texts hold them more
often. One weight vector is shared by all thresholds between severity grades: the chance of a
grade above k is sigmoid(w x - t_k), with t_0 < t_1 < t_2. A document gets the expected grade.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linfit.llm.common import held_out, map_rows

#: Labelled documents of each class that are learned from, those whose ids hash lowest.
PER_CLASS = 4000
FEATURES = 2048
#: How far toxic training texts must be ahead in holding a feature (log odds), and how sure that
#: is: the likelihood ratio statistic at the 0.005 level, one-sided. Where no feature reaches
#: both, the ``BEST`` ones are taken.
LEAST_ODDS = 2.0
LEAST_RATIO = 6.63
BEST = 16
#: Penalty of the squared weights against the log likelihood of all training texts together.
PENALTY = 0.3
#: Lengths of word beginnings.
BEGINNINGS = (4, 5, 6)
#: Grades: 0 is not toxic; the others split the toxic training texts by how much they hold.
GRADES = 4
#: Chance of a grade above 0 from which a document counts as toxic.
TOXIC = 0.5
REMEMBERED = 200_000

_WORD = re.compile(r"\w+")


def features(part: str) -> list[str]:
    """Words in a stretch without blanks, and their beginnings, marked by kind."""
    out = []
    for word in _WORD.findall(part):
        out.append(f"={word}")
        out += [f"{n}{word[:n]}" for n in BEGINNINGS if len(word) > n]
    return out


def text_features(text: str | None) -> Counter:
    counts: Counter = Counter()
    for part, n in Counter((text or "").lower().split()).items():
        for f in features(part):
            counts[f] += n
    return counts


@dataclass
class Ordinal:
    """Places of the features, shared weights, ordered thresholds."""

    places: dict[str, int]
    weights: np.ndarray
    cuts: np.ndarray
    memory: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def found(self, text: str | None) -> Counter:
        """Places of the chosen features in the whole text, with counts."""
        memory, counts = self.memory, Counter()
        for part in (text or "").lower().split():
            hit = memory.get(part)
            if hit is None:
                hit = tuple(self.places[f] for f in features(part) if f in self.places)
                if len(memory) < REMEMBERED:
                    memory[part] = hit
            if hit:
                counts.update(hit)
        return counts

    def grades(self, counts: Counter) -> np.ndarray:
        """Chances of grades above 0, 1, ..."""
        score = sum(self.weights[i] * np.log1p(n) for i, n in counts.items())
        return 1 / (1 + np.exp(-np.clip(score - self.cuts, -500, 500)))


def fit_ordinal(x: np.ndarray, y: np.ndarray, l2: float = 1e-5, steps: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """Weights and increasing cuts that maximise the penalised likelihood of grades ``y``.

    Cuts are a first one and positive gaps, so they stay in order. Adam on all rows.
    """
    n, d = x.shape
    k = GRADES - 1
    p = np.zeros(d + k)
    p[d] = 1.0
    m = np.zeros_like(p)
    v = np.zeros_like(p)
    above = np.concatenate([np.ones((n, 1)), np.zeros((n, k)), np.zeros((n, 1))], axis=1)
    for step in range(1, steps + 1):
        w, gaps = p[:d], np.exp(np.clip(p[d + 1 :], -8, 8))
        cuts = p[d] + np.concatenate([[0.0], np.cumsum(gaps)])
        above[:, 1 : k + 1] = 1 / (1 + np.exp(-np.clip((x @ w.astype(x.dtype))[:, None] - cuts, -60, 60)))
        chance = np.maximum(above[np.arange(n), y] - above[np.arange(n), y + 1], 1e-12)
        # d log chance / d score at the upper and at the lower border of the grade.
        slope = above * (1 - above)
        low, high = slope[np.arange(n), y] / chance, slope[np.arange(n), y + 1] / chance
        g = np.zeros_like(p)
        g[:d] = -(x.T @ (low - high).astype(x.dtype)) / n + l2 * w
        g_cut = np.zeros(k + 2)
        np.add.at(g_cut, y, low / n)
        np.add.at(g_cut, y + 1, -high / n)
        g_cut = g_cut[1 : k + 1]
        g[d] = g_cut.sum()
        g[d + 1 :] = np.cumsum(g_cut[::-1])[::-1][1:] * gaps
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        p -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    gaps = np.exp(np.clip(p[d + 1 :], -8, 8))
    return p[:d], p[d] + np.concatenate([[0.0], np.cumsum(gaps)])


def likelihood_ratio(bad: str, good: str, n_bad: int, n_good: int) -> Column:
    """G statistic of a feature that so many of the toxic and of the other texts hold."""

    def part(c: Column) -> Column:
        return F.when(c > 0, c * F.log(c)).otherwise(0.0)

    b, g, n = F.col(bad), F.col(good), n_bad + n_good
    cells = part(b) + part(g) + part(n_bad - b) + part(n_good - g)
    sides = part(b + g) + part(n - b - g) + part(F.lit(n_bad)) + part(F.lit(n_good))
    return 2 * (cells - sides + part(F.lit(n)))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Ordinal:
    """Learn from at most ``per_class`` toxic and as many other labelled texts.

    Texts that ``held_out`` names are not learned from; null texts, ids and labels neither. A
    document with several labels is toxic if one of them says so. Without texts of both classes, or
    a word that two toxic ones share, nothing is ever toxic.
    """
    known = labels.where("doc_id is not null and toxic is not null")
    known = known.where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).alias("bad"))
    order = Window.partitionBy("bad").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_class)
    chosen = F.broadcast(chosen.select("doc_id", "bad"))  # 2 * per_class rows at most
    sample = docs.select("doc_id", "text").where("text is not null").join(chosen, "doc_id")
    sample = sample.dropDuplicates(["doc_id"])

    def totals(batches):
        seen: dict[bool, Counter] = {True: Counter(), False: Counter()}
        for batch in batches:
            for text, bad in zip(batch.column("text"), batch.column("bad").to_pylist(), strict=True):
                seen[bad].update(text_features(text.as_py()).keys())
                seen[bad][""] += 1
        names = list(seen[True].keys() | seen[False].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string())] + [pa.array([seen[b][f] for f in names], pa.int64()) for b in (True, False)],
            ["feature", "bad", "good"],
        )

    counts = sample.select("text", "bad").mapInArrow(totals, "feature string, bad long, good long")
    counts = counts.groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    n = counts.where("feature = ''").first()
    if n is None or not n.bad or not n.good:
        return Ordinal({}, np.zeros(0), np.full(GRADES - 1, 50.0))
    odds = F.log((F.col("bad") + 0.5) / (n.bad + 1)) - F.log((F.col("good") + 0.5) / (n.good + 1))
    ranked = counts.where("feature <> ''").withColumn("odds", odds)
    ranked = ranked.withColumn("ratio", likelihood_ratio("bad", "good", n.bad, n.good))
    ranked = ranked.where("bad > 1 and odds > 0")
    sure = (F.col("odds") >= LEAST_ODDS) & (F.col("ratio") >= LEAST_RATIO)
    ranked = ranked.withColumn("sure", sure).orderBy(F.desc("sure"), F.desc("ratio"), "feature")
    top = ranked.limit(FEATURES).collect()
    top = [r for r in top if r.sure] or top[:BEST]
    places = {r.feature: i for i, r in enumerate(top)}
    model = Ordinal(places, np.zeros(len(places)), np.full(GRADES - 1, 50.0))
    if not places:
        return model

    def start() -> Callable:
        def work(batch) -> dict:
            found = [model.found(t.as_py()) for t in batch.column("text")]
            return {"at": [list(c.keys()) for c in found], "n": [list(c.values()) for c in found]}

        return work

    rows = map_rows(sample, start, "at array<int>, n array<int>", ("doc_id", "bad")).collect()
    rows.sort(key=lambda r: r.doc_id)
    x = np.zeros((len(rows), len(places)), np.float32)
    for i, r in enumerate(rows):
        x[i, r["at"]] = np.log1p(np.array(r["n"], float))
    bad = np.array([r.bad for r in rows])
    amount = x.sum(axis=1)
    cuts = np.quantile(amount[bad], np.arange(1, GRADES - 1) / (GRADES - 1))
    y = np.where(bad, 1 + np.searchsorted(cuts, amount, side="right"), 0)
    model.weights, model.cuts = fit_ordinal(x, y, l2=PENALTY / len(rows))
    return model


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, toxic, toxic_prob, severity (expected grade), grade.

    Null and empty texts hold no features and get the grade of such texts. An empty table gives
    an empty table.
    """
    model = fit(docs, labels)
    model.memory = {}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start() -> Callable:
        learned = shared.value

        def work(batch) -> dict:
            out: dict[str, list] = {"toxic": [], "toxic_prob": [], "severity": [], "grade": []}
            for text in batch.column("text").to_pylist():
                above = learned.grades(learned.found(text))
                chances = -np.diff(np.concatenate([[1.0], above, [0.0]]))
                out["toxic"].append(bool(above[0] >= TOXIC))
                out["toxic_prob"].append(float(above[0]))
                out["severity"].append(float(above.sum()))
                out["grade"].append(int(chances.argmax()))
            return out

        return work

    schema = "toxic boolean, toxic_prob double, severity double, grade int"
    return map_rows(docs.select("doc_id", "text"), start, schema, ("doc_id",))
