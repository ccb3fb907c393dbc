"""Language identification by nearest centroid.

A text is a vector of hashed byte 2-, 3- and 4-grams, weighted ``(1 + log tf) * idf`` and scaled
to length 1. Each language owns several centroids, found by spherical k-means among its training
texts. The language of the nearest centroid by cosine wins; a text further from it than the
language's own texts of that length are is marked rejected.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linfit.llm.common import give_back, held_out, map_rows

#: Hash buckets of the n-grams.
DIM = 1 << 13
#: Training texts of a language that centroids are fitted on, and the languages there may be.
PER_LANGUAGE = 400
MAX_LANGUAGES = 1000
CENTROIDS = 4
#: A text is rejected below this part of a low quantile of the cosines that a language's texts,
#: cut to the same length, have to centroids fitted without them. The quantile is the lower
#: quartile, since a corpus holds junk as well.
SLACK, LOW = 0.55, 0.25
#: Lengths in bytes that floors are measured at, and the length from which they hold in full:
#: shorter texts say little about their language.
LENGTHS = tuple(1 << k for k in range(4, 13))
FULL = 128
PARTS = 4
UNKNOWN = "und"


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed byte n-grams of the whole lower-case text, blanks around it."""
    data = f" {text.lower()} ".encode("utf-8", "replace")
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    counts = np.zeros(DIM, np.int64)
    code = b
    for n in (2, 3, 4):
        if len(b) < n:
            break
        code = (code[:-1] << np.uint32(8)) | b[n - 1 :]
        mixed = (code ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        counts += np.bincount(mixed >> np.uint32(19), minlength=DIM)
    return counts


def size(text: str) -> int:
    return len(text.lower().encode("utf-8", "replace"))


def beginnings(text: str) -> list[np.ndarray]:
    """Counts of the text cut to each of ``LENGTHS`` that it reaches."""
    data = text.lower().encode("utf-8", "replace")
    return [gram_counts(data[:n].decode("utf-8", "ignore")) for n in LENGTHS if n <= len(data)]


def packed(counts: np.ndarray) -> bytes:
    at = np.flatnonzero(counts)
    return np.concatenate([at, counts[at]]).astype(np.uint32).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    at, n = np.frombuffer(data, np.uint32).reshape(2, -1)
    counts = np.zeros(DIM, np.int64)
    counts[at] = n
    return counts


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass(frozen=True)
class Centroids:
    """What was learned: a weight per bucket, unit centroids, their languages, floors by length."""

    idf: np.ndarray
    centres: np.ndarray
    langs: list[str]
    floors: np.ndarray

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts.astype(np.float32))
        x *= self.idf
        norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return x / np.where(norm > 0, norm, 1)

    def floor(self, centre: int, n: int) -> float:
        """The least cosine of a text of ``n`` bytes."""
        at = np.interp(np.log2(max(n, 1)), np.log2(LENGTHS), self.floors[centre])
        return float(at * min(1.0, n / FULL))

    def predict(self, texts: list[str | None]) -> dict[str, list]:
        lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        rejected = [True] * len(texts)
        at = [i for i, t in enumerate(texts) if has_letter(t)] if self.langs else []
        if at:
            x = self.vectors(np.stack([gram_counts(texts[i]) for i in at]))
            cosine = x @ self.centres.T
            best = cosine.argmax(axis=1)
            for i, c, row in zip(at, best, cosine, strict=True):
                lang[i] = self.langs[c]
                score[i] = float(min(max(row[c], 0.0), 1.0))
                rejected[i] = bool(row[c] < self.floor(c, size(texts[i])))
        return {"lang_pred": lang, "score": score, "rejected": rejected}


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of unit rows, without chance.

    Starts from rows far from each other among the three quarters nearest to the mean, so that
    no odd row gets a centroid to itself at the start.
    """
    mean = x.mean(axis=0)
    near = x @ (mean / max(np.linalg.norm(mean), 1e-12))
    usual = np.flatnonzero(near >= np.quantile(near, 0.25))
    near = near[usual]
    chosen: list[int] = []
    for _ in range(min(k, len(usual))):
        i = int(near.argmin()) if chosen else int(near.argmax())
        own = x[usual] @ x[usual[i]]
        near = np.maximum(near, own) if chosen else own
        chosen.append(i)
    centres = x[usual[sorted(set(chosen))]]
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.stack([x[own == j].sum(axis=0) for j in range(len(centres)) if (own == j).any()])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def floors_of(model: Centroids, cut: list[list[bytes]], x: np.ndarray, k: int) -> np.ndarray:
    """Floors at ``LENGTHS`` of a language with vectors ``x``; ``cut`` has their beginnings, packed.

    Each part of the texts is measured against centroids of the others. Where no text is as
    long, the floor of the length before holds; a language of one text has no floor.
    """
    cosines: list[list[float]] = [[] for _ in LENGTHS]
    part = np.arange(len(x)) % PARTS
    for p in range(PARTS if len(x) > 1 else 0):
        if not (part == p).any():
            continue
        centres = k_means(x[part != p], k)
        for at, found in enumerate(cosines):
            own = [unpacked(cut[i][at]) for i in np.flatnonzero(part == p) if at < len(cut[i])]
            if own:
                found += (model.vectors(np.stack(own)) @ centres.T).max(axis=1).tolist()
    floors, last = [], 0.0
    for found in cosines:
        last = SLACK * float(np.quantile(found, LOW)) if found else last
        floors.append(last)
    return np.array(floors)


def fit(
    docs: DataFrame,
    per_language: int = PER_LANGUAGE,
    centroids: int = CENTROIDS,
) -> Centroids:
    """Learn from ``text`` and non-null ``lang`` of the documents that ``held_out`` leaves.

    Bucket weights come from all of these documents. Centroids come from at most
    ``per_language`` of each language, those whose ids hash lowest. Raises ValueError beyond
    ``MAX_LANGUAGES`` languages. Without any training text everything is unknown.
    """
    known = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    ).select("doc_id", "text", "lang")

    def totals(batches):
        import pyarrow as pa

        seen, n = np.zeros(DIM, np.int64), 0
        for batch in batches:
            for rows in batch.column("text"):
                seen += gram_counts(rows.as_py()) > 0
                n += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *at.tolist()], pa.int64()), pa.array([n, *seen[at].tolist()], pa.int64())],
            ["bucket", "n"],
        )

    counts = known.select("text").mapInArrow(totals, "bucket long, n long")
    rows = counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # DIM + 1 at most
    seen = np.zeros(DIM)
    n = 0
    for r in rows:
        if r.bucket < 0:
            n = r.n
        else:
            seen[r.bucket] = r.n
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)

    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    ids = known.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    ids = ids.withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_language)
    top = ids.groupBy("lang").agg(F.max("h").alias("top"))
    tops = {r.lang: r.top for r in top.limit(MAX_LANGUAGES + 1).collect()}
    if len(tops) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not tops:
        return Centroids(idf, np.zeros((0, DIM), np.float32), [], np.zeros(0))
    limits = docs.sparkSession.createDataFrame(list(tops.items()), "lang string, top long")
    chosen = known.withColumn("h", F.xxhash64("doc_id")).join(F.broadcast(limits), "lang")
    chosen = chosen.where("h <= top").select("lang", "h", "text")

    def start():
        def work(batch):
            found = [gram_counts(t.as_py()) for t in batch.column("text")]
            cut = [beginnings(t.as_py()) for t in batch.column("text")]
            return {
                "whole": [packed(c) for c in found],
                "cut": [[packed(c) for c in several] for several in cut],
            }

        return work

    sample = map_rows(chosen, start, "whole binary, cut array<binary>", ("lang", "h"))
    # Rows of one id may be many, so they are cut off before a language meets in a task.
    order = Window.partitionBy("lang").orderBy("h", "whole", "cut")
    sample = sample.withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_language)
    model = Centroids(idf, np.zeros((0, DIM), np.float32), [], np.zeros(0))
    learned = sample.groupBy("lang").applyInArrow(
        language_fit(model, centroids), "lang string, centres binary, floors binary"
    )
    found = sorted(learned.collect(), key=lambda r: r.lang)  # ``centroids`` rows of each language
    centres = [np.frombuffer(bytes(r.centres), np.float32).reshape(-1, DIM) for r in found]
    langs = [r.lang for r, c in zip(found, centres, strict=True) for _ in c]
    floors = [np.frombuffer(bytes(r.floors)) for r, c in zip(found, centres, strict=True) for _ in c]
    return Centroids(idf, np.vstack(centres), langs, np.array(floors))


def language_fit(model: Centroids, centroids: int) -> Callable:
    """From the sampled texts of a language to its centroids and floors, in a task."""

    def work(table):
        import pyarrow as pa

        try:
            own = sorted(zip(*(table.column(c).to_pylist() for c in ("h", "whole", "cut")), strict=True))
            x = model.vectors(np.stack([unpacked(whole) for _, whole, _ in own]))
            c = k_means(x, centroids)
            floors = floors_of(model, [cut for _, _, cut in own], x, centroids)
            out = (table.column("lang")[0].as_py(), c.astype(np.float32).tobytes(), floors.tobytes())
            return pa.table({k: [v] for k, v in zip(("lang", "centres", "floors"), out)})
        finally:
            own = x = c = None
            give_back()

    return work


def predict(docs: DataFrame, model: Centroids, carry: tuple[str, ...]) -> DataFrame:
    """``carry`` of ``docs`` with ``lang_pred``, ``score`` and ``rejected`` added.

    Reads ``text`` alone. Null texts and texts without a letter are ``und``, score 0, rejected;
    other texts always get a learned language, rejected or not. Columns of the same names are
    replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start() -> Callable:
        learned = shared.value
        return lambda batch: learned.predict(batch.column("text").to_pylist())

    columns = list(dict.fromkeys([*carry, "text"]))
    return map_rows(
        docs.select(*columns), start, "lang_pred string, score double, rejected boolean", carry
    )


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected.

    Repeated rows count and are answered each; of centroids equally near the first counts, in
    code-point order of the languages. Texts of any length are read whole. An empty table gives
    an empty table.
    """
    found = predict(docs, fit(docs), ("doc_id",))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )


def drop_rejected(docs: DataFrame) -> DataFrame:
    """The documents whose language was recognised, with their own columns, whatever their names.

    Nulls, repeats, long texts and empty tables as in ``predict``.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    found = predict(rows, fit(docs), ("row",)).where("not rejected")
    return found.select(*(F.col("row")[c].alias(c) for c in docs.columns))
