"""Approximate nearest neighbours by an adaptive dimension scan.

Vectors are dealt to the lists of their nearest centroids and stored, after a random rotation,
as blocks of columns. A query scans the lists of the centroids nearest to it, block by block. The
rotation makes the distance over the first d of D dimensions, times D / d, an estimate of the
whole one; a candidate whose estimate exceeds the best distances found by more than chance allows
is given up without reading its other blocks. Those that are left are measured exactly, on the
original vectors.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linfit.llm.common import map_rows, stored

NEIGHBOURS = 10
#: Vectors and numbers that centroids are fitted on at most, and centroids at most.
SAMPLE = 20_000
SAMPLE_NUMBERS = 8_000_000
MAX_LISTS = 4096
#: A query scans as many lists as hold this share of the neighbours of ``TRIALS`` sampled vectors
#: within the sample, and ``PROBES`` at least. Neighbours lie further away there than among all
#: vectors, so the share of all neighbours is rather higher.
RECALL = 0.97
TRIALS = 256
PROBES = 16
#: Columns of a block, vectors of a stored chunk, queries that scan a chunk at one time.
COLUMNS = 16
CHUNK = 2048
TOGETHER = 256
#: Standard deviations of the test that abandons candidates.
CERTAINTY = 2.5
SEED = 11


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)[None, :]


def fit_centroids(sample: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """k-means from distinct sampled rows; a centroid that loses all rows stays where it is."""
    distinct = np.unique(sample, axis=0)
    rng = np.random.default_rng(SEED)
    centres = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        own = np.concatenate([squared(p, centres).argmin(axis=1) for p in np.array_split(sample, max(1, len(sample) // 4096))])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        n = np.bincount(own, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def needed_probes(sample: np.ndarray, centres: np.ndarray, k: int) -> int:
    """Lists to scan for ``RECALL``; the sample is in an order that owes nothing to the vectors."""
    own = np.concatenate([squared(p, centres).argmin(axis=1) for p in np.array_split(sample, max(1, len(sample) // 4096))])
    ranks: list[int] = []
    for i in range(min(TRIALS, len(sample))):
        gap = ((sample - sample[i]) ** 2).sum(axis=1)
        gap[i] = np.inf
        near = np.argsort(gap, kind="stable")[: min(k, len(sample) - 1)]
        place = np.empty(len(centres), int)
        place[np.argsort(squared(sample[i : i + 1], centres)[0], kind="stable")] = np.arange(len(centres))
        ranks += place[own[near]].tolist()
    return max(PROBES, int(np.quantile(ranks, RECALL)) + 1 if ranks else 0)


def scan(
    query: np.ndarray,
    rotated_query: np.ndarray,
    own: int,
    ids: np.ndarray,
    vectors: np.ndarray,
    blocks: list[np.ndarray],
    k: int,
) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest of a chunk that the adaptive scan finds: ids and exact distances."""
    dim = vectors.shape[1]
    alive = np.flatnonzero(ids != own)
    partial = np.zeros(len(alive))
    limit, seeds, read = np.inf, None, 0
    norm = float(query @ query)
    for number, block in enumerate(blocks):
        gap = block[alive] - rotated_query[read : read + block.shape[1]]
        partial = partial + (gap * gap).sum(axis=1)
        read += block.shape[1]
        if number == 0 and len(alive) > 4 * k and len(blocks) > 1:
            # The most promising ones are measured whole; they set the distance to beat.
            seeds = alive[np.argpartition(partial, 4 * k)[: 4 * k]]
            whole = ((vectors[seeds] - query) ** 2).sum(axis=1)
            limit = float(np.partition(whole, k - 1)[k - 1])
        if read < dim and limit < np.inf:
            bound = limit * (1 + CERTAINTY / np.sqrt(read)) ** 2 * read / dim
            # Stored columns are single precision: equal vectors differ by their rounding.
            bound += 1e-5 * np.sqrt(limit * norm) + 1e-10 * norm
            stay = partial <= bound
            alive, partial = alive[stay], partial[stay]
    if seeds is not None:
        alive = np.union1d(alive, seeds)
    exact = np.sqrt(((vectors[alive] - query) ** 2).sum(axis=1))
    order = np.lexsort((ids[alive], exact))[:k]
    return ids[alive][order], exact[order]


def nearest(vectors: DataFrame, queries: Column, k: int = NEIGHBOURS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest of each row for which ``queries`` holds.

    ``vectors`` has (vec_id, embedding); the score is the Euclidean distance. Candidates are all
    rows but the query's own, ties go to the smaller vec_id, and a query gets fewer rows only
    where there are fewer candidates. Left out are null ids, vectors that are null, empty or
    zero or hold null or non-finite components, and those of another length than most have
    (of equally many, the shorter). Of rows with one vec_id the least vector counts. An empty
    table gives an empty table.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    vector = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    rows = stored(rows.groupBy("vec_id").agg(F.min("v").alias("v")), "ann-vectors")
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), "dim").first()
    if most is None:
        return empty
    dim, n = most.dim, most.n
    rows = rows.where(F.size("v") == dim)

    top = max(1, min(SAMPLE, SAMPLE_NUMBERS // dim))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(top).select("v").collect()
    lists = max(1, min(MAX_LISTS, int(np.sqrt(n)), len(sample)))
    sampled = np.array([r.v for r in sample])
    centres = fit_centroids(sampled, lists)
    lists = len(centres)
    probes = needed_probes(sampled, centres, k)
    shared = spark.sparkContext.broadcast(centres)  # MAX_LISTS rows at most

    def start_assign() -> Callable:
        def work(batch) -> dict:
            x = np.array(batch.column("v").to_pylist(), float).reshape(-1, dim)
            return {"list": squared(x, shared.value).argmin(axis=1)}

        return work

    placed = stored(map_rows(rows, start_assign, "list int", ("vec_id", "v")), "ann-placed")
    filled = {r.list: r.n for r in placed.groupBy("list").agg(F.count("*").alias("n")).collect()}
    chunks = {i: max(1, -(-m // CHUNK)) for i, m in filled.items()}
    per_list = spark.createDataFrame(list(chunks.items()), "list int, chunks int")
    turned = spark.sparkContext.broadcast(rotation(dim))

    def pack(key, part):
        import pandas as pd

        v = np.array(part["v"].tolist(), float).reshape(-1, dim)
        r = (v @ turned.value).astype(np.float32)
        columns = b"".join(np.ascontiguousarray(r[:, c : c + COLUMNS]).tobytes() for c in range(0, dim, COLUMNS))
        return pd.DataFrame(
            {"list": [key[0]], "chunk": [key[1]], "ids": [part["vec_id"].to_numpy(np.int64).tobytes()], "vectors": [v.tobytes()], "columns": [columns]}
        )

    chunk = F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int")
    packed = placed.join(F.broadcast(per_list), "list").withColumn("chunk", chunk)
    packed = packed.groupBy("list", "chunk").applyInPandas(
        pack, "list int, chunk int, ids binary, vectors binary, columns binary"
    )

    def start_probe() -> Callable:
        size = np.array([filled.get(i, 0) for i in range(lists)])

        def work(batch) -> dict:
            x = np.array(batch.column("v").to_pylist(), float).reshape(-1, dim)
            out = []
            for row in np.argsort(squared(x, shared.value), axis=1, kind="stable"):
                # Further lists until there are enough candidates beside the query itself.
                need = int(np.searchsorted(np.cumsum(size[row]), k + 1)) + 1
                out.append(row[: max(probes, need)].tolist())
            return {"lists": out}

        return work

    asked = map_rows(rows.where(queries), start_probe, "lists array<int>", ("vec_id", "v"))
    asked = stored(asked.select("vec_id", "v", F.explode("lists").alias("list")), "ann-probes")
    busy = asked.groupBy("list").agg(F.ceil(F.count("*") / TOGETHER).cast("int").alias("groups"))
    asked = asked.join(busy, "list").join(F.broadcast(per_list), "list")
    asked = asked.withColumn("group", F.pmod(F.xxhash64("vec_id"), F.col("groups")))
    asked = asked.groupBy("list", "chunks", "group").agg(
        F.collect_list(F.struct("vec_id", "v")).alias("asked")  # about TOGETHER
    )
    asked = asked.select("list", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "asked")
    meet = packed.join(asked, ["list", "chunk"])

    def start_scan() -> Callable:
        def work(batch) -> dict:
            out = []
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                v = np.frombuffer(row["vectors"], float).reshape(-1, dim)
                flat = np.frombuffer(row["columns"], np.float32)
                blocks, at = [], 0
                for c in range(0, dim, COLUMNS):
                    width = min(COLUMNS, dim - c)
                    blocks.append(flat[at : at + len(v) * width].reshape(len(v), width))
                    at += len(v) * width
                hits = []
                for one in row["asked"]:
                    q = np.array(one["v"])
                    near, far = scan(q, q @ turned.value, one["vec_id"], ids, v, blocks, k)
                    hits += [(one["vec_id"], int(i), float(d)) for i, d in zip(near, far, strict=True)]
                out.append([{"query_id": a, "vec_id": b, "score": c} for a, b, c in hits])
            return {"hits": out}

        return work

    hits = map_rows(meet, start_scan, "hits array<struct<query_id:long,vec_id:long,score:double>>")
    hits = hits.select(F.explode("hits").alias("h")).select("h.*")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
