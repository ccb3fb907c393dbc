"""Hard-negative mining by slot-decomposed selection.

An anchor's positives, best first, each open a window of scores from which negatives are drawn.
The windows overlap, but their upper limits cut the scores into disjoint slots: a negative lies in
the slot of the smallest limit that it does not exceed. For each slot the best few negatives are
enough; every task combines them as it goes, and they are merged by (anchor, slot). A window's
answer is the best few of its own slot and all lower ones, down to its lower limit: one merge over
the slots in descending order answers all windows.

Rows and anchors are scored block against block with one matrix product. Anchors, the smaller
side, are dealt to all blocks of rows; no block holds more than a fixed number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linfit.llm.common import stored

POSITIVES = 5
NEGATIVES = 3
#: A negative's score lies between these hundredths of the positive's.
LEAST, MOST = 50, 95
SCALE = 256
#: Rows of a block at most, anchors of a block, and bytes of a block's vectors.
ROWS = 4096
ANCHORS = 256
BLOCK_BYTES = 4_000_000
#: Anchors whose best a task holds before it hands them on.
HELD = 32_768
#: Products and sums of whole numbers up to this size are exact in doubles; scores stay below TOP.
_EXACT = float(1 << 53)
_TOP = 1 << 56
_LOWEST = -(1 << 63)


def usable(vector: Column) -> Column:
    """Not null, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite


def labelled_rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, key, label, v) of the rows that take part; rows equal in all columns are one.

    ``key`` tells apart different rows with one vec_id.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
    )
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    rows = rows.withColumn("key", F.xxhash64("label", "v")).dropDuplicates(["vec_id", "key"])
    return rows.select("vec_id", "key", "label", "v")


def _pack(rows: DataFrame, size: int, scale: int, name: str) -> DataFrame:
    """Blocks of rows of one length, made within partitions, in the shared folder.

    Vectors become floor(scale * x). Columns beside the vector must hold longs, or arrays of
    longs that are all of one length.
    """
    others = [c for c in rows.columns if c != "v"]
    schema = ", ".join(["block long, dim int, v binary", *(f"{c} binary" for c in others)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}

        def block(dim: int) -> pa.RecordBatch:
            nonlocal number
            parts = [np.concatenate(x) for x in zip(*held.pop(dim), strict=True)]
            number += 1
            out = [pa.array([number], pa.int64()), pa.array([dim], pa.int32())]
            out += [pa.array([p.tobytes()], pa.binary()) for p in parts]
            return pa.RecordBatch.from_arrays(out, names=["block", "dim", "v", *others])

        for batch in batches:
            vectors = batch.column("v")
            length = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat, end = vectors.flatten().to_numpy(zero_copy_only=False), np.cumsum(length)
            plain = []
            for c in others:
                x = batch.column(c)
                x = x.flatten() if pa.types.is_list(x.type) else x
                plain.append(x.to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
            for dim in np.unique(length).tolist():
                most = max(1, min(size, BLOCK_BYTES // (8 * max(1, dim))))
                at = np.flatnonzero(length == dim)
                while len(at):
                    now = at[: most - sum(len(x[0]) for x in held.get(dim, []))]
                    at = at[len(now) :]
                    v = np.floor(flat[(end[now] - dim)[:, None] + np.arange(dim)] * scale)
                    held.setdefault(dim, []).append((v, *(p[now] for p in plain)))
                    if sum(len(x[0]) for x in held[dim]) == most:
                        yield block(dim)
        for dim in list(held):
            yield block(dim)

    return stored(rows.mapInArrow(run, schema), name)


def _meet(anchors: DataFrame, rows: DataFrame, deals: int) -> DataFrame:
    """Each block of anchors beside each block of rows of the same length.

    The planner sizes the anchors as they are before they are dealt out, so it must not choose to
    broadcast them.
    """
    deal = F.pmod(F.xxhash64("block"), F.lit(deals)).cast("int")
    rows = rows.select(deal.alias("deal"), "dim", *(F.col(c).alias(f"row_{c}") for c in ("vec_id", "key", "label", "v")))
    asked = anchors.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))
    return asked.join(rows.hint("merge"), ["deal", "dim"]).drop("deal", "block")


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of rows of whole numbers, exactly."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < _EXACT:
        return (a @ b.T).astype(np.int64)
    if not np.isfinite(top):
        raise ValueError("vectors too large to score")
    x, y = ([[int(v) for v in row] for row in m] for m in (a, b))
    out = np.array(x, object) @ np.array(y, object).T
    if np.abs(out).max(initial=0) >= _TOP:
        raise ValueError("scores beyond 56 bits; use a smaller scale")
    return out.astype(np.int64)


class _Best:
    """The best ``k`` of each group so far: highest score, then smallest id, then key."""

    def __init__(self, k: int):
        self.k, self.parts, self.compact, self.new = k, [], 0, 0

    def add(self, *part: np.ndarray) -> None:
        """(group, score, id, key) of equal length."""
        self.parts.append(part)
        self.new += len(part[0])
        if self.new > self.compact + 100_000:
            self.result()

    def result(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        group, score, ids, keys = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((keys, ids, -score, group))
        group = group[order]
        order = order[np.arange(len(group)) - np.searchsorted(group, group) < self.k]
        group = group[np.arange(len(group)) - np.searchsorted(group, group) < self.k]
        self.parts = [(group, score[order], ids[order], keys[order])]
        self.compact, self.new = len(group), 0
        return self.parts[0]


def _top(score: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the best ``k`` allowed scores of each row, and of all ties with the last."""
    held = np.where(allowed, score, _LOWEST)
    cut = max(0, score.shape[1] - k)
    least = np.partition(held, cut, axis=1)[:, cut]
    return np.nonzero(allowed & (held >= least[:, None]))


def _combined(meet: DataFrame, k: int, width: int) -> DataFrame:
    """The best ``k`` of every (anchor_id, anchor_key, slot): score, vec_id, key, rank.

    Without limits there is one slot, and it takes rows of the anchor's label; with them the
    slots lie between one limit and the next, and take rows of other labels.
    """
    slots = "limits" in meet.columns
    names = ["anchor_id", "anchor_key", "slot", "score", "vec_id", "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, number = _Best(k), {}

        def flush() -> pa.RecordBatch:
            group, score, ids, keys = best.result()
            who = np.array(list(number), np.int64).reshape(-1, 2)[group // width]
            columns = [who[:, 0], who[:, 1], group % width, score, ids, keys]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                own, own_key, own_label, ids, keys, labels = (
                    np.frombuffer(row[c], np.int64) for c in ("vec_id", "key", "label", "row_vec_id", "row_key", "row_label")
                )
                a, b = (np.frombuffer(row[c], float).reshape(n, row["dim"]) for c, n in (("v", len(own)), ("row_v", len(ids))))
                score = scores(a, b)
                same = own_label[:, None] == labels[None, :]
                if len(number) + len(own) > HELD and number:
                    yield flush()
                    best, number = _Best(k), {}
                group = np.array([number.setdefault(x, len(number)) for x in zip(own.tolist(), own_key.tolist(), strict=True)]) * width
                if not slots:
                    itself = (own[:, None] == ids[None, :]) & (own_key[:, None] == keys[None, :])
                    x, y = _top(score, same & ~itself, k)
                    best.add(group[x], score[x, y], ids[y], keys[y])
                    continue
                limits = np.frombuffer(row["limits"], np.int64).reshape(len(own), width)
                for slot in range(width):
                    inside = ~same & (score <= limits[:, slot, None])
                    if slot + 1 < width:
                        inside &= score > limits[:, slot + 1, None]
                    x, y = _top(score, inside, k)
                    best.add(group[x] + slot, score[x, y], ids[y], keys[y])
        if number:
            yield flush()

    found = meet.mapInArrow(run, ", ".join(f"{c} long" for c in names))
    order = Window.partitionBy("anchor_id", "anchor_key", "slot").orderBy(F.desc("score"), "vec_id", "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
    scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has (vec_id, embedding, label); ``anchors`` is a condition on vec_id. A score is
    the inner product of floor(scale * x); higher is better, ties go to the smaller vec_id. The
    positives of an anchor are its first ``positives`` other rows of its label; for each of them
    the first ``negatives`` rows of other labels are returned whose score lies between ``least``
    and ``most`` hundredths of the positive's, both included.

    Left out are rows with a null vec_id, label or vector, or a component that is null or not
    finite; empty vectors score 0. Vectors are compared with those of the same length. Rows alike
    in all three columns are one row, different rows with one vec_id stay different ones and so
    may repeat an anchor's rows. An empty table gives an empty table; scores beyond 56 bits raise.
    """
    rows = stored(labelled_rows(vectors), "negative-rows")
    blocks = _pack(rows, ROWS, scale, "negative-blocks")
    # Even where partitions left blocks half empty, each deal holds about one.
    deals = max(1, blocks.count())
    asked = rows.where(anchors)
    first = _pack(asked, ANCHORS, scale, "negative-anchors")
    best = _combined(_meet(first, blocks, deals), positives, 1)
    # The greatest whole score within the upper limit.
    limit = F.expr(f"(score * {most} - pmod(score * {most}, 100)) div 100")
    best = stored(best.select("anchor_id", "anchor_key", "rank", "score", "vec_id", limit.alias("limit")), "negative-positives")
    limits = best.groupBy("anchor_id", "anchor_key").agg(F.sort_array(F.collect_set("limit"), asc=False).alias("limits"))
    padded = F.slice(F.concat("limits", F.array_repeat(F.lit(_LOWEST), positives)), 1, positives)
    keyed = limits.select(F.col("anchor_id").alias("vec_id"), F.col("anchor_key").alias("key"), padded.alias("limits"))
    second = _pack(asked.join(keyed.hint("merge"), ["vec_id", "key"]), ANCHORS, scale, "negative-limits")
    slots = _combined(_meet(second, blocks, deals), negatives, positives)
    order = F.struct("slot", (-F.col("score")).alias("down"), "vec_id", "key")
    slots = slots.groupBy("anchor_id", "anchor_key").agg(F.sort_array(F.collect_list(order)).alias("slots"))
    found = best.join(limits.hint("merge"), ["anchor_id", "anchor_key"]).join(slots.hint("merge"), ["anchor_id", "anchor_key"])
    # Slots descend, so a window's best are the first of its own slot and the lower ones.
    own = F.array_position("limits", F.col("limit")) - 1
    window = F.slice(F.filter("slots", lambda s: s["slot"] >= own), 1, negatives)
    window = F.filter(window, lambda s: -s["down"] * 100 >= F.col("score") * least)
    found = found.select("anchor_id", "vec_id", "score", F.posexplode(window))
    return found.select(
        "anchor_id",
        F.col("vec_id").alias("positive_id"),
        (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("col.vec_id").alias("negative_id"),
        F.col("score").alias("positive_score"),
        (-F.col("col.down")).alias("negative_score"),
    )
