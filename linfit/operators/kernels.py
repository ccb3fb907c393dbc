"""What runs inside tasks on Arrow batches: one small partial result per partition.

This module needs only numpy and pyarrow and travels with the tasks, so executors do not need
this package installed.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Batches = Iterator[pa.RecordBatch]

# Blocks and the batches they travel in stay small enough that the JVM fills one batch while
# Python works on the one before, and both keep to their caches.
BLOCK_BYTES = 1 << 17
BATCH_BYTES = 1 << 20
# Rows gathered before equal ones are merged, the bytes of merged rows that a task holds, and the
# rows after which merging that halves nothing is given up.
MERGE_ROWS = 1 << 15
MERGE_BYTES = 1 << 24
MERGE_TRIAL = 1 << 17
BLOCK_SCHEMA = (
    "rows long, unusable long, min_width int, max_width int, y binary, fold binary, x binary,"
    " part int"
)


def partial_batch(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(parts), pa.int32()),
            pa.array(list(parts.values()), pa.list_(pa.float64())),
        ],
        names=["fit", "part"],
    )


def matrix(vectors: pa.ListArray) -> np.ndarray:
    """Rows of an array column as a dense matrix; a null or a ragged row raises."""
    values = vectors.flatten()
    if vectors.null_count or values.null_count:
        raise ValueError("null feature vector or element")
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    sizes = pc.list_value_length(vectors).to_numpy()
    if len(sizes) and sizes.min() != sizes.max():
        raise ValueError(f"feature vectors differ in length: {sizes.min()} to {sizes.max()}")
    return flat.reshape(len(sizes), -1)


def packer(classes: int | None, apart: bool = False) -> Callable[[Batches], Batches]:
    """Rows of (label, fold, features[, draws]) to one record per block, features by columns.

    Labels are the whole numbers below ``classes``, or any numbers where that is None. With
    ``apart`` no block holds rows of two folds; rows should come sorted by fold. Draws are counts
    by replicate, one array a row.
    """

    def pack(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                values = max(1, len(batch.column(2).flatten()))
                rows = max(64, BLOCK_BYTES * batch.num_rows // (8 * values))
                for run in _runs(batch) if apart else [batch]:
                    for start in range(0, run.num_rows, rows):
                        yield _pack_block(run.slice(start, rows), classes)

    return pack


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    fold = batch.column(1).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(fold[1:] != fold[:-1]) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        yield batch.slice(start, end - start)


def _usable_labels(y: np.ndarray, classes: int | None) -> np.ndarray:
    if classes is None:
        return np.isfinite(y)
    return (y >= 0.0) & (y < classes) & (y == np.floor(y))


def _pack_block(
    batch: pa.RecordBatch, classes: int | None, extra: dict[str, bytes] | None = None
) -> pa.RecordBatch:
    label, fold, vectors = batch.columns[:3]
    y = label.to_numpy(zero_copy_only=False).astype(np.float64)
    folds = fold.to_numpy(zero_copy_only=False).astype(np.int32)
    sizes = pc.list_value_length(vectors).fill_null(-1).to_numpy()
    values = vectors.flatten()
    unusable = (
        int(np.count_nonzero(~_usable_labels(y, classes)))
        + int(np.count_nonzero(sizes < 0))
        + values.null_count
    )
    narrow, wide = int(sizes.min()), int(sizes.max())
    x = b""
    if unusable == 0 and narrow == wide:
        x = np.ascontiguousarray(matrix(vectors).T).tobytes()
    extra = extra or {}
    if batch.num_columns > 3:
        extra["draws"] = matrix(batch.column(3)).T.astype(np.uint8).tobytes()
    return _record(len(y), unusable, narrow, wide, y, folds, x, extra)


def _record(
    rows: int,
    unusable: int,
    narrow: int,
    wide: int,
    y: np.ndarray,
    folds: np.ndarray,
    x: bytes,
    extra: dict[str, bytes],
) -> pa.RecordBatch:
    columns = [
        pa.array([rows], pa.int64()),
        pa.array([unusable], pa.int64()),
        pa.array([narrow], pa.int32()),
        pa.array([wide], pa.int32()),
        pa.array([y.tobytes()], pa.binary()),
        pa.array([folds.tobytes()], pa.binary()),
        pa.array([x], pa.binary()),
        pa.array([int(folds[0])], pa.int32()),
        *(pa.array([v], pa.binary()) for v in extra.values()),
    ]
    names = ["rows", "unusable", "min_width", "max_width", "y", "fold", "x", "part", *extra]
    return pa.RecordBatch.from_arrays(columns, names=names)


def merging_packer(classes: int | None) -> Callable[[Batches], Batches]:
    """As ``packer``, with one row for equal ones of a task and ``times``, how often it stands there.

    Draws of equal rows are added up, as doubles. Where merging does not halve the rows, later
    ones are passed on as they are.
    """

    def columns(batch: pa.RecordBatch) -> pa.Table | None:
        label, fold, vectors = batch.columns[:3]
        y = label.to_numpy(zero_copy_only=False).astype(np.float64)
        sizes = pc.list_value_length(vectors).fill_null(-1).to_numpy()
        if not _usable_labels(y, classes).all() or sizes.min() != sizes.max() or sizes[0] < 1:
            return None
        if vectors.flatten().null_count:
            return None
        folds = fold.to_numpy(zero_copy_only=False).astype(np.int32)
        found = {"y": pa.array(y), "fold": pa.array(folds)}
        found |= {f"x{i}": pa.array(v) for i, v in enumerate(np.ascontiguousarray(matrix(vectors).T))}
        found["times"] = pa.array(np.ones(len(y)))
        if batch.num_columns > 3:
            drawn = np.ascontiguousarray(matrix(batch.column(3)).T.astype(np.float64))
            found |= {f"d{i}": pa.array(v) for i, v in enumerate(drawn)}
        return pa.table(found)

    def merged(tables: list[pa.Table]) -> pa.Table:
        whole = pa.concat_tables(tables)
        keys = [n for n in whole.column_names if n == "fold" or n[0] in "xy"]
        sums = [n for n in whole.column_names if n not in keys]
        added = whole.group_by(keys, use_threads=False).aggregate([(n, "sum") for n in sums])
        return added.select([*keys, *(f"{n}_sum" for n in sums)]).rename_columns([*keys, *sums])

    def blocks(table: pa.Table) -> Batches:
        at = {n: c.to_numpy() for n, c in zip(table.column_names, table.columns)}
        x, drawn = (np.array([v for n, v in at.items() if n[0] == k]) for k in "xd")
        rows = max(64, BLOCK_BYTES // (8 * len(x)))
        for start in range(0, table.num_rows, rows):
            y, fold, times = (at[n][start : start + rows] for n in ("y", "fold", "times"))
            extra = {"times": times.tobytes()}
            if len(drawn):
                extra["draws"] = drawn[:, start : start + rows].tobytes()
            part = np.ascontiguousarray(x[:, start : start + rows]).tobytes()
            yield _record(int(times.sum()), 0, len(x), len(x), y, fold, part, extra)

    def pack(batches: Batches) -> Batches:
        held: list[pa.Table] = []
        seen, pays = 0, True
        for batch in batches:
            if not batch.num_rows:
                continue
            found = columns(batch)
            if found is None or held and found.column_names != held[0].column_names:
                # What is unusable goes on as it is, to be counted and refused.
                yield _pack_block(batch, classes, {"times": b""})
                continue
            held.append(found)
            seen += found.num_rows
            rows = sum(t.num_rows for t in held)
            if not pays:
                yield from blocks(held.pop())
            elif rows - held[0].num_rows >= max(MERGE_ROWS, held[0].num_rows):
                held = [merged(held)]
                if seen >= MERGE_TRIAL and 2 * held[0].num_rows > seen:
                    pays = False
                if not pays or held[0].nbytes > MERGE_BYTES:
                    yield from blocks(held.pop())
                    seen = 0
        if held:
            yield from blocks(merged(held))

    return pack


def _blocks(batches: Batches, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for y, fold, x in zip(*(batch.column(name) for name in ("y", "fold", "x"))):
            yield (
                np.frombuffer(y.as_buffer(), np.float64),
                np.frombuffer(fold.as_buffer(), np.int32),
                np.frombuffer(x.as_buffer(), np.float64).reshape(width, -1),
            )


def _counted_blocks(batches: Batches, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks with how often each row counts, or None where they do not say."""
    for batch in batches:
        times = batch.column("times") if "times" in batch.schema.names else None
        for i, block in enumerate(_blocks(iter([batch]), width)):
            yield *block, None if times is None else np.frombuffer(times[i].as_buffer(), np.float64)


def _drawn_blocks(batches: Batches, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks with their draws, replicates x rows, or None where they carry none.

    Merged rows hold sums of draws; without draws their counts stand for one replicate.
    """
    for batch in batches:
        names = batch.schema.names
        kind = np.float64 if "times" in names else np.uint8
        drawn = batch.column("draws") if "draws" in names else None
        for i, (y, fold, x, times) in enumerate(_counted_blocks(iter([batch]), width)):
            if drawn is not None:
                yield y, fold, x, np.frombuffer(drawn[i].as_buffer(), kind).reshape(-1, len(y))
            else:
                yield y, fold, x, None if times is None else times[None, :]


def _expand(x: np.ndarray, products: list[tuple[int, int]]) -> np.ndarray:
    """Append one row per product (position of an earlier row, position of an input)."""
    if not products:
        return x
    out = np.empty((len(x) + len(products), x.shape[1]))
    out[: len(x)] = x
    for at, (earlier, factor) in enumerate(products, len(x)):
        np.multiply(out[earlier], x[factor], out=out[at])
    return out


def logistic_pass(
    width: int,
    products: list[tuple[int, int]],
    groups: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]],
    hessian: bool,
    intercept: bool,
) -> Callable[[Batches], Batches]:
    """Gradient, loss and count of many fits in one read of the blocks.

    A group holds the fits that share a number of terms: ``(terms, fit ids, held-out folds,
    coefficients by fit, intercepts)``. A fit sees every row outside its held-out fold. Per fit
    the result is the gradient, the intercept's gradient, the total loss and the row count, then
    on request the packed upper triangle of the Hessian, the intercept last. Where blocks carry
    draws, fit i counts a row as often as replicate i drew it; merged rows count as often as they
    stand for.
    """

    def run(batches: Batches) -> Batches:
        sums: dict[int, np.ndarray] = {}
        for y, fold, x, drawn in _drawn_blocks(batches, width):
            terms = _expand(x, products)
            for m, ids, held_out, theta, bias in groups:
                rows = terms[:m]
                z = theta @ rows + bias[:, None]
                seen = held_out[:, None] != fold[None, :]
                if drawn is not None:
                    seen = seen * (drawn if len(drawn) == 1 else drawn[ids]).astype(np.float64)
                shrunk = np.exp(-np.abs(z))
                sigma = np.where(z < 0, shrunk, 1.0) / (1.0 + shrunk)
                loss = np.maximum(np.where(y == 1.0, -z, z), 0.0) + np.log1p(shrunk)
                residual = (sigma - y) * seen
                found = np.column_stack(
                    [
                        residual @ rows.T,
                        residual.sum(axis=1),
                        (loss * seen).sum(axis=1),
                        seen.sum(axis=1),
                    ]
                )
                if hessian:
                    weight = sigma * (1.0 - sigma) * seen
                    basis = np.vstack([rows, np.ones((1, len(y)))]) if intercept else rows
                    lower = np.tril_indices(len(basis))
                    found = np.column_stack(
                        [found, np.stack([((basis * w) @ basis.T)[lower] for w in weight])]
                    )
                for fit, values in zip(ids.tolist(), found):
                    sums[fit] = sums[fit] + values if fit in sums else values
        if sums:
            yield partial_batch(sums)

    return run


def confusion_pass(
    width: int,
    products: list[tuple[int, int]],
    groups: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]],
    threshold: float,
) -> Callable[[Batches], Batches]:
    """TP, TN, FP, FN of many fitted models, each on its own held-out fold."""

    def run(batches: Batches) -> Batches:
        sums: dict[int, np.ndarray] = {}
        for y, fold, x, times in _counted_blocks(batches, width):
            terms = _expand(x, products)
            each = np.ones(len(y)) if times is None else times
            for m, ids, held_out, theta, bias in groups:
                z = theta @ terms[:m] + bias[:, None]
                shrunk = np.exp(-np.abs(z))
                said = np.where(z < 0, shrunk, 1.0) / (1.0 + shrunk) >= threshold
                scored = held_out[:, None] == fold[None, :]
                truth = (y == 1.0)[None, :]
                counts = np.column_stack(
                    [
                        (scored & said & truth) @ each,
                        (scored & ~said & ~truth) @ each,
                        (scored & said & ~truth) @ each,
                        (scored & ~said & truth) @ each,
                    ]
                )
                for fit, values in zip(ids.tolist(), counts):
                    sums[fit] = sums[fit] + values if fit in sums else values
        if sums:
            yield partial_batch(sums)

    return run


def held_out_scores(
    width: int,
    products: list[tuple[int, int]],
    groups: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]],
) -> Callable[[Batches], Batches]:
    """(fit, score, pos, neg): margins of many fits on their held-out folds, counted by block."""

    def run(batches: Batches) -> Batches:
        for y, fold, x, times in _counted_blocks(batches, width):
            terms = _expand(x, products)
            each = np.ones(len(y)) if times is None else times
            for m, ids, held_out, theta, bias in groups:
                for i, held, weights, level in zip(ids.tolist(), held_out, theta, bias):
                    own = fold == held
                    if own.any():
                        # Term by term: a matrix product may round equal rows apart, and they
                        # have to tie.
                        z = np.full(int(own.sum()), level)
                        for w, row in zip(weights, terms[:m]):
                            z += w * row[own]
                        score, at = np.unique(z, return_inverse=True)
                        pos = np.bincount(at, y[own] * each[own], len(score))
                        every = np.bincount(at, each[own], len(score))
                        columns = [np.full(len(score), i, np.int32), score, pos, every - pos]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c) for c in columns], names=["fit", "score", "pos", "neg"]
                        )

    return run


def out_of_bag_pass(
    width: int, theta: np.ndarray, bias: np.ndarray, floor: float
) -> Callable[[Batches], Batches]:
    """Rows that some replicate left out, hits and loss of their mean probability over these."""

    def run(batches: Batches) -> Batches:
        sums = np.zeros(3)
        for y, _, x, drawn in _drawn_blocks(batches, width):
            z = theta @ x + bias[:, None]
            shrunk = np.exp(-np.abs(z))
            free = drawn == 0
            times = free.sum(axis=0)
            p = (np.where(z < 0, shrunk, 1.0) / (1.0 + shrunk) * free).sum(axis=0)[times > 0]
            p, truth = p / times[times > 0], y[times > 0] == 1.0
            own = np.maximum(np.where(truth, p, 1.0 - p), floor)
            sums += len(p), np.count_nonzero((p >= 0.5) == truth), -np.log(own).sum()
        yield partial_batch({0: sums})

    return run


def bagged_scores(theta: np.ndarray, bias: np.ndarray) -> Callable[[Batches], Batches]:
    """Rows of (keys.., features): the features replaced by the replicates' mean probability."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(batch.num_columns - 1))
            if x.shape[1] != theta.shape[1]:
                raise ValueError(f"expected feature vectors of {theta.shape[1]}, not {x.shape[1]}")
            z = x @ theta.T + bias
            shrunk = np.exp(-np.abs(z))
            p = (np.where(z < 0, shrunk, 1.0) / (1.0 + shrunk)).mean(axis=1)
            names = [*batch.schema.names[:-1], "prediction_prob"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p)], names=names)

    return run


def softmax_pass(
    width: int,
    ids: np.ndarray,
    held_out: np.ndarray,
    theta: np.ndarray,
    bias: np.ndarray,
    floor: float | None = None,
) -> Callable[[Batches], Batches]:
    """Gradient, loss and count of many multinomial fits in one read of the blocks.

    ``theta`` is fits x classes x features, ``bias`` fits x classes. A fit sees every row outside
    its held-out fold; its result is the gradient by class, the intercepts' gradients, the total
    loss and the row count. With ``floor`` it is scored instead: the loss, with probabilities no
    less than the floor, and the count of its held-out fold alone.
    """
    fits, classes = bias.shape
    flat, level = theta.reshape(fits * classes, width), bias.reshape(fits * classes, 1)

    def run(batches: Batches) -> Batches:
        sums = None
        for y, fold, x in _blocks(batches, width):
            z = (flat @ x + level).reshape(fits, classes, -1)
            z -= z.max(axis=1, keepdims=True)
            truth = (slice(None), y.astype(np.int64), np.arange(len(y)))
            own = z[truth]
            np.exp(z, out=z)
            whole = z.sum(axis=1)
            seen = held_out[:, None] != fold[None, :]
            if floor is not None:
                loss = -np.log(np.maximum(np.exp(own) / whole, floor)) * ~seen
                found = np.column_stack([loss.sum(axis=1), (~seen).sum(axis=1)])
            else:
                loss = ((np.log(whole) - own) * seen).sum(axis=1)
                z /= whole[:, None, :]
                z[truth] -= 1.0
                z *= seen[:, None, :]
                slope = (z.reshape(fits * classes, -1) @ x.T).reshape(fits, -1)
                found = np.column_stack([slope, z.sum(axis=2), loss, seen.sum(axis=1)])
            sums = found if sums is None else sums + found
        if sums is not None:
            yield partial_batch(dict(zip(ids.tolist(), sums, strict=True)))

    return run


def softmax_scores(theta: np.ndarray, bias: np.ndarray) -> Callable[[Batches], Batches]:
    """Rows of (keys.., features): the features replaced by the probabilities of all classes."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(batch.num_columns - 1))
            if x.shape[1] != theta.shape[1]:
                raise ValueError(f"expected feature vectors of {theta.shape[1]}, not {x.shape[1]}")
            z = x @ theta.T + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            ends = pa.array(np.arange(len(p) + 1) * len(bias), pa.int32())
            vectors = pa.ListArray.from_arrays(ends, pa.array(p.ravel()))
            names = [*batch.schema.names[:-1], "probability"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], vectors], names=names)

    return run


def fold_moments_pass(
    width: int, shift: np.ndarray, products: bool
) -> Callable[[Batches], Batches]:
    """By fold: the row count, the sums of (x, y) - shift, and of their squares or products.

    Products are the lower triangle of the whole square, row by row.
    """
    lower = np.tril_indices(width + 1)

    def run(batches: Batches) -> Batches:
        sums: dict[int, np.ndarray] = {}
        for y, fold, x in _blocks(batches, width):
            v = np.vstack([x, y[None, :]]) - shift[:, None]
            for f in np.unique(fold).tolist():
                own = v[:, fold == f]
                second = (own @ own.T)[lower] if products else (own * own).sum(axis=1)
                found = np.concatenate([[own.shape[1]], own.sum(axis=1), second])
                sums[f] = sums[f] + found if f in sums else found
        if sums:
            yield partial_batch(sums)

    return run


def split_moments_pass(shift: np.ndarray) -> Callable[[Batches], Batches]:
    """As ``fold_moments_pass`` with products, over rows of (fold, x)."""
    lower = np.tril_indices(len(shift))

    def run(batches: Batches) -> Batches:
        sums: dict[int, list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            fold, v = batch.column(0).to_numpy(zero_copy_only=False), matrix(batch.column(1)) - shift
            for f in np.unique(fold).tolist():
                own = v[fold == f]
                found = [len(own), own.sum(axis=0), own.T @ own]
                sums[f] = [a + b for a, b in zip(sums[f], found)] if f in sums else found
        if sums:
            yield partial_batch(
                {f: np.concatenate([[n], first, second[lower]]) for f, (n, first, second) in sums.items()}
            )

    return run


def gram_pass(batches: Batches) -> Batches:
    """Sum of w x xT over (x[, w]): row i up to its diagonal as partial i, the width in front."""
    acc = None
    for batch in batches:
        if batch.num_rows:
            x = matrix(batch.column(0))
            left = x
            if batch.num_columns > 1:
                weight = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
                left = x * weight[:, None]
            found = left.T @ x
            if acc is not None and acc.shape != found.shape:
                raise ValueError(f"feature vectors differ in length: {len(acc)} and {len(found)}")
            acc = found if acc is None else acc + found
    if acc is not None:
        width = [float(len(acc))]
        yield partial_batch({i: np.append(width, row[: i + 1]) for i, row in enumerate(acc)})


def cross_pass(batches: Batches) -> Batches:
    """Sum of a bT over (a, b): row i as partial i."""
    acc = None
    for batch in batches:
        if batch.num_rows:
            found = matrix(batch.column(0)).T @ matrix(batch.column(1))
            acc = found if acc is None else acc + found
    if acc is not None:
        yield partial_batch(dict(enumerate(acc)))


def roc_pass(batches: Batches) -> Batches:
    """One row per partition of (score, pos, neg), sorted by score, one row per score.

    ``area`` counts the pairs of this partition in which the positive scores higher, ties half.
    """
    lowest, pos, neg, area = None, 0.0, 0.0, 0.0
    for batch in batches:
        if batch.num_rows:
            score, p, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            lowest = float(score[0]) if lowest is None else lowest
            below = neg + np.cumsum(n) - n
            area += float(np.sum(p * (below + n / 2.0)))
            pos, neg = pos + float(p.sum()), neg + float(n.sum())
    if lowest is not None:
        yield pa.RecordBatch.from_pydict(
            {"lowest": [lowest], "pos": [pos], "neg": [neg], "area": [area]}
        )


def roc_many_pass(batches: Batches) -> Batches:
    """One row per fit and partition of (fit, score, pos, neg), sorted by fit and score.

    As ``roc_pass``, with one row per fit and score.
    """
    found: dict[int, list[float]] = {}
    for batch in batches:
        fit, score, pos, neg = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        cuts = [0, *(np.flatnonzero(fit[1:] != fit[:-1]) + 1).tolist(), len(fit)]
        for start, end in zip(cuts, cuts[1:]):
            if start < end:
                p, n = pos[start:end], neg[start:end]
                own = found.setdefault(int(fit[start]), [float(score[start]), 0.0, 0.0, 0.0])
                below = own[2] + np.cumsum(n) - n
                own[3] += float(np.sum(p * (below + n / 2.0)))
                own[1], own[2] = own[1] + float(p.sum()), own[2] + float(n.sum())
    if found:
        lowest, pos, neg, area = (list(c) for c in zip(*found.values()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int32()), *(pa.array(c, pa.float64()) for c in (lowest, pos, neg, area))],
            names=["fit", "lowest", "pos", "neg", "area"],
        )


SPARSE_SCHEMA = "rows long, unusable long, y binary, w binary, ends binary, places binary, at binary, x binary"
# Numbers of one partial of a sparse pass; a model of more positions is added up in several.
CHUNK = 1 << 14


def _entries(indices: pa.ListArray, values: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each row's entries end, their positions and their values."""
    ends = np.cumsum(pc.list_value_length(indices).to_numpy(zero_copy_only=False).astype(np.int64))
    at = indices.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    return ends, at, values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)


def sparse_packer(width: int) -> Callable[[Batches], Batches]:
    """Rows of (label, weight, indices, values) to one compressed block per batch.

    A block numbers the positions that it holds, so a pass over it is as wide as these.
    """

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        label, weight, indices, values = batch.columns
        y = label.to_numpy(zero_copy_only=False).astype(np.float64)
        w = weight.to_numpy(zero_copy_only=False).astype(np.float64)
        sizes, others = (pc.list_value_length(c).fill_null(-1).to_numpy() for c in (indices, values))
        unusable = int(np.count_nonzero(~((y == 0.0) | (y == 1.0)) | ~(w >= 0) | (sizes < 0) | (sizes != others)))
        unusable += indices.flatten().null_count + values.flatten().null_count
        parts = [b""] * 6
        if not unusable:
            ends, at, x = _entries(indices, values)
            unusable = int(np.count_nonzero((at < 0) | (at >= width) | ~np.isfinite(x)))
            places, at = np.unique(at, return_inverse=True)
            parts = [v.tobytes() for v in (y, w, ends, places, at.astype(np.int32), x)]
        columns = [pa.array([len(y)], pa.int64()), pa.array([unusable], pa.int64())]
        columns += [pa.array([p], pa.binary()) for p in parts]
        return pa.RecordBatch.from_arrays(columns, names=["rows", "unusable", "y", "w", "ends", "places", "at", "x"])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                yield block(batch)

    return run


def _sparse_blocks(batches: Batches) -> Iterator[tuple[np.ndarray, ...]]:
    kinds = {"y": np.float64, "w": np.float64, "ends": np.int64, "places": np.int32, "at": np.int32, "x": np.float64}
    for batch in batches:
        for i in range(batch.num_rows):
            y, w, ends, places, at, x = (np.frombuffer(batch.column(c)[i].as_buffer(), k) for c, k in kinds.items())
            yield y, w, np.repeat(np.arange(len(y)), np.diff(ends, prepend=0)), places, at, x


def sparse_chunks(sums: np.ndarray) -> Batches:
    """Each row of ``sums`` in partials of ``CHUNK`` numbers, numbered on; without those that are all 0.

    A batch holds one, so no vector as wide as the model is a row of the engine.
    """
    each = -(-sums.shape[1] // CHUNK)
    for i, row in enumerate(sums):
        for c in range(each):
            part = row[c * CHUNK : (c + 1) * CHUNK]
            if np.any(part):
                yield partial_batch({i * each + c: part})


def sparse_moments_pass(width: int) -> Callable[[Batches], Batches]:
    """Weighted sums of the columns and of their squares, then of the weights and their squares."""

    def run(batches: Batches) -> Batches:
        acc = np.zeros(2 * width + 2)
        for _, w, row, places, at, x in _sparse_blocks(batches):
            acc[places] += np.bincount(at, w[row] * x, len(places))
            acc[width + places] += np.bincount(at, w[row] * x * x, len(places))
            acc[2 * width :] += w.sum(), (w * w).sum()
        yield from sparse_chunks(acc[None, :])

    return run


def sparse_logistic_pass(theta: np.ndarray, bias: np.ndarray) -> Callable[[Batches], Batches]:
    """Weighted gradient, the intercept's gradient and loss at each of several points."""
    width = theta.shape[1]

    def run(batches: Batches) -> Batches:
        sums = np.zeros((len(theta), width + 2))
        for y, w, row, places, at, x in _sparse_blocks(batches):
            for i, (weights, level) in enumerate(zip(theta, bias, strict=True)):
                z = np.bincount(row, x * weights[places][at], len(y)) + level
                shrunk = np.exp(-np.abs(z))
                residual = (np.where(z < 0, shrunk, 1.0) / (1.0 + shrunk) - y) * w
                loss = np.maximum(np.where(y == 1.0, -z, z), 0.0) + np.log1p(shrunk)
                sums[i, places] += np.bincount(at, residual[row] * x, len(places))
                sums[i, width:] += residual.sum(), (w * loss).sum()
        yield from sparse_chunks(sums)

    return run


def sparse_margins(theta: np.ndarray, bias: float) -> Callable[[Batches], Batches]:
    """Rows of (keys.., indices, values): the margin in place of the entries."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            indices, values = batch.columns[-2:]
            ends, at, x = _entries(indices, values)
            if len(at) and (at.min() < 0 or at.max() >= len(theta)):
                raise ValueError(f"positions must be below {len(theta)}")
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends, prepend=0))
            z = np.bincount(row, x * theta[at], batch.num_rows) + bias
            names = [*batch.schema.names[:-2], "margin"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(z)], names=names)

    return run
