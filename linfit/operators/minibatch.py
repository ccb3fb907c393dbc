"""Logistic regression by mini-batches: a step reads one share of the cached blocks.

A row's batch is a hash of its key, and blocks hold rows of one batch only, so a step over batch b
reads the same rows after a lost executor and however the table is partitioned. The order of the
batches is a function of the epoch. Plain steps along one batch's gradient stay at a distance from
the optimum; corrected steps remember every batch's last gradient on the driver (batches x features
numbers) and replace one of them at a time, which converges to the optimum of the full fit.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import md5

import numpy as np
from pyspark.sql import DataFrame

from linfit.operators import kernels
from linfit.operators.errors import DivergedError
from linfit.operators.fold_moments import FoldMoments, fold_moments
from linfit.operators.instances import pack_blocks
from linfit.operators.logistic import NO_FOLD, LogisticModel
from linfit.operators.moments import PARTIALS, part_sum, sum_partials
from linfit.operators.resample import key_bucket

#: Gradients that the driver holds, and products by batch that scale the steps, stay within this
#: many numbers each.
MEMORY = 1 << 24
#: Directions with less than this part of the largest variance are scaled as if they had it.
FLAT = 1e-10


def batch_order(epoch: int, batches: int) -> list[int]:
    """The batches in the order of an epoch: by the hash of ``epoch|batch``."""
    return sorted(range(batches), key=lambda b: md5(f"{epoch}|{b}".encode()).digest())


def minibatch_logistic_fit(
    df: DataFrame,
    keys: Sequence[str],
    batches: int = 10,
    features: str = "features",
    label: str = "label",
    epochs: int = 100,
    learning_rate: float | None = None,
    decay: float = 0.0,
    l2: float = 0.0,
    tol: float = 1e-6,
    corrected: bool = True,
    standardize: bool = True,
    hash_fn: str = "xxhash64",
) -> LogisticModel:
    """Minimise the cross-entropy plus ``l2`` / 2 times the squared coefficients, as ``logistic_fit``.

    Each step divides a batch's gradient by its share of the rows, so a rate does not depend on
    their number. With ``standardize`` steps are taken in coordinates without means and
    correlations, or, where products of all features by batch exceed ``MEMORY``, without means and
    of deviation 1; the optimum is the same. Without a rate, corrected steps take a third of the inverse of the curvature's
    bound and plain ones half the inverse; step t takes ``rate / (1 + decay * t)``. A fit stops after
    ``epochs`` passes over all batches, or after one in which the corrected gradient's norm fell to
    ``tol`` of its first. ``losses`` holds one entry an epoch: the mean loss of the batches,
    each measured when it was read. Nulls, labels other than 0 and 1, vectors of different lengths
    and an empty table raise. The key should identify a row; a key of very many rows makes one
    large batch and shorter steps, not a wrong result.
    """
    if batches < 1 or epochs < 1 or l2 < 0 or decay < 0 or not tol >= 0:
        raise ValueError("batches and epochs must be at least 1; l2, decay and tol not negative")
    if learning_rate is not None and not learning_rate > 0:
        raise ValueError("learning_rate must be positive")
    part = (key_bucket(keys, hash_fn) % batches).cast("int")
    name = "_".join(["batch", *df.columns])  # longer than any column's name
    with pack_blocks(df.withColumn(name, part), label, features, name, apart=True) as blocks:
        d = blocks.width
        if batches * (d + 1) > MEMORY:
            raise ValueError(f"{batches} gradients of {d} features exceed {MEMORY} numbers")
        moments = fold_moments(blocks, batches, products=batches * (d + 1) ** 2 <= MEMORY)
        rows, total = moments.rows, float(blocks.rows)
        mean, scale = _coordinates(moments, d) if standardize else (np.zeros(d), np.eye(d))
        rate = learning_rate
        if rate is None:
            rate = 1.0 / ((3.0 if corrected else 2.0) * _curvature(moments, mean, scale, batches, l2))
        found = [b for b in range(batches) if rows[b] > 0]
        memory, average = np.zeros((batches, d + 1)), np.zeros(d + 1)
        point, losses, first, step, summed = np.zeros(d + 1), [], None, 0, part_sum()
        for epoch in range(epochs):
            loss = 0.0
            for b in batch_order(epoch, batches):
                if b not in found:
                    continue
                theta = _apply(scale, point[:-1])
                group = (
                    d, np.array([0], np.int32), np.array([NO_FOLD], np.int32), theta[None, :],
                    np.array([point[-1] - theta @ mean]),
                )
                kernel = kernels.logistic_pass(d, [], [group], False, True)
                partials = blocks.read(b).mapInArrow(kernel, PARTIALS)
                sums = np.array(sum_partials(partials, blocks.partitions, summed).first().part)
                loss += sums[d + 1]
                slope = np.append(_apply(scale.T, sums[:d] - mean * sums[d]), sums[d])
                # In units of all rows for the memory, of the batch's own for a plain step.
                slope *= batches / total if corrected else 1.0 / rows[b]
                penalty = np.append(l2 / total * _apply(scale.T, theta), 0.0)
                change = slope - memory[b] + average if corrected else slope
                point = point - rate / (1.0 + decay * step) * (change + penalty)
                if corrected:
                    average = average + (slope - memory[b]) / batches
                    memory[b] = slope
                step += 1
            losses.append(float(loss / total))
            if not np.isfinite(losses[-1]) or not np.isfinite(point).all():
                raise DivergedError(f"loss is {losses[-1]} in epoch {epoch}; lower the rate")
            if corrected:
                penalty = np.append(l2 / total * _apply(scale.T, _apply(scale, point[:-1])), 0.0)
                norm = float(np.linalg.norm(average + penalty))
                first = norm if first is None else first
                if norm <= tol * first:
                    break
    theta = _apply(scale, point[:-1])
    return LogisticModel(theta.tolist(), float(point[-1] - theta @ mean), losses)


def _apply(scale: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The product with a matrix, or with a diagonal kept as a vector."""
    return scale @ x if scale.ndim == 2 else scale * x


def _coordinates(moments: FoldMoments, d: int) -> tuple[np.ndarray, np.ndarray]:
    """The features' means, and what takes steps of unit variance back to coefficients."""
    n, mean, second = moments.outside(None)
    if second.ndim == 1:
        deviation = np.sqrt(np.maximum(second[:d], 0.0) / n)
        return mean[:d], 1.0 / np.where(deviation > 0, deviation, 1.0)
    spread, axes = np.linalg.eigh(second[:d, :d] / n)
    least = FLAT * spread[-1]
    return mean[:d], axes / np.sqrt(np.maximum(spread, least) if least > 0 else np.ones(d))


def _curvature(moments: FoldMoments, mean: np.ndarray, scale: np.ndarray, batches: int, l2: float) -> float:
    """A bound on the curvature of every batch's share of the loss: a quarter of its moments'."""
    d, total = len(mean), moments.rows.sum()
    off = moments.shift[:d] - mean  # sums are around the shift
    most = 0.0
    for n, first, second in zip(moments.rows, moments.first[:, :d], moments.second):
        if second.ndim == 1:
            squares = second[:d] + 2 * off * first + n * off * off
            weight = scale if scale.ndim == 1 else np.diagonal(scale)
            most = max(most, float((squares * weight * weight).sum() + n))
        else:
            moved = second[:d, :d] + np.outer(off, first) + np.outer(first, off) + n * np.outer(off, off)
            level = scale.T @ (first + n * off)
            whole = np.block([[scale.T @ moved @ scale, level[:, None]], [level[None, :], np.full((1, 1), n)]])
            most = max(most, float(np.linalg.eigvalsh(whole)[-1]))
    stretch = float((scale**2).max()) if scale.ndim == 1 else float(np.linalg.norm(scale, 2) ** 2)
    return most * batches / total / 4.0 + l2 / total * stretch
