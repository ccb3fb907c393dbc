"""Moments by fold, from which every training split follows by subtraction.

One keyed pass over cached blocks sums each fold by itself. What the rows outside a fold add up to
is the whole less that fold, so k training scalers, or k Gram matrices for any number of penalties,
need no further read. Sums are taken around a point near the data, so that subtraction loses no
digits where means are large beside deviations.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from linfit.functions.features import column
from linfit.functions.vectors import sized
from linfit.operators import kernels
from linfit.operators.instances import UNFOLDED, Blocks, pack_blocks
from linfit.operators.linear import solve_positive_definite
from linfit.operators.moments import PARTIALS, likely_partitions, sum_partials
from linfit.operators.resample import check_folds


@dataclass
class FoldMoments:
    """Row count, sums and second moments by fold, around ``shift``; the label is the last entry.

    ``second`` holds squares (folds x entries), or products (folds x entries x entries).
    """

    shift: np.ndarray
    rows: np.ndarray
    first: np.ndarray
    second: np.ndarray

    def outside(self, fold: int | None) -> tuple[float, np.ndarray, np.ndarray]:
        """Count, mean and second moments around the mean of all rows outside ``fold``."""
        return self._around_mean(*(x.sum(axis=0) - (0.0 if fold is None else x[fold]) for x in (self.rows, self.first, self.second)))

    def _around_mean(self, n, first, second) -> tuple[float, np.ndarray, np.ndarray]:
        if n < 1:
            raise ValueError("a fold leaves no rows to train on")
        mean = first / n
        square = np.outer(first, mean) if second.ndim == 2 else first * mean
        return float(n), self.shift + mean, second - square

    def products_around(self, fold: int, mean: np.ndarray) -> np.ndarray:
        """Products of the entries of ``fold`` around any point, of moments that hold products."""
        n, sums, off = self.rows[fold], self.first[fold], self.shift - mean
        return self.second[fold] + np.outer(sums, off) + np.outer(off, sums) + n * np.outer(off, off)

    def error(self, fold: int, theta: np.ndarray, intercept: float) -> float:
        """Root mean squared error of a linear fit on the rows of ``fold``."""
        n, w = self.rows[fold], np.append(-theta, 1.0)
        # The residual is w (v - shift) + level.
        level = float(w @ self.shift) - intercept
        total = w @ self.second[fold] @ w + 2 * level * (w @ self.first[fold]) + n * level * level
        return float(np.sqrt(max(total, 0.0) / n))

    def scaling(self, fold: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Feature means and sample deviations outside ``fold``."""
        n, mean, second = self.outside(fold)
        second = np.diagonal(second) if second.ndim == 2 else second
        return mean[:-1], np.sqrt(np.maximum(second[:-1], 0.0) / max(n - 1.0, 1.0))


def fold_moments(blocks: Blocks, k: int, products: bool = False) -> FoldMoments:
    """One pass over the blocks; rows without a fold from 0 to k-1 raise.

    Blocks that carry no folds are one fold.
    """
    first = blocks.df.select("y", "x").first()
    x = np.frombuffer(first.x, np.float64).reshape(blocks.width, -1)
    shift = np.append(x.mean(axis=1), np.frombuffer(first.y, np.float64).mean())
    kernel = kernels.fold_moments_pass(blocks.width, shift, products)
    added = sum_partials(blocks.read().mapInArrow(kernel, PARTIALS), blocks.partitions).collect()
    sums = {0 if k == 1 and r.fit == UNFOLDED else r.fit: np.array(r.part) for r in added}
    return _table(sums, k, shift, products)


def _table(sums: dict[int, np.ndarray], k: int, shift: np.ndarray, products: bool) -> FoldMoments:
    if not set(sums) <= set(range(k)):
        raise ValueError(f"folds must be 0 to {k - 1}, not {sorted(sums)}")
    d = len(shift)
    size = 1 + d + (d * (d + 1) // 2 if products else d)
    table = np.stack([sums.get(f, np.zeros(size)) for f in range(k)])
    second = table[:, 1 + d :]
    if products:
        square = np.zeros((k, d, d))
        square[:, *np.tril_indices(d)] = second
        second = square + np.transpose(np.tril(square, -1), (0, 2, 1))
    return FoldMoments(shift, np.rint(table[:, 0]), table[:, 1 : 1 + d], second)


def split_moments(df: DataFrame, values: str, fold: str, width: int) -> FoldMoments:
    """Products of an array column by fold (0 train, 1 test), from one pass that caches nothing.

    A null array or element, an array of another length and a table without training rows raise.
    """
    rows = df.select(column(fold).cast("int").alias("fold"), sized(column(values), width, column(values)).alias("x"))
    first = rows.where("fold = 0").select("x").first()
    if first is None:
        raise ValueError("no instances to fit on")
    if first.x is None or None in first.x:
        raise ValueError("null feature vector or element")
    shift = np.array(first.x)
    kernel = kernels.split_moments_pass(shift)
    added = sum_partials(rows.mapInArrow(kernel, PARTIALS), likely_partitions(df)).collect()
    return _table({r.fit: np.array(r.part) for r in added}, 2, shift, True)


@dataclass
class RidgeSearch:
    """(lambda, fold, rmse) of every fit, and the winner fitted on all rows."""

    fold_scores: list[tuple[float, int, float]]
    best: float
    theta: np.ndarray
    intercept: float


def ridge_search(
    df: DataFrame,
    k: int,
    lambdas: Sequence[float],
    features: str = "features",
    label: str = "label",
    fold: str = "fold",
) -> RidgeSearch:
    """Ridge regression over k folds and all penalties from one pass over the rows.

    Each fit is centred on the means of its training rows and solves (XtX + l2 I) theta = Xty; its
    error on the held-out fold is a quadratic form in that fold's moments, so no row is scored.
    The lowest mean error wins, ties go to the lower penalty.
    """
    check_folds(k)
    if not lambdas or any(not v >= 0 for v in lambdas):
        raise ValueError("penalties must be at least 0, and there must be one")
    with pack_blocks(df, label, features, fold, classes=None) as blocks:
        moments = fold_moments(blocks, k, products=True)
    scores = []
    for f in range(k):
        rows, mean, around = moments.outside(f)
        n = moments.rows[f]
        if not n:
            raise ValueError(f"fold {f} has no rows")
        held = moments.products_around(f, mean)
        for l2 in lambdas:
            theta = _solve(around, l2)
            w = np.append(-theta, 1.0)
            scores.append((float(l2), f, float(np.sqrt(max(w @ held @ w, 0.0) / n))))
    means = {l2: round(sum(s for v, _, s in scores if v == l2) / k, 12) for l2 in map(float, lambdas)}
    best = min(means, key=lambda v: (means[v], v))
    _, mean, around = moments.outside(None)
    theta = _solve(around, best)
    return RidgeSearch(scores, best, theta, float(mean[-1] - theta @ mean[:-1]))


def _solve(around: np.ndarray, l2: float) -> np.ndarray:
    xx, xy = around[:-1, :-1], around[:-1, -1]
    return solve_positive_definite(xx + l2 * np.eye(len(xx)), xy)
