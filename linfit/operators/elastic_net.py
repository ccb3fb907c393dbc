"""Elastic net on fold moments: coordinate descent without reading a row again.

The squared error of a linear fit is a quadratic form in the moments, so one pass over the rows
serves every fold, penalty and mix of penalties. Penalties run from the largest down, each starting
where the last one ended, and only coordinates that are not zero, or that break the conditions of an
optimum, are moved.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from linfit.operators.errors import DivergedError
from linfit.operators.fold_moments import FoldMoments, fold_moments
from linfit.operators.instances import pack_blocks
from linfit.operators.resample import check_folds

ROUNDS = 100_000


@dataclass
class ElasticNet:
    l1: float
    l2: float
    theta: np.ndarray
    intercept: float


def descend_coordinates(
    xx: np.ndarray, xy: np.ndarray, l1: float, l2: float, theta: np.ndarray, tol: float = 1e-12
) -> np.ndarray:
    """Minimise theta xx theta / 2 - xy theta + l1 |theta| + l2 theta^2 / 2 from ``theta``.

    Ends when no coordinate moves by more than ``tol`` of the scale and the zeros meet the
    conditions of an optimum. A column without spread stays at 0.
    """
    theta = theta.copy()
    curve = np.diagonal(xx) + l2
    usable = np.diagonal(xx) > 0
    theta[~usable] = 0.0
    slope = xy - xx @ theta
    for _ in range(ROUNDS):
        # Zeros that the slope would move, and all that are not zero.
        active = np.flatnonzero(usable & ((theta != 0) | (np.abs(slope) > l1 * (1 + 1e-12))))
        largest = 0.0
        for j in active:
            pull = slope[j] + xx[j, j] * theta[j]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / curve[j]
            if new != theta[j]:
                slope -= xx[:, j] * (new - theta[j])
                largest = max(largest, abs(new - theta[j]) * np.sqrt(curve[j]))
                theta[j] = new
        if largest <= tol * (1.0 + np.sqrt(curve.max(initial=0.0)) * np.abs(theta).max(initial=0.0)):
            return theta
    raise DivergedError(f"coordinates still move after {ROUNDS} rounds")


def _path(
    moments: FoldMoments, fold: int | None, penalties: Sequence[float], mix: float
) -> dict[float, ElasticNet]:
    n, mean, around = moments.outside(fold)
    xx, xy = around[:-1, :-1] / n, around[:-1, -1] / n
    theta, out = np.zeros(len(xy)), {}
    for penalty in sorted(penalties, reverse=True):
        theta = descend_coordinates(xx, xy, penalty * mix, penalty * (1 - mix), theta)
        out[penalty] = ElasticNet(
            penalty * mix, penalty * (1 - mix), theta, float(mean[-1] - theta @ mean[:-1])
        )
    return out


def elastic_net_path(
    df: DataFrame,
    penalties: Sequence[float],
    mix: float = 0.5,
    features: str = "features",
    label: str = "label",
) -> dict[float, ElasticNet]:
    """Fits by penalty: mean squared error / 2 plus penalty x (mix |theta| + (1 - mix) theta^2 / 2).

    The intercept is not penalised; features are taken as they are, so scale them first where the
    penalty is to treat them alike. One pass over the rows, whatever the number of penalties.
    Null or uneven vectors, null labels and an empty table raise.
    """
    _check(penalties, mix)
    with pack_blocks(df, label, features, classes=None) as blocks:
        return _path(fold_moments(blocks, 1, products=True), None, penalties, mix)


def elastic_net_search(
    df: DataFrame,
    k: int,
    penalties: Sequence[float],
    mix: float = 0.5,
    features: str = "features",
    label: str = "label",
    fold: str = "fold",
) -> tuple[list[tuple[float, int, float]], ElasticNet]:
    """(penalty, fold, rmse) of every fit, and the fit on all rows at the lowest mean error.

    Still one pass: training moments are the whole less the fold, and the error on the fold follows
    from its own moments. Ties go to the higher penalty, which keeps fewer features.
    """
    check_folds(k)
    _check(penalties, mix)
    with pack_blocks(df, label, features, fold, classes=None) as blocks:
        moments = fold_moments(blocks, k, products=True)
    scores = []
    for f in range(k):
        if not moments.rows[f]:
            raise ValueError(f"fold {f} has no rows")
        for penalty, fit in _path(moments, f, penalties, mix).items():
            scores.append((float(penalty), f, moments.error(f, fit.theta, fit.intercept)))
    means = {p: round(sum(s for q, _, s in scores if q == p) / k, 12) for p in map(float, penalties)}
    best = min(means, key=lambda p: (means[p], -p))
    return scores, _path(moments, None, penalties, mix)[best]


def _check(penalties: Sequence[float], mix: float) -> None:
    if not penalties or any(not p >= 0 for p in penalties) or not 0 <= mix <= 1:
        raise ValueError("penalties must be at least 0, and mix from 0 to 1")
