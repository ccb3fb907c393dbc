"""Multinomial logistic regression: many fits in shared passes over cached blocks.

Folds and penalties advance together, one job an iteration. A fit's scaling is that of its own
training rows; it is folded into the weights, so all fits read the same raw blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from linfit.functions.features import column
from linfit.functions.scalar import PROBABILITY_FLOOR
from linfit.functions.vectors import doubles
from linfit.operators import kernels
from linfit.operators.errors import DivergedError
from linfit.operators.fold_moments import FoldMoments, fold_moments
from linfit.operators.instances import Blocks, pack_blocks
from linfit.operators.logistic import NO_FOLD
from linfit.operators.moments import PARTIALS, part_sum, sum_partials
from linfit.operators.quasi_newton import Descent, descend
from linfit.operators.resample import check_folds

#: Numbers that one pass sends to and gathers from a task at most; more fits take several passes.
PASS_NUMBERS = 1 << 24


@dataclass
class MultinomialModel:
    """``theta`` is classes x features on the raw scale; intercepts add up to 0."""

    theta: np.ndarray
    intercepts: np.ndarray
    losses: list[float] = field(default_factory=list)


@dataclass
class Task:
    """One fit: its penalty, the fold it does not see, and the scaling of the rows it sees."""

    l2: float
    held_out: int
    mean: np.ndarray
    inverse: np.ndarray  # of the deviation; 0 for a constant feature, which so stays out

    def raw(self, point: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
        """Weights and intercepts for unscaled features."""
        theta = point[:-classes].reshape(classes, -1) * self.inverse
        return theta, point[-classes:] - theta @ self.mean

    def model(self, point: np.ndarray, classes: int, losses: Sequence[float]) -> MultinomialModel:
        theta, intercepts = self.raw(point, classes)
        return MultinomialModel(theta, intercepts - intercepts.mean(), list(losses))


def make_task(l2: float, held_out: int, scaling: tuple[np.ndarray, np.ndarray] | None, width: int) -> Task:
    mean, deviation = scaling or (np.zeros(width), np.ones(width))
    known = deviation > 0
    return Task(l2, held_out, mean, np.where(known, 1.0 / np.where(known, deviation, 1.0), 0.0))


def check_parameters(classes: int, l2s: Sequence[float], max_iter: int, tol: float) -> None:
    if classes < 2:
        raise ValueError("there must be at least two classes")
    if max_iter < 1 or not tol >= 0 or any(not v >= 0 for v in l2s):
        raise ValueError("max_iter must be at least 1; l2 and tol must not be negative")


def _passes(points: list[tuple[int, np.ndarray]]) -> list[list[tuple[int, np.ndarray]]]:
    size = max(1, PASS_NUMBERS // max(len(p) for _, p in points))
    return [points[i : i + size] for i in range(0, len(points), size)]


def _measure(blocks: Blocks, tasks: Sequence[Task], classes: int, floor: float | None = None):
    """A function from points by task to what a pass over the blocks sums up for each of them."""
    read, total = blocks.read(), part_sum()

    def run(points: dict[int, list[np.ndarray]]) -> dict[int, list[np.ndarray]]:
        out: dict[int, list[np.ndarray]] = {i: [] for i in points}
        for some in _passes([(i, p) for i, several in points.items() for p in several]):
            raw = [tasks[i].raw(p, classes) for i, p in some]
            kernel = kernels.softmax_pass(
                blocks.width,
                np.arange(len(some), dtype=np.int32),
                np.array([tasks[i].held_out for i, _ in some], np.int32),
                np.stack([t for t, _ in raw]),
                np.stack([b for _, b in raw]),
                floor,
            )
            added = sum_partials(read.mapInArrow(kernel, PARTIALS), blocks.partitions, total).collect()
            sums = {r.fit: np.array(r.part) for r in added}
            for at, (i, _) in enumerate(some):
                out[i].append(sums[at])
        return out

    return run


def _objective(task: Task, point: np.ndarray, sums: np.ndarray, classes: int) -> tuple[float, np.ndarray]:
    """Mean cross-entropy plus half the penalty on scaled weights, and its gradient."""
    rows = np.rint(sums[-1])
    if rows == 0:
        raise ValueError("a fold leaves no rows to train on")
    slopes = sums[: -2 - classes].reshape(classes, -1)
    level = sums[-2 - classes : -2]
    scaled = (slopes - level[:, None] * task.mean) * task.inverse
    weights = point[:-classes]
    loss = sums[-2] / rows + 0.5 * task.l2 * float(weights @ weights)
    return float(loss), np.concatenate([scaled.ravel() / rows + task.l2 * weights, level / rows])


def fit_tasks(
    blocks: Blocks, tasks: Sequence[Task], classes: int, max_iter: int, tol: float
) -> list[Descent]:
    """Quasi-Newton fits from zero, all in the same passes."""
    measure = _measure(blocks, tasks, classes)

    def evaluate(points: dict[int, list[np.ndarray]]):
        sums = measure(points)
        return {
            i: [_objective(tasks[i], p, s, classes) for p, s in zip(several, sums[i], strict=True)]
            for i, several in points.items()
        }

    start = np.zeros(classes * (blocks.width + 1))
    return descend([start] * len(tasks), evaluate, max_iter, tol)


def gradient_tasks(
    blocks: Blocks, tasks: Sequence[Task], classes: int, max_iter: int, rate: float
) -> list[Descent]:
    """Plain gradient descent on the mean cross-entropy: ``max_iter`` steps of one rate."""
    measure = _measure(blocks, tasks, classes)
    fits = [Descent(np.zeros(classes * (blocks.width + 1))) for _ in tasks]
    for _ in range(max_iter):
        sums = measure({i: [f.point] for i, f in enumerate(fits)})
        for i, fit in enumerate(fits):
            loss, gradient = _objective(tasks[i], fit.point, sums[i][0], classes)
            if not np.isfinite(loss):
                raise DivergedError(f"loss is {loss} in iteration {len(fit.losses)}; lower the rate")
            fit.losses.append(loss)
            fit.point = fit.point - rate * gradient
    return fits


def multinomial_fit(
    df: DataFrame,
    classes: int,
    features: str = "features",
    label: str = "label",
    l2: float = 0.0,
    max_iter: int = 100,
    tol: float = 1e-6,
    standardize: bool = True,
    method: str = "quasi-newton",
    learning_rate: float = 1.0,
) -> MultinomialModel:
    """Fit P(class) as the softmax of ``classes`` linear functions; labels are 0 to classes - 1.

    Minimises the mean cross-entropy plus ``l2`` / 2 times the squared weights, intercepts left
    out. With ``standardize`` features are centred and scaled by their sample deviation first, and
    the penalty is on the scaled weights; the model is on the raw scale either way. ``losses``
    has the objective at the start and after each step. ``method`` is ``quasi-newton``, or
    ``gradient`` for plain steps of ``learning_rate``. Null labels, vectors or elements, vectors
    of different length and labels outside the classes raise; so does an empty table.
    """
    check_parameters(classes, [l2], max_iter, tol)
    if method not in ("quasi-newton", "gradient"):
        raise ValueError(f"unknown method {method!r}: use 'quasi-newton' or 'gradient'")
    with pack_blocks(df, label, features, classes=classes) as blocks:
        scaling = fold_moments(blocks, 1).scaling(None) if standardize else None
        task = make_task(l2, NO_FOLD, scaling, blocks.width)
        if method == "gradient":
            fit = gradient_tasks(blocks, [task], classes, max_iter, learning_rate)[0]
        else:
            fit = fit_tasks(blocks, [task], classes, max_iter, tol)[0]
    return task.model(fit.point, classes, fit.losses)


def multinomial_predict(
    df: DataFrame, model: MultinomialModel, features: str = "features", keys: Sequence[str] = ()
) -> DataFrame:
    """``(keys.., probability array<double>)``, a probability for each class in order.

    A null vector or element and a vector of another length raise.
    """
    rows = df.select(*[column(k) for k in keys], doubles(column(features)).alias("features"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    kernel = kernels.softmax_scores(model.theta, model.intercepts)
    return rows.mapInArrow(kernel, ", ".join([*kinds, "probability array<double>"]))


@dataclass
class MultinomialSearch:
    """(l2, fold, log loss) of every fit, the penalty with the lowest mean, and its refit."""

    fold_scores: list[tuple[float, int, float]]
    means: dict[float, float]
    best: float
    model: MultinomialModel


def cross_validate_multinomial(
    df: DataFrame,
    k: int,
    l2s: Sequence[float],
    classes: int,
    features: str = "features",
    label: str = "label",
    fold: str = "fold",
    max_iter: int = 100,
    tol: float = 1e-6,
    standardize: bool = True,
) -> MultinomialSearch:
    """Pick the penalty by mean cross-entropy over k folds, then refit it on all rows.

    All folds and penalties advance in the same passes. Scalers come from one pass of moments by
    fold, each of its own training rows. Probabilities below 1e-15 count as that. Ties go to the
    lower penalty.
    """
    check_folds(k)
    l2s = list(dict.fromkeys(map(float, l2s)))
    check_parameters(classes, l2s, max_iter, tol)
    if not l2s:
        raise ValueError("the grid is empty")
    with pack_blocks(df, label, features, fold, classes) as blocks:
        moments: FoldMoments = fold_moments(blocks, k)
        if not moments.rows.all():
            raise ValueError(f"folds without rows: {np.flatnonzero(moments.rows == 0).tolist()}")

        def scaling(f: int | None):
            return moments.scaling(f) if standardize else None

        plan = [(v, f) for v in l2s for f in range(k)]
        tasks = [make_task(v, f, scaling(f), blocks.width) for v, f in plan]
        fits = fit_tasks(blocks, tasks, classes, max_iter, tol)
        score = _measure(blocks, tasks, classes, PROBABILITY_FLOOR)
        sums = score({i: [f.point] for i, f in enumerate(fits)})
        scores = [(v, f, float(sums[i][0][0] / sums[i][0][1])) for i, (v, f) in enumerate(plan)]
        means = {v: round(sum(s for u, _, s in scores if u == v) / k, 12) for v in l2s}
        best = min(means, key=lambda v: (means[v], v))
        task = make_task(best, NO_FOLD, scaling(None), blocks.width)
        refit = fit_tasks(blocks, [task], classes, max_iter, tol)[0]
    return MultinomialSearch(scores, means, best, task.model(refit.point, classes, refit.losses))
