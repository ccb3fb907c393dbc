"""Binary logistic regression: gradient descent, Newton, prediction, library fits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfit.functions.features import column, monomials
from linfit.functions.scalar import binary_log_loss, sigmoid
from linfit.functions.vectors import (
    MAX_GENERATED_TERMS,
    dot_constant,
    doubles,
    known,
    sized,
)
from linfit.operators import kernels
from linfit.operators.errors import DivergedError
from linfit.operators.instances import Blocks, pack_blocks
from linfit.operators.linear import solve_positive_definite
from linfit.operators.metrics import ranked_areas
from linfit.operators.moments import PARTIALS, gram, part_sum, sum_partials

NO_FOLD = -2  # a held-out fold no row belongs to
FIRST_DELTA = 100.0  # loss change assumed before the second loss is known
HESSIAN_BYTES = 1 << 28  # packed Hessians that one pass may gather


@dataclass
class LogisticModel:
    theta: list[float]
    intercept: float
    losses: list[float] = field(default_factory=list)


@dataclass
class Fit:
    """One fit among the many that share the passes over the data."""

    terms: list[tuple[int, ...]]
    l2: float = 0.0
    held_out: int = NO_FOLD
    theta: np.ndarray = None
    intercept: float = 0.0
    losses: list[float] = field(default_factory=list)
    rate: float = 1.0
    delta: float = FIRST_DELTA

    def model(self, order: Sequence[tuple[int, ...]]) -> LogisticModel:
        """Coefficients in the order of ``order``, not in the internal one."""
        at = {t: i for i, t in enumerate(self.terms)}
        return LogisticModel(
            [float(self.theta[at[t]]) for t in order], float(self.intercept), list(self.losses)
        )


def graded_terms(width: int, degree: int) -> list[tuple[int, ...]]:
    """Polynomial terms by total degree, so that a lower degree is a prefix of a higher one."""
    return sorted(monomials(width, degree), key=len)


def product_plan(terms: Sequence[tuple[int, ...]]) -> list[tuple[int, int]]:
    """Each term beyond the inputs as (an earlier term, one input)."""
    at = {t: i for i, t in enumerate(terms)}
    return [(at[t[:-1]], t[-1]) for t in terms if len(t) > 1]


def _groups(fits: dict[int, Fit]) -> list[tuple]:
    sizes = sorted({len(f.terms) for f in fits.values()})
    out = []
    for m in sizes:
        chosen = {i: f for i, f in fits.items() if len(f.terms) == m}
        out.append(
            (
                m,
                np.array(list(chosen), np.int32),
                np.array([f.held_out for f in chosen.values()], np.int32),
                np.stack([f.theta for f in chosen.values()]),
                np.array([f.intercept for f in chosen.values()]),
            )
        )
    return out


def _longest(fits: Sequence[Fit]) -> list[tuple[int, ...]]:
    return max((f.terms for f in fits), key=len)


def check_fit_parameters(
    method: str, max_iter: int, l2s: Sequence[float], tol: float, fit_intercept: bool
) -> None:
    if method not in ("gradient", "newton"):
        raise ValueError(f"unknown method {method!r}: use 'gradient' or 'newton'")
    if max_iter < 1 or tol < 0 or any(l2 < 0 for l2 in l2s):
        raise ValueError("max_iter must be at least 1; l2 and tol must not be negative")
    if method == "gradient" and not fit_intercept:
        raise ValueError("gradient descent always fits an intercept")


def fit_many(
    blocks: Blocks,
    fits: Sequence[Fit],
    method: str = "gradient",
    max_iter: int = 100,
    learning_rate: float = 1.0,
    tol: float = 1e-6,
    fit_intercept: bool = True,
) -> None:
    """Run all fits at once, one Spark job per iteration, and leave the results in ``fits``.

    Every pass reads the cached blocks once and updates each fit that has not stopped; a fit
    sees only its own rows, rate and stop test, so it ends where it would have ended alone.
    """
    check_fit_parameters(method, max_iter, [f.l2 for f in fits], tol, fit_intercept)
    for fit in fits:
        fit.theta, fit.intercept = np.zeros(len(fit.terms)), 0.0
        fit.losses, fit.rate, fit.delta = [], float(learning_rate), FIRST_DELTA
    _run_passes(blocks, blocks.read(), fits, method == "newton", max_iter, tol, fit_intercept)


def _run_passes(
    blocks: Blocks,
    read: DataFrame,
    fits: Sequence[Fit],
    newton: bool,
    max_iter: int,
    tol: float,
    fit_intercept: bool,
) -> None:
    total = part_sum()
    while True:
        active = {
            i: f for i, f in enumerate(fits) if len(f.losses) < max_iter and f.delta > tol
        }
        if not active:
            return
        for batch in _batches(active, newton):
            kernel = kernels.logistic_pass(
                blocks.width,
                product_plan(_longest(list(batch.values()))),
                _groups(batch),
                newton,
                fit_intercept,
            )
            partials = read.mapInArrow(kernel, PARTIALS)
            added = sum_partials(partials, blocks.partitions, total).collect()
            sums = {r.fit: np.array(r.part) for r in added}
            for i, fit in batch.items():
                _step(fit, sums[i], newton, fit_intercept)


def _batches(fits: dict[int, Fit], newton: bool) -> list[dict[int, Fit]]:
    """Fits that share a pass: all of them, or as many as have Hessians of bounded size.

    Hessians pass through every task and the driver; one too large to be solved there raises.
    """
    if not newton:
        return [fits]
    out: list[dict[int, Fit]] = []
    room = 0
    for i, fit in fits.items():
        size = 4 * (len(fit.terms) + 1) * (len(fit.terms) + 2)
        if size > HESSIAN_BYTES:
            raise ValueError(
                f"a Hessian of {len(fit.terms)} terms takes {size} bytes, more than"
                f" {HESSIAN_BYTES}: use gradient descent"
            )
        if size > room:
            out.append({})
            room = HESSIAN_BYTES
        out[-1][i] = fit
        room -= size
    return out


def _step(fit: Fit, sums: np.ndarray, newton: bool, fit_intercept: bool) -> None:
    m = len(fit.terms)
    slope, intercept_slope, loss, rows = sums[:m], sums[m], sums[m + 1], np.rint(sums[m + 2])
    if rows == 0:
        raise ValueError("a fold leaves no rows to train on")
    done = len(fit.losses)
    if not newton and done >= 2 and fit.losses[-1] > fit.losses[-2]:
        fit.rate /= 2.0
    fit.losses.append(float(loss / rows))
    if not np.isfinite(fit.losses[-1]):
        raise DivergedError(f"loss is {fit.losses[-1]} in iteration {done}; lower the rate")
    penalised = slope + fit.l2 * fit.theta
    if newton:
        size = m + int(fit_intercept)
        hessian = np.zeros((size, size))
        hessian[np.tril_indices(size)] = sums[m + 3 :]
        hessian = hessian + np.tril(hessian, -1).T
        hessian[np.arange(m), np.arange(m)] += fit.l2
        gradient = np.append(penalised, intercept_slope) if fit_intercept else penalised
        change = -solve_positive_definite(hessian, gradient)
    else:
        change = -fit.rate * np.append(penalised, intercept_slope)
    fit.theta = fit.theta + change[:m]
    if fit_intercept:
        fit.intercept = fit.intercept + change[m]
    if done >= 1:
        fit.delta = abs(fit.losses[-1] - fit.losses[-2])


def logistic_fit(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    method: str = "gradient",
    max_iter: int = 100,
    learning_rate: float = 1.0,
    l2: float = 0.0,
    tol: float = 1e-6,
    fit_intercept: bool = True,
) -> LogisticModel:
    """Fit by full-batch gradient descent or by Newton's method, from zero.

    ``losses[i]`` is the mean cross-entropy before update i, without the penalty. The gradient
    is a sum over rows, so a rate that works scales with 1/n; it halves for good after a step
    that raised the loss. Newton takes full steps and ignores the rate; with ``l2`` its Hessian
    and gradient carry the penalty. The intercept is never penalised.
    """
    check_fit_parameters(method, max_iter, [l2], tol, fit_intercept)
    with pack_blocks(df, label, features, merge=True) as blocks:
        fit = Fit(graded_terms(blocks.width, 1), l2)
        fit_many(blocks, [fit], method, max_iter, learning_rate, tol, fit_intercept)
        return fit.model(fit.terms)


def confusion_many(blocks: Blocks, fits: Sequence[Fit], threshold: float = 0.5) -> np.ndarray:
    """TP, TN, FP, FN of every fit on its held-out fold, in one pass."""
    check_threshold(threshold)
    chosen = dict(enumerate(fits))
    kernel = kernels.confusion_pass(
        blocks.width, product_plan(_longest(fits)), _groups(chosen), threshold
    )
    partials = blocks.read().mapInArrow(kernel, PARTIALS)
    added = sum_partials(partials, blocks.partitions).collect()
    counts = {r.fit: r.part for r in added}
    return np.rint([counts[i] for i in chosen]).astype(np.int64)


def area_many(blocks: Blocks, fits: Sequence[Fit]) -> list[float | None]:
    """ROC area of every fit on its held-out fold, all in one job; None where a class is missing."""
    chosen = dict(enumerate(fits))
    kernel = kernels.held_out_scores(blocks.width, product_plan(_longest(fits)), _groups(chosen))
    counted = blocks.read().mapInArrow(kernel, "fit int, score double, pos double, neg double")
    found = ranked_areas(counted)
    return [found.get(i, (None, 0.0))[0] for i in chosen]


def check_threshold(threshold: float) -> None:
    if not 0.0 < threshold < 1.0:
        raise ValueError("threshold must lie strictly between 0 and 1")


def logistic_predict(
    df: DataFrame,
    model: LogisticModel,
    threshold: float = 0.5,
    features: str = "features",
    label: str = "label",
    keys: Sequence[str] = (),
) -> DataFrame:
    """``(keys.., label, prediction_prob, prediction)``; the threshold itself counts as 1.0.

    A null vector or element and a vector of another length raise.
    """
    check_threshold(threshold)
    z = margin(doubles(column(features)), model.theta, model.intercept)
    scored = df.select(
        *[column(k) for k in keys],
        column(label).cast("double").alias("label"),
        z.alias("margin"),
    ).withColumn("prediction_prob", sigmoid(F.col("margin")))
    return scored.drop("margin").withColumn(
        "prediction", F.when(F.col("prediction_prob") >= threshold, 1.0).otherwise(0.0)
    )


def margin(x: Column, theta: Sequence[float], intercept: float) -> Column:
    """theta x + intercept; null vectors or elements and other lengths raise."""
    z = known(dot_constant(x, theta), "feature vector or element")
    return sized(x, len(theta), z) + F.lit(float(intercept))


def _margins(
    df: DataFrame, theta: Sequence[float], intercept: float, features: str, label: str
) -> DataFrame:
    x = doubles(column(features))
    rows = df.select(
        known(column(label).cast("double"), "label").alias("label"),
        margin(x, theta, intercept).alias("z"),
        x.alias("x"),
    )
    return rows.withColumn("r", sigmoid(F.col("z")) - F.col("label"))


def _gradient(rows: DataFrame, d: int, *others: tuple[str, Column]) -> DataFrame:
    """``g0.., g_intercept`` and other aggregates, in one pass.

    A narrow gradient is one compiled sum per feature, a wide one a single vector sum.
    """
    rest = [F.sum("r").alias("g_intercept"), *[value.alias(name) for name, value in others]]
    if d <= MAX_GENERATED_TERMS:
        slopes = [F.sum(F.col("r") * F.get("x", F.lit(i))).alias(f"g{i}") for i in range(d)]
        return rows.agg(*slopes, *rest)
    products = array_to_vector(F.transform("x", lambda v: v * F.col("r")))
    whole = rows.agg(vector_to_array(Summarizer.sum(products)).alias("g"), *rest)
    return whole.select(
        *[F.get("g", F.lit(i)).alias(f"g{i}") for i in range(d)],
        "g_intercept",
        *[name for name, _ in others],
    )


def logloss_gradient(
    df: DataFrame,
    theta: Sequence[float],
    intercept: float = 0.0,
    features: str = "features",
    label: str = "label",
) -> DataFrame:
    """One row ``g0.., g_intercept``: the gradient of the total cross-entropy."""
    return _gradient(_margins(df, theta, intercept, features, label), len(theta))


def binary_cross_entropy(
    df: DataFrame,
    theta: Sequence[float],
    intercept: float = 0.0,
    features: str = "features",
    label: str = "label",
) -> DataFrame:
    """One row ``cross_entropy``: the mean over all rows."""
    loss = binary_log_loss(F.col("z"), F.col("label"))
    return _margins(df, theta, intercept, features, label).agg(F.avg(loss).alias("cross_entropy"))


def fused_gradient_loss(
    df: DataFrame,
    theta: Sequence[float],
    intercept: float = 0.0,
    features: str = "features",
    label: str = "label",
) -> DataFrame:
    """Gradient, total cross-entropy ``loss`` and row count ``n`` in one aggregate."""
    loss = binary_log_loss(F.col("z"), F.col("label"))
    rows = _margins(df, theta, intercept, features, label)
    return _gradient(rows, len(theta), ("loss", F.sum(loss)), ("n", F.count(F.lit(1))))


def logistic_hessian(
    df: DataFrame,
    theta: Sequence[float],
    features: str = "features",
) -> DataFrame:
    """Moment table of sum s(1-s) x xT; a bias, if any, is the last feature."""
    sigma = sigmoid(margin(doubles(column(features)), theta, 0.0))
    return gram(df, features, width=len(theta), weight=sigma * (1.0 - sigma))


def logistic_native(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    weight: str | None = None,
    family: str = "auto",
    **params,
) -> LogisticRegressionModel:
    """The library's fit on an array column; ``params`` go to ``LogisticRegression``."""
    columns = [
        column(label).cast("double").alias("label"),
        array_to_vector(doubles(column(features))).alias("features"),
    ]
    if weight:
        columns.append(column(weight).cast("double").alias("weight"))
        params["weightCol"] = "weight"
    return LogisticRegression(family=family, **params).fit(df.select(*columns))
