"""Ridge regression by normal equations, and its library counterpart."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfit.functions.features import column
from linfit.functions.vectors import dot_constant, doubles, known, sized
from linfit.operators.errors import NotPositiveDefiniteError
from linfit.operators.moments import collect_symmetric, normal_terms


@dataclass
class LinearModel:
    theta: list[float]


def solve_positive_definite(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cholesky solve of a model-sized system."""
    try:
        lower = np.linalg.cholesky(a)
    except np.linalg.LinAlgError as error:
        raise NotPositiveDefiniteError(
            "matrix is not positive definite: look for a constant, duplicated or all-zero feature"
        ) from error
    return np.linalg.solve(lower.T, np.linalg.solve(lower, b))


def ridge_fit(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    l2: float = 0.0,
    width: int | None = None,
) -> LinearModel:
    """Solve (XtX + l2 I) theta = Xty; no intercept, so centre the data first.

    The label rides along as the last feature, so XtX and Xty come out of one pass.
    """
    if l2 < 0:
        raise ValueError("l2 must not be negative")
    moments = collect_symmetric(normal_terms(df, features, label, width))
    xx, xy = moments[:-1, :-1], moments[:-1, -1]
    theta = solve_positive_definite(xx + l2 * np.eye(len(xx)), xy)
    return LinearModel([float(t) for t in theta])


def linear_predict(
    df: DataFrame,
    model: LinearModel,
    features: str = "features",
    label: str = "label",
    keys: Sequence[str] = (),
) -> DataFrame:
    """``(keys.., label, prediction)``; null vectors or elements and other lengths raise."""
    x = doubles(column(features))
    return df.select(
        *[column(k) for k in keys],
        column(label).cast("double").alias("label"),
        sized(x, len(model.theta), known(dot_constant(x, model.theta), "feature")).alias("prediction"),
    )


def ridge_native(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    reg_param: float = 0.0,
    standardization: bool = True,
) -> LinearModel:
    """The library's normal-equation solver without an intercept."""
    vectors = df.select(
        column(label).cast("double").alias("label"),
        array_to_vector(doubles(column(features))).alias("features"),
    )
    fitted = LinearRegression(
        solver="normal",
        regParam=reg_param,
        fitIntercept=False,
        standardization=standardization,
    ).fit(vectors)
    return LinearModel([float(c) for c in fitted.coefficients])


def ridge_reg_param(df: DataFrame, l2: float, label: str = "label") -> float:
    """The library ``regParam`` with the optimum of ``ridge_fit(l2)``.

    The library divides its objective by n and scales it by the label's population deviation.
    It holds with ``standardization=False``.
    """
    y = column(label).cast("double")
    facts = df.agg(F.stddev_pop(y).alias("s"), F.count(y).alias("n")).first()
    return l2 * facts.s / facts.n
