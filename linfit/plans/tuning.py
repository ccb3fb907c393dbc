"""Parameter grids and k-fold cross-validation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfit.functions.features import column, monomials
from linfit.functions.scalar import PROBABILITY_FLOOR
from linfit.operators.errors import DivergedError
from linfit.operators.instances import UNFOLDED, pack_blocks
from linfit.operators.logistic import (
    Fit,
    LogisticModel,
    area_many,
    check_fit_parameters,
    check_threshold,
    confusion_many,
    fit_many,
    graded_terms,
)
from linfit.operators.metrics import SCORE_TYPES, score, score_columns
from linfit.operators.resample import check_folds

AREA = "area"
SCORE_SCHEMA = "degree int, lambda double, fold int, score double"


def param_grid(
    degrees: Sequence[int] = (1,), lambdas: Sequence[float] = (0.0,)
) -> list[tuple[int, float]]:
    """Every (degree, lambda) pair; a search also takes any subset of such pairs."""
    return check_grid([(int(d), float(v)) for d in degrees for v in lambdas])


def check_grid(grid: Sequence[tuple[int, float]]) -> list[tuple[int, float]]:
    if not grid:
        raise ValueError("the grid is empty")
    if any(d < 1 for d, _ in grid):
        raise ValueError("polynomial degree must be at least 1")
    if any(not v >= 0.0 for _, v in grid):
        raise ValueError("lambda must not be negative")
    return list(dict.fromkeys(grid))


@dataclass
class CVResult:
    """What a search found. ``fold_scores`` holds ``(degree, lambda, fold, score)``."""

    spark: SparkSession
    fold_scores: list[tuple[int, float, int, float | None]]
    k: int
    width: int
    best: tuple[int, float] = None
    model: LogisticModel = None

    def folds(self) -> DataFrame:
        return self.spark.createDataFrame(self.fold_scores, schema=SCORE_SCHEMA)

    def scores(self) -> DataFrame:
        return mean_scores(self.folds(), self.k)


def mean_scores(fold_scores: DataFrame, k: int) -> DataFrame:
    """``(degree, lambda, score)``: fold scores summed and divided by k, to twelve digits.

    Rows meet in any order and sums depend on it in their last bits; rounded, equal means tie in
    every run. A point whose score is undefined in some fold, as precision without predicted positives,
    has no score.
    """
    total = F.when(F.count("score") == F.count(F.lit(1)), F.sum("score"))
    return fold_scores.groupBy("degree", "lambda").agg(F.round(total / k, 12).alias("score"))


def best_score(scores: DataFrame) -> DataFrame:
    """The row with the highest score; ties go to the lower degree, then the lower lambda."""
    order = [F.desc_nulls_last("score"), F.asc("degree"), F.asc("lambda")]
    return scores.orderBy(*order).limit(1)


def cross_validate_logistic(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    fold: str = "fold",
    k: int = 3,
    grid: Sequence[tuple[int, float]] = ((1, 0.0),),
    method: str = "gradient",
    max_iter: int = 100,
    learning_rate: float = 1.0,
    tol: float = 1e-6,
    score_type: str = "accuracy",
    threshold: float = 0.5,
) -> CVResult:
    """Pick (degree, lambda) by mean score over k folds, then refit the winner on all rows.

    ``df`` carries fold numbers 0 to k-1. Only the unexpanded features are cached, equal rows of
    a partition as one with a count. Each
    iteration is one job over them in which all folds, degrees and lambdas advance together:
    tasks build the highest degree's terms once, and lower degrees use a prefix of these. The
    score ``area`` ranks by the ROC area, for all of them in one job more.
    """
    check_folds(k)
    check_threshold(threshold)
    grid = check_grid(grid)
    check_fit_parameters(method, max_iter, [v for _, v in grid], tol, True)
    if score_type not in (*SCORE_TYPES, AREA):
        raise ValueError(f"unknown score {score_type!r}: use one of {', '.join((*SCORE_TYPES, AREA))}")
    with pack_blocks(df, label, features, fold, merge=True) as blocks:
        plan = [(d, v, f) for d, v in grid for f in range(k)]
        fits = [Fit(graded_terms(blocks.width, d), v, f) for d, v, f in plan]
        fit_many(blocks, fits, method, max_iter, learning_rate, tol)
        if score_type == AREA:
            scores = area_many(blocks, fits)
        else:
            counts = confusion_many(blocks, fits, threshold)
            scores = [score(*map(int, row), score_type) for row in counts]
        fold_scores = [(*point, s) for point, s in zip(plan, scores, strict=True)]
        result = CVResult(df.sparkSession, fold_scores, k, blocks.width)
        winner = best_score(result.scores()).first()
        result.best = (winner["degree"], winner["lambda"])
        refit = Fit(graded_terms(blocks.width, result.best[0]), result.best[1])
        fit_many(blocks, [refit], method, max_iter, learning_rate, tol)
        result.model = refit.model(monomials(blocks.width, result.best[0]))
        return result


def score_best(
    test: DataFrame,
    result: CVResult,
    features: str = "features",
    label: str = "label",
    threshold: float = 0.5,
) -> DataFrame:
    """Confusion counts and scores of the refitted winner on held-out rows, as one row.

    Scored block by block, like the folds of the search, so thousands of terms cost no plan.
    """
    with pack_blocks(test, label, features, merge=True) as blocks:
        if blocks.width != result.width:
            raise ValueError(f"expected feature vectors of {result.width}, not {blocks.width}")
        terms = graded_terms(blocks.width, result.best[0])
        at = {t: v for t, v in zip(monomials(blocks.width, result.best[0]), result.model.theta)}
        fit = Fit(terms, held_out=UNFOLDED, intercept=result.model.intercept)
        fit.theta = np.array([at[t] for t in terms])
        row = confusion_many(blocks, [fit], threshold)[0]
    names = ("true_positive", "true_negative", "false_positive", "false_negative")
    counts = result.spark.createDataFrame(
        [tuple(map(int, row))], schema=", ".join(f"{n} long" for n in names)
    )
    scores = [value.alias(name) for name, value in score_columns().items()]
    return counts.select("*", *scores)


def cross_validate_native(
    df: DataFrame,
    stages: Sequence,
    axes: Sequence[tuple[Param, Sequence[float]]],
    evaluator: Evaluator,
    k: int,
    fold: str | None = None,
    parallelism: int = 4,
    seed: int = 42,
) -> CrossValidatorModel:
    """The library's search over a pipeline; folds come from a column where one is given.

    Its folds read the table again and again, so it is kept while the search runs. A metric that
    is not a number raises: the search would take it for the best.
    """
    grid = ParamGridBuilder()
    for param, values in axes:
        grid = grid.addGrid(param, list(values))
    search = CrossValidator(
        estimator=Pipeline(stages=list(stages)),
        estimatorParamMaps=grid.build(),
        evaluator=evaluator,
        numFolds=k,
        parallelism=parallelism,
        seed=seed,
    )
    if fold:
        search = search.setFoldCol(fold)
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = search.fit(kept)
    finally:
        kept.unpersist()
    if not np.isfinite(model.avgMetrics).all():
        raise DivergedError(f"a grid point has no finite score: {list(model.avgMetrics)}")
    return model


class CountedScaler(Estimator):
    """Divides each feature by its sample deviation, each row counted ``rows`` times.

    The library's own scaling takes weights as importance, so that its deviation depends on how
    rows are merged; a fit on counted rows scales by this one instead. A feature without deviation
    becomes 0.
    """

    def __init__(self, features: str, out: str, rows: str) -> None:
        super().__init__()
        self.features, self.out, self.rows = features, out, rows

    def _fit(self, dataset: DataFrame) -> ElementwiseProduct:
        w = column(self.rows).cast("double")
        summary = Summarizer.metrics("std").summary(column(self.features), w)
        found = dataset.agg(summary["std"].alias("std"), F.sum(w).alias("n"), F.sum(w * w).alias("squares")).first()
        # From the library's n - squares / n in the denominator to n - 1.
        free = found.n - found.squares / found.n
        std = found.std.toArray() * (np.sqrt(free / (found.n - 1)) if found.n > 1 else 0.0)
        factor = [1.0 / s if s > 0 else 0.0 for s in std]
        return ElementwiseProduct(scalingVec=Vectors.dense(factor), inputCol=self.features, outputCol=self.out)


def native_scores(spark: SparkSession, model: CrossValidatorModel) -> DataFrame:
    """``(point, params, score)`` of a library search, one row per grid point."""
    rows = [
        (i, ", ".join(sorted(f"{p.name}={v}" for p, v in point.items())), float(s))
        for i, (point, s) in enumerate(zip(model.getEstimatorParamMaps(), model.avgMetrics))
    ]
    return spark.createDataFrame(rows, schema="point int, params string, score double")


def cross_entropy_evaluator(label: str = "label") -> MulticlassClassificationEvaluator:
    """Mean multiclass cross-entropy, clipped at 1e-15; smaller is better."""
    return MulticlassClassificationEvaluator(
        labelCol=label, metricName="logLoss", eps=PROBABILITY_FLOOR
    )
