"""Multinomial fits, quasi-Newton steps and fold moments against plain computations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from linfit.operators.errors import DivergedError
from linfit.operators.fold_moments import fold_moments, ridge_search
from linfit.operators.instances import pack_blocks
from linfit.operators.logistic import logistic_native
from linfit.operators.multinomial import (
    cross_validate_multinomial,
    multinomial_fit,
    multinomial_predict,
)
from linfit.operators.quasi_newton import descend

SCHEMA = "id long, label double, features array<double>, fold int"


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 4)) * [1, 5, 0.1, 1] + [0, 100, 0, 3]
    x[:, 3] = 7.0  # constant
    z = np.column_stack([x[:, 0], 0.3 * (x[:, 1] - 100), 4 * x[:, 2]])
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    y = np.array([rng.choice(3, p=q) for q in p])
    return x, y


@pytest.fixture(scope="module")
def table(spark, points):
    x, y = points
    rows = [(i, float(y[i]), [float(v) for v in x[i]], i % 4) for i in range(len(x))]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


def probabilities(model, x):
    z = x @ model.theta.T + model.intercepts
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def test_agrees_with_the_library(table, points):
    mine = multinomial_fit(table, 3, l2=0.01, max_iter=400, tol=1e-14)
    theirs = logistic_native(table, regParam=0.01, maxIter=400, tol=1e-14, family="multinomial")
    # The library scales without centring and by its own deviation, which has the same optimum.
    assert np.abs(mine.theta - theirs.coefficientMatrix.toArray()).max() < 1e-6
    gap = mine.intercepts - theirs.interceptVector.toArray()
    assert np.abs(gap - gap.mean()).max() < 1e-5
    assert mine.losses == sorted(mine.losses, reverse=True) and len(mine.losses) < 60
    got = {r.id: r.probability for r in multinomial_predict(table, mine, keys=["id"]).collect()}
    x, _ = points
    assert np.allclose(np.array([got[i] for i in range(len(x))]), probabilities(mine, x), atol=1e-12)


def test_search_equals_fits_one_by_one(spark, table, points):
    x, y = points
    grid = (0.3, 0.003)
    found = cross_validate_multinomial(table, 4, grid, 3, max_iter=200, tol=1e-13)
    for l2, fold, score in found.fold_scores:
        alone = multinomial_fit(table.where(F.col("fold") != fold), 3, l2=l2, max_iter=200, tol=1e-13)
        held = np.arange(len(x)) % 4 == fold
        p = probabilities(alone, x[held])[np.arange(held.sum()), y[held]]
        assert score == pytest.approx(-np.log(p).mean(), abs=1e-7)
    means = {v: np.mean([s for u, _, s in found.fold_scores if u == v]) for v in grid}
    assert found.best == min(means, key=means.get)
    refit = multinomial_fit(table, 3, l2=found.best, max_iter=200, tol=1e-13)
    assert np.allclose(refit.theta, found.model.theta, atol=1e-6)


def test_gradient_steps_and_divergence(table):
    slow = multinomial_fit(table, 3, l2=0.01, max_iter=5, method="gradient", learning_rate=0.5)
    assert slow.losses[0] == pytest.approx(np.log(3)) and slow.losses[-1] < slow.losses[0]
    with pytest.raises(DivergedError):
        multinomial_fit(table, 3, l2=1e300, max_iter=9, method="gradient", learning_rate=1e300)


@pytest.mark.parametrize(
    "row", [(1, None, [1.0] * 4, 0), (1, 3.0, [1.0] * 4, 0), (1, 0.5, [1.0] * 4, 0), (1, 1.0, None, 0), (1, 1.0, [1.0], 0), (1, 1.0, [None, 1.0, 1.0, 1.0], 0)]
)
def test_bad_rows_raise(spark, table, row):
    bad = table.union(spark.createDataFrame([row], SCHEMA))
    with pytest.raises(ValueError):
        multinomial_fit(bad, 3)


def test_bad_parameters_raise(spark, table):
    with pytest.raises(ValueError, match="no instances"):
        multinomial_fit(table.limit(0), 3)
    for change in ({"classes": 1}, {"l2": -1.0}, {"max_iter": 0}, {"method": "newton"}):
        with pytest.raises(ValueError):
            multinomial_fit(table, **({"classes": 3} | change))
    with pytest.raises(ValueError, match="folds"):
        cross_validate_multinomial(table, 3, [0.1], 3)
    with pytest.raises(ValueError, match="without rows"):
        cross_validate_multinomial(table, 5, [0.1], 3)


def test_many_features_take_few_passes(spark):
    rng = np.random.default_rng(9)
    d, n = 1500, 1200
    x = rng.normal(size=(n, d))
    y = (rng.random(n) < 1 / (1 + np.exp(-x[:, :20].sum(axis=1)))).astype(float)
    rows = [(i, float(y[i]), x[i].tolist(), 0) for i in range(n)]
    model = multinomial_fit(spark.createDataFrame(rows, SCHEMA), 2, l2=0.05, max_iter=100, tol=1e-8)
    assert len(model.losses) < 40
    p = probabilities(model, x)[:, 1]
    scale = x.std(axis=0, ddof=1)
    slope = (x.T @ (p - y)) / n / scale + 0.05 * model.theta[1] * scale
    assert np.abs(slope).max() < 1e-3


def test_descend_on_hard_functions():
    def rosenbrock(v):
        a, b = v[0], v[1]
        return (1 - a) ** 2 + 100 * (b - a * a) ** 2, np.array([2 * (a - 1) - 400 * a * (b - a * a), 200 * (b - a * a)])

    def steep(v):
        with np.errstate(over="ignore"):
            return float(np.exp(v[0]) - 50 * v[0]), np.array([np.exp(v[0]) - 50])

    calls = []

    def evaluate(points):
        calls.append({i: len(p) for i, p in points.items()})
        return {i: [(rosenbrock, steep)[i](p) for p in some] for i, some in points.items()}

    a, b = descend([np.array([-1.2, 1.0]), np.array([-3.0])], evaluate, 300, 1e-14)
    assert np.allclose(a.point, 1, atol=1e-4) and b.point[0] == pytest.approx(np.log(50), abs=1e-5)
    assert len(calls) < 120 and any(n == 4 for c in calls for n in c.values())


def test_fold_moments_keep_digits(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 2)) + 1e7
    rows = [(i, float(i), x[i].tolist(), i % 3) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    with pack_blocks(df, fold="fold", classes=None) as blocks:
        moments = fold_moments(blocks, 3)
        whole = fold_moments(blocks, 3, products=True)
    for f in (0, 1, 2, None):
        seen = np.ones(400, bool) if f is None else np.arange(400) % 3 != f
        for m in (moments, whole):
            mean, deviation = m.scaling(f)
            assert np.allclose(mean, x[seen].mean(axis=0), rtol=1e-12)
            assert np.allclose(deviation, x[seen].std(axis=0, ddof=1), rtol=1e-7)


def test_ridge_search_equals_fits_one_by_one(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 3)) + [5, -2, 0]
    y = x @ [1.0, -2.0, 0.5] + 40 + rng.normal(size=300)
    rows = [(i, float(y[i]), x[i].tolist(), i % 5) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    grid = (0.0, 1.0, 50.0)
    found = ridge_search(df, 5, grid)
    for l2, f, rmse in found.fold_scores:
        seen = np.arange(300) % 5 != f
        mx, my = x[seen].mean(axis=0), y[seen].mean()
        c = x[seen] - mx
        theta = np.linalg.solve(c.T @ c + l2 * np.eye(3), c.T @ (y[seen] - my))
        off = y[~seen] - my - (x[~seen] - mx) @ theta
        assert rmse == pytest.approx(np.sqrt((off**2).mean()), rel=1e-9)
    assert found.best == min(grid, key=lambda v: np.mean([s for u, _, s in found.fold_scores if u == v]))
    assert found.intercept == pytest.approx(40, abs=1.5) and np.allclose(found.theta, [1, -2, 0.5], atol=0.3)
    for bad in ({"k": 6}, {"lambdas": ()}, {"lambdas": (-1.0,)}):
        with pytest.raises(ValueError):
            ridge_search(df, **({"k": 5, "lambdas": grid} | bad))
