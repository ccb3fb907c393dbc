"""Elastic net: conditions of the optimum, exact zeros, and folds one by one."""

import numpy as np
import pytest

from linfit.operators.elastic_net import elastic_net_path, elastic_net_search

SCHEMA = "id long, label double, features array<double>, fold int"


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 12)) + 3
    x[:, 5] = x[:, 4] + rng.normal(size=400) * 0.01
    x[:, 11] = 2.0
    y = x[:, 0] * 2 - x[:, 1] + 0.5 * x[:, 4] + rng.normal(size=400) * 0.3 + 7
    rows = [(i, float(y[i]), x[i].tolist(), i % 4) for i in range(400)]
    return x, y, spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize("mix", [1.0, 0.5, 0.0])
def test_conditions_of_the_optimum(data, mix):
    x, y, df = data
    grid = (1.0, 0.1, 0.01, 0.001)
    found = elastic_net_path(df, grid, mix)
    c, d = x - x.mean(axis=0), y - y.mean()
    for penalty in grid:
        fit = found[penalty]
        slope = c.T @ (d - c @ fit.theta) / len(y) - penalty * (1 - mix) * fit.theta
        zero = fit.theta == 0
        assert np.abs(slope[~zero] - penalty * mix * np.sign(fit.theta[~zero])).max(initial=0) < 1e-8
        assert np.all(np.abs(slope[zero]) <= penalty * mix + 1e-8)
        assert fit.theta[11] == 0 and fit.intercept == pytest.approx(y.mean() - fit.theta @ x.mean(axis=0))
    if mix == 1.0:
        assert np.count_nonzero(found[1.0].theta) < np.count_nonzero(found[0.001].theta)


def test_search_equals_fits_one_by_one(data):
    x, y, df = data
    grid = (0.5, 0.05)
    scores, best = elastic_net_search(df, 4, grid, 0.7)
    for penalty, f, rmse in scores:
        fit = elastic_net_path(df.where(f"fold <> {f}"), grid, 0.7)[penalty]
        held = np.arange(400) % 4 == f
        off = y[held] - x[held] @ fit.theta - fit.intercept
        assert rmse == pytest.approx(np.sqrt((off**2).mean()), rel=1e-7)
    assert best.l1 == pytest.approx(0.05 * 0.7)


def test_bad_parameters_raise(data):
    _, _, df = data
    for penalties, mix in (((), 0.5), ((-1.0,), 0.5), ((0.1,), 1.5)):
        with pytest.raises(ValueError):
            elastic_net_path(df, penalties, mix)
    with pytest.raises(ValueError, match="no rows"):
        elastic_net_search(df, 5, (0.1,))
    with pytest.raises(ValueError, match="no instances"):
        elastic_net_path(df.limit(0), (0.1,))
