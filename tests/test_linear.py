import numpy as np
import pytest
from pyspark.sql import functions as F

from linfit.operators.errors import NotPositiveDefiniteError
from linfit.operators.linear import (
    linear_predict,
    ridge_fit,
    ridge_native,
    ridge_reg_param,
    solve_positive_definite,
)
from linfit.operators.metrics import rmse


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(800, 4))
    y = x @ [1.0, -2.0, 0.5, 0.0] + rng.normal(size=800) * 0.1
    y = y - y.mean()
    df = spark.createDataFrame(
        [([float(v) for v in r], float(t)) for r, t in zip(x, y)],
        "features array<double>, label double",
    )
    return df.cache(), x, y


@pytest.mark.parametrize("width", [None, 4])
@pytest.mark.parametrize("l2", [0.0, 0.1, 50.0])
def test_ridge_solves_the_normal_equations(table, width, l2):
    df, x, y = table
    expected = np.linalg.solve(x.T @ x + l2 * np.eye(4), x.T @ y)
    assert np.allclose(ridge_fit(df, l2=l2, width=width).theta, expected, rtol=1e-10)


def test_library_fit_under_the_mapping(table):
    df, *_ = table
    own = ridge_fit(df, l2=50.0)
    native = ridge_native(df, reg_param=ridge_reg_param(df, 50.0), standardization=False)
    assert np.allclose(own.theta, native.theta, rtol=1e-8)


def test_predict_and_rmse(table):
    df, x, y = table
    model = ridge_fit(df, l2=0.1)
    got = rmse(linear_predict(df, model)).first().rmse
    assert got == pytest.approx(np.sqrt(np.mean((y - x @ model.theta) ** 2)), rel=1e-12)


def test_zero_feature(table):
    df, *_ = table
    zero = df.withColumn("features", F.concat("features", F.array(F.lit(0.0))))
    with pytest.raises(NotPositiveDefiniteError):
        ridge_fit(zero)
    assert ridge_fit(zero, l2=0.1).theta[-1] == 0.0
    with pytest.raises(ValueError):
        ridge_fit(zero, l2=-1.0)


def test_solver_leaves_its_arguments_alone():
    a, b = np.array([[4.0, 1.0], [1.0, 3.0]]), np.array([1.0, 2.0])
    before = a.copy(), b.copy()
    x = solve_positive_definite(a, b)
    assert np.allclose(a @ x, b)
    assert (a == before[0]).all() and (b == before[1]).all()
