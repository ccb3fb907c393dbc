import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from linfit.functions.features import with_bias
from linfit.operators import logistic as L
from linfit.operators.errors import DivergedError, NotPositiveDefiniteError
from linfit.operators.instances import (
    constant_arity,
    feature_arity,
    instances,
    pack_blocks,
    spread,
)


def arrays(df):
    rows = df.orderBy("id").collect()
    return np.array([r.features for r in rows]), np.array([r.label for r in rows])


def loss(x, y, theta, b):
    z = x @ theta + b
    return float(np.mean(np.logaddexp(0, np.where(y == 1, -z, z))))


def plain_descent(x, y, steps, rate, l2, tol=1e-6):
    """Gradient descent written down row by row, to compare with."""
    theta, b, losses, delta = np.zeros(x.shape[1]), 0.0, [], 100.0
    while len(losses) < steps and delta > tol:
        if len(losses) >= 2 and losses[-1] > losses[-2]:
            rate /= 2
        r = 1 / (1 + np.exp(-(x @ theta + b))) - y
        losses.append(loss(x, y, theta, b))
        theta, b = theta - rate * (x.T @ r + l2 * theta), b - rate * r.sum()
        if len(losses) > 1:
            delta = abs(losses[-1] - losses[-2])
    return theta, b, losses


@pytest.mark.parametrize("rate", [5e-4, 0.05])
def test_descent_matches_plain_numpy(binary, rate):
    """The second rate overshoots, so the halving rule is at work."""
    x, y = arrays(binary)
    theta, b, losses = plain_descent(x, y, 12, rate, 0.3)
    model = L.logistic_fit(binary, max_iter=12, learning_rate=rate, l2=0.3)
    assert np.allclose(model.theta, theta, rtol=1e-9)
    assert model.intercept == pytest.approx(b, rel=1e-9)
    assert np.allclose(model.losses, losses, rtol=1e-10)
    assert model.losses[0] == pytest.approx(math.log(2))


def test_stops_on_tolerance(binary):
    assert L.logistic_fit(binary, max_iter=50, learning_rate=5e-4, tol=100.0).losses == []
    zero = L.logistic_fit(binary, max_iter=50, learning_rate=5e-4, tol=100.0)
    assert zero.theta == [0.0] * 3 and zero.intercept == 0.0
    early = L.logistic_fit(binary, max_iter=50, learning_rate=1e-3, tol=1e-3)
    assert 2 <= len(early.losses) < 50
    assert abs(early.losses[-1] - early.losses[-2]) <= 1e-3
    assert len(L.logistic_fit(binary, max_iter=50, learning_rate=5e-4, tol=99.0).losses) == 2


def test_newton_reaches_the_optimum(binary):
    x, y = arrays(binary)
    model = L.logistic_fit(binary, method="newton", max_iter=12, tol=1e-12)
    r = 1 / (1 + np.exp(-(x @ model.theta + model.intercept))) - y
    assert np.abs(x.T @ r).max() < 1e-6 and abs(r.sum()) < 1e-6
    slow = L.logistic_fit(binary, max_iter=25, learning_rate=2e-3, tol=0.0)
    assert np.allclose(slow.theta, model.theta, atol=0.02)
    native = L.logistic_native(binary, tol=1e-12)
    assert np.allclose(native.coefficients, model.theta, atol=1e-5)
    assert native.intercept == pytest.approx(model.intercept, abs=1e-5)


def test_newton_penalty_matches_library(binary):
    model = L.logistic_fit(binary, method="newton", max_iter=12, tol=1e-12, l2=20.0)
    native = L.logistic_native(binary, regParam=20.0 / 2000, standardization=False, tol=1e-12)
    assert np.allclose(native.coefficients, model.theta, atol=1e-5)


def test_newton_on_an_explicit_bias_feature(binary):
    """A ones column as last feature is the same fit as an intercept."""
    biased = binary.withColumn("features", with_bias("features"))
    a = L.logistic_fit(biased, method="newton", max_iter=4, tol=0.0, fit_intercept=False)
    b = L.logistic_fit(binary, method="newton", max_iter=4, tol=0.0)
    assert a.intercept == 0.0
    assert np.allclose(a.theta, [*b.theta, b.intercept], rtol=1e-9)
    assert np.allclose(a.losses, b.losses)


def test_bad_parameters_and_data(spark, binary):
    for bad in (
        dict(method="other"),
        dict(max_iter=0),
        dict(l2=-1.0),
        dict(tol=-1.0),
        dict(fit_intercept=False),
    ):
        with pytest.raises(ValueError):
            L.logistic_fit(binary, learning_rate=1e-3, **bad)
    with pytest.raises(ValueError, match="labels other than 0 and 1"):
        L.logistic_fit(binary.withColumn("label", F.col("label") + 1))
    with pytest.raises(ValueError, match="null"):
        L.logistic_fit(binary.withColumn("features", F.array(F.lit(None).cast("double"))))
    with pytest.raises(ValueError, match="differ in length"):
        L.logistic_fit(
            binary.withColumn(
                "features",
                F.when(F.col("id") == 5, F.array(F.lit(1.0))).otherwise(F.col("features")),
            )
        )
    with pytest.raises(ValueError, match="no instances"):
        L.logistic_fit(binary.filter("id < 0"))
    zero = binary.withColumn("features", F.concat("features", F.array(F.lit(0.0))))
    with pytest.raises(NotPositiveDefiniteError):
        L.logistic_fit(zero, method="newton", max_iter=3)
    huge = binary.withColumn("features", F.transform("features", lambda v: v * 1e200))
    with pytest.raises(DivergedError, match="iteration"):
        L.logistic_fit(huge, learning_rate=1e200, max_iter=5)


def test_predict_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(1.0, [0.0]), (0.0, [-9.0])], "label double, features array<double>")
    rows = L.logistic_predict(df, L.LogisticModel([1.0], 0.0), 0.5).collect()
    assert [(r.prediction_prob == 0.5, r.prediction) for r in rows] == [(True, 1.0), (False, 0.0)]
    for bad in (0.0, 1.0):
        with pytest.raises(ValueError):
            L.logistic_predict(df, L.LogisticModel([1.0], 0.0), bad)


def test_one_pass_aggregates(binary):
    x, y = arrays(binary)
    theta, b = np.array([0.5, -0.25, 0.1]), 0.2
    row = L.fused_gradient_loss(binary, theta, b).first()
    r = 1 / (1 + np.exp(-(x @ theta + b))) - y
    assert np.allclose([row.g0, row.g1, row.g2], x.T @ r)
    assert row.g_intercept == pytest.approx(r.sum()) and row.n == 2000
    assert row.loss / row.n == pytest.approx(loss(x, y, theta, b))
    ce = L.binary_cross_entropy(binary, theta, b).first().cross_entropy
    assert ce == pytest.approx(loss(x, y, theta, b))
    g = L.logloss_gradient(binary, theta, b).first()
    step = 1e-6
    for i in range(3):
        e = np.eye(3)[i] * step
        slope = 2000 * (loss(x, y, theta + e, b) - loss(x, y, theta - e, b)) / (2 * step)
        assert g[f"g{i}"] == pytest.approx(slope, rel=1e-4, abs=1e-3)


def test_hessian(binary):
    x, _ = arrays(binary)
    theta = np.array([0.5, -0.25, 0.1])
    s = 1 / (1 + np.exp(-(x @ theta)))
    from linfit.operators.moments import collect_symmetric

    got = collect_symmetric(L.logistic_hessian(binary, theta))
    assert np.allclose(got, (x * (s * (1 - s))[:, None]).T @ x)


def test_weighted_library_fit_ignores_rows_of_weight_zero(binary):
    weighted = binary.withColumn("w", (F.col("id") % 2).cast("double"))
    a = L.logistic_native(weighted, weight="w", tol=1e-10)
    b = L.logistic_native(binary.filter("id % 2 = 1"), tol=1e-10)
    assert np.allclose(a.coefficients, b.coefficients, atol=1e-4)


def test_instances_and_arity(spark, binary):
    assert instances(binary, "label", "features", bias=True).first().features[-1] == 1.0
    assert constant_arity(binary) == 3
    ragged = spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "features array<double>")
    assert tuple(feature_arity(ragged).first()) == (None, 1, 2)
    with pytest.raises(ValueError):
        constant_arity(ragged)


def test_blocks_keep_every_row(binary):
    with pack_blocks(binary) as blocks:
        assert (blocks.rows, blocks.width, blocks.partitions) == (2000, 3, 4)
        assert blocks.df.agg(F.sum(F.length("x"))).first()[0] == 2000 * 3 * 8
    assert not blocks.df.is_cached


def test_spread_only_when_too_few_splits(spark, small):
    cores = spark.sparkContext.defaultParallelism
    table = spark.read.parquet(f"{small}/lineitem.parquet")
    assert spread(table).rdd.getNumPartitions() == cores
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "1k")
    try:
        assert spread(table) is table
    finally:
        spark.conf.set(name, before)


def test_overlapping_reads_leave_the_session_as_it_was(spark, binary):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with pack_blocks(binary) as one, pack_blocks(binary) as two:
        a, b = one.read(), two.read()
        assert spark.conf.get(name) == before
        assert a.count() == b.count()
    assert spark.conf.get(name) == before


def test_wide_gradient_equals_narrow(binary):
    """Padding with zeros beyond the generated-sum limit switches the plan, not the numbers."""
    pad = L.MAX_GENERATED_TERMS
    theta = [0.5, -0.25, 0.1]
    wide = binary.withColumn("features", F.concat("features", F.array_repeat(F.lit(0.0), pad)))
    a = L.fused_gradient_loss(binary, theta, 0.2).first()
    b = L.fused_gradient_loss(wide, theta + [0.0] * pad, 0.2).first()
    assert len(b) == 3 + pad + 3 and b[f"g{pad}"] == 0.0
    for name in ("g0", "g1", "g2", "g_intercept", "loss", "n"):
        assert a[name] == pytest.approx(b[name], rel=1e-12)


def test_lost_blocks_are_rebuilt(binary):
    """Without its cached blocks a fit recomputes them from the input and ends the same."""
    fits = [L.Fit(L.graded_terms(3, 2), 0.1), L.Fit(L.graded_terms(3, 2), 0.1)]
    with pack_blocks(binary) as blocks:
        L.fit_many(blocks, fits[:1], max_iter=3, learning_rate=4e-4)
        blocks.df.unpersist(blocking=True)
        L.fit_many(blocks, fits[1:], max_iter=3, learning_rate=4e-4)
    assert fits[0].losses == pytest.approx(fits[1].losses, rel=1e-14)
    assert np.allclose(fits[0].theta, fits[1].theta, rtol=1e-12)


def test_session_setting_is_restored(spark, binary):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with pytest.raises(ValueError):
        L.logistic_fit(binary, learning_rate=1e-3, l2=-1.0)
    L.logistic_fit(binary, max_iter=1, learning_rate=1e-3)
    assert spark.conf.get(name) == before
