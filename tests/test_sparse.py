"""Sparse weighted fits against dense ones and the library."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linfit.operators import kernels, quasi_newton, sparse
from linfit.operators.logistic import logistic_native
from linfit.operators.sparse import (
    sparse_instances,
    sparse_logistic_fit,
    sparse_predict,
    sparse_width,
)

RAW = "id long, label double, w double, a double, b double, kind int, other int"


@pytest.fixture(scope="module")
def raw(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(1500):
        a, b, kind, other = float(rng.normal()), float(rng.normal() * 20 + 5), int(rng.integers(4)), int(rng.integers(3))
        p = 1 / (1 + np.exp(-(a + 0.02 * b + [0, 1, -1, 0.5][kind])))
        rows.append((i, float(rng.random() < p), float(rng.integers(0, 4)), a, b, kind, other if other else None))
    return spark.createDataFrame(rows, RAW).repartition(4).cache()


KINDS = [("kind", 4), ("other", 3)]


def dense(df):
    slots = [F.when(F.col(c) == i, 1.0).otherwise(0.0) for c, n in KINDS for i in range(n)]
    return df.withColumn("features", F.array("a", "b", *slots))


@pytest.mark.parametrize("l2", [0.01, 0.5])
def test_equals_the_library_on_dense_rows(raw, l2):
    rows = sparse_instances(raw, "label", ["a", "b"], KINDS, "w", keys=["id"])
    width = sparse_width(["a", "b"], KINDS)
    assert width == 9
    mine = sparse_logistic_fit(rows, width, l2=l2, max_iter=300, tol=1e-15)
    theirs = logistic_native(dense(raw), weight="w", regParam=l2, maxIter=300, tol=1e-15)
    assert np.allclose(mine.theta, theirs.coefficients.toArray(), atol=1e-5)
    assert mine.intercept == pytest.approx(theirs.intercept, abs=1e-5)
    assert mine.theta[6] == 0.0  # no row has this value, so its column is constant
    x = np.array([r.features for r in dense(raw).orderBy("id").collect()])
    want = 1 / (1 + np.exp(-(x @ mine.theta + mine.intercept)))
    got = {r.id: r.prediction_prob for r in sparse_predict(rows, mine, ["id"]).collect()}
    assert np.allclose([got[i] for i in range(len(x))], want, atol=1e-12)


def test_weights_are_repeats(raw):
    width = sparse_width(["a", "b"], KINDS)
    weighted = sparse_instances(raw, "label", ["a", "b"], KINDS, "w")
    times = raw.where("w > 0").withColumn("t", F.explode(F.sequence(F.lit(1), F.col("w").cast("int"))))
    repeated = sparse_instances(times, "label", ["a", "b"], KINDS)
    one, two = (sparse_logistic_fit(t, width, max_iter=300, tol=1e-14, standardize=False, l2=0.1) for t in (weighted, repeated))
    assert np.allclose(one.theta, two.theta, atol=1e-6)


def test_hundred_thousand_categories(spark):
    n, size = 4000, 100_000
    df = spark.range(n).select(
        (F.col("id") % 2).cast("double").alias("label"), (F.col("id") * 23 % size).cast("int").alias("k"), (F.col("id") % 2 + F.rand(3)).alias("x")
    )
    kinds = [("k", size)]
    model = sparse_logistic_fit(sparse_instances(df, "label", ["x"], kinds), sparse_width(["x"], kinds), l2=1e-3, max_iter=30)
    assert len(model.theta) == size + 1 and model.theta[0] > 0
    assert np.count_nonzero(model.theta) == n + 1
    assert model.losses[-1] < 0.2 < model.losses[0]


def test_wide_sums_leave_tasks_in_pieces(monkeypatch):
    monkeypatch.setattr(kernels, "CHUNK", 1000)
    rng, width = np.random.default_rng(5), 50_000
    at = rng.choice(width, (300, 2)).astype(np.int32)
    y, w, x = (rng.random(300) < 0.5).astype(float), rng.random(300), rng.normal(size=(300, 2))
    lists = (pa.array(list(v), pa.list_(k)) for v, k in ((at, pa.int32()), (x, pa.float64())))
    rows = pa.RecordBatch.from_arrays([pa.array(y), pa.array(w), *lists], names=["label", "weight", "indices", "values"])
    blocks = list(kernels.sparse_packer(width)(iter([rows])))
    assert len(blocks[0].column("places")[0].as_buffer()) == 4 * len(np.unique(at))
    theta, bias = rng.normal(size=(2, width)), np.array([0.1, -0.2])
    found = list(kernels.sparse_logistic_pass(theta, bias)(iter(blocks)))
    assert all(len(v) <= 1000 for b in found for v in b.column("part")) and max(b.num_rows for b in found) == 1
    got = np.zeros((2, 51 * 1000))
    for b in found:
        fit, part = b.column("fit")[0].as_py(), b.column("part")[0].values.to_numpy()
        got[fit // 51, fit % 51 * 1000 :][: len(part)] = part
    p = 1 / (1 + np.exp(-((x * theta[:, at]).sum(axis=2) + bias[:, None])))
    want = np.zeros((2, width))
    for i in range(2):
        np.add.at(want[i], at, ((p[i] - y) * w)[:, None] * x)
    assert np.allclose(got[:, :width], want, atol=1e-12)
    assert np.allclose(got[:, width], ((p - y) * w).sum(axis=1), atol=1e-12)


def test_pieces_passes_and_files_change_nothing(raw, monkeypatch):
    rows = sparse_instances(raw, "label", ["a", "b"], KINDS, "w")
    whole = sparse_logistic_fit(rows, 9, l2=0.01, max_iter=300, tol=1e-14)
    # Functions that go to the tasks take the size along; the driver reads it from the module.
    monkeypatch.setattr(kernels, "CHUNK", 4)
    monkeypatch.setattr(sparse, "PASS_NUMBERS", 1)
    monkeypatch.setattr(quasi_newton, "FILED_BYTES", 1)
    pieces = sparse_logistic_fit(rows, 9, l2=0.01, max_iter=300, tol=1e-14)
    assert np.allclose(pieces.theta, whole.theta, atol=1e-6)
    assert pieces.intercept == pytest.approx(whole.intercept, abs=1e-6)


def test_bad_rows_and_parameters_raise(spark, raw):
    schema = "label double, weight double, indices array<int>, values array<double>"
    good = (1.0, 1.0, [0], [2.0])
    for bad in [(2.0, 1.0, [0], [1.0]), (None, 1.0, [0], [1.0]), (1.0, -1.0, [0], [1.0]), (1.0, None, [0], [1.0]), (1.0, 1.0, None, [1.0]), (1.0, 1.0, [5], [1.0]), (1.0, 1.0, [0, 1], [1.0]), (1.0, 1.0, [None], [1.0]), (1.0, 1.0, [0], [float("nan")])]:
        with pytest.raises(ValueError, match="unusable"):
            sparse_logistic_fit(spark.createDataFrame([good, bad], schema), 3)
    with pytest.raises(ValueError, match="no instances"):
        sparse_logistic_fit(spark.createDataFrame([], schema), 3)
    with pytest.raises(ValueError, match="weights are 0"):
        sparse_logistic_fit(spark.createDataFrame([(1.0, 0.0, [0], [1.0])], schema), 3)
    with pytest.raises(ValueError):
        sparse_logistic_fit(spark.createDataFrame([good], schema), 0)
    with pytest.raises(Exception, match="null a"):
        sparse_instances(raw.withColumn("a", F.lit(None).cast("double")), "label", ["a"]).collect()
