import numpy as np
import pytest
from pyspark.sql import functions as F

from linfit.operators import moments as M


@pytest.fixture(scope="module")
def table(spark):
    x = np.random.default_rng(3).normal(size=(500, 5))
    w = np.abs(x[:, 0]) + 0.1
    df = spark.createDataFrame(
        [([float(v) for v in r], float(s)) for r, s in zip(x, w)], "features array<double>, w double"
    ).repartition(5)
    return df, x, w


def dense(rows, d, k=None):
    out = np.zeros((d, k or d))
    for r in rows.collect():
        out[r.i, r.j] = r.v
    return out


@pytest.mark.parametrize("method", ["generated", "arrow"])
@pytest.mark.parametrize("weighted", [False, True])
def test_gram_paths_agree_with_numpy(table, method, weighted):
    df, x, w = table
    weight = F.col("w") if weighted else None
    got = M.collect_symmetric(M.gram(df, width=5, weight=weight, method=method))
    expected = (x * (w[:, None] if weighted else 1.0)).T @ x
    assert np.allclose(got, expected, rtol=1e-12)


def test_gram_emits_lower_triangle_only(table):
    df, *_ = table
    assert all(r.j <= r.i for r in M.gram(df).collect())
    assert M.gram(df).count() == 15


def test_gram_arguments(table):
    df, *_ = table
    with pytest.raises(ValueError):
        M.gram(df, method="other")
    with pytest.raises(ValueError):
        M.gram(df, method="generated")
    with pytest.raises(Exception, match="expected feature vectors of 4"):
        M.gram(df, width=4).collect()


def test_ragged_rows_raise(spark):
    df = spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "features array<double>").coalesce(1)
    with pytest.raises(Exception, match="differ in length"):
        M.gram(df).collect()


def test_sums_and_means(table):
    df, x, _ = table
    sums = [r.v for r in M.vector_sum(df).orderBy("i").collect()]
    means = [r.v for r in M.column_means(df).orderBy("i").collect()]
    assert np.allclose(sums, x.sum(0)) and np.allclose(means, x.mean(0))


def test_normal_terms_and_xty(table):
    df, x, w = table
    got = M.collect_symmetric(M.normal_terms(df, label="w", width=5))
    full = np.column_stack([x, w])
    assert np.allclose(got, full.T @ full)
    assert np.allclose([r.v for r in M.xty(df, label="w").orderBy("i").collect()], x.T @ w)


def test_cross_moment(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [2.0, 3.0])], "a array<double>, b array<double>")
    assert dense(M.cross_moment(df, "a", "b"), 3, 2).tolist() == [[2, 3], [4, 6], [6, 9]]


def test_merge_normalize_penalise(spark):
    m = spark.createDataFrame(
        [(0, 0, 1.0), (1, 0, 2.0), (1, 1, 5.0)], "i int, j int, v double"
    )
    merged = M.merge_moments(m, m, m)
    assert dense(merged, 2).tolist() == [[3, 0], [6, 15]]
    assert dense(M.normalize_moments(m, 2), 2).tolist() == [[2, 0], [4, 10]]
    assert dense(M.ridge_penalty(m, 1.0), 2).tolist() == [[2, 0], [2, 6]]


def test_tree_sum_equals_flat_sum(spark):
    rows = [(i % 3, [float(i), 1.0]) for i in range(300)]
    df = spark.createDataFrame(rows, "fit int, part array<double>").repartition(20)
    flat = {r.fit: r.part for r in M.sum_partials(df).collect()}
    tree = {r.fit: r.part for r in M.sum_partials(df, M.TREE_PARTITIONS + 1).collect()}
    assert flat.keys() == tree.keys() == {0, 1, 2}
    for k in flat:
        assert np.allclose(flat[k], tree[k]) and tree[k][1] == pytest.approx(100)
