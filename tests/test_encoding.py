import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array

from linfit.operators import encoding as E


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame([(w,) for w in "b b b a a c d d".split()], "w string")


def test_index_by_frequency_breaks_ties_by_value(words):
    assert E.fit_index(words, "w", "i").labels == ["b", "a", "d", "c"]


def test_index_by_vocabulary(spark, words):
    index = E.fit_index(words, "w", "i", ["d", "c", "b", "a"])
    got = {r.w: r.i for r in index.transform(words).collect()}
    assert got == {"d": 0.0, "c": 1.0, "b": 2.0, "a": 3.0}
    assert index.transform(spark.range(1)).columns == ["id"]
    with pytest.raises(Exception):
        E.fit_index(words, "w", "i", ["a"]).transform(words).collect()
    kept = E.fit_index(words, "w", "i", ["a"], "keep").transform(words)
    assert {r.i for r in kept.collect()} == {0.0, 1.0}


def test_one_hot_drops_the_last(words):
    out = E.one_hot(E.fit_index(words, "w", "i").transform(words), "i", "x")
    got = {r.w: r.x for r in out.collect()}
    assert got == {"b": [1, 0, 0], "a": [0, 1, 0], "d": [0, 0, 1], "c": [0, 0, 0]}


@pytest.mark.parametrize("width", [3, 70])
@pytest.mark.parametrize("mean, std", [(True, False), (False, True), (True, True)])
def test_scale_matches_library(spark, width, mean, std):
    x = np.random.default_rng(2).normal(2.0, 3.0, size=(200, width))
    x[:, 1] = 4.0
    df = spark.createDataFrame(
        [(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, features array<double>"
    )
    own = [r.scaled for r in E.scale(df, with_mean=mean, with_std=std).orderBy("id").collect()]
    vectors = df.select("id", array_to_vector("features").alias("v"))
    scaler = StandardScaler(inputCol="v", outputCol="o", withMean=mean, withStd=std)
    native = scaler.fit(vectors).transform(vectors).orderBy("id")
    expected = [r.o for r in native.select(vector_to_array("o").alias("o")).collect()]
    assert np.allclose(own, expected, rtol=1e-9, atol=1e-9)


def test_label_maps(spark):
    a, b = E.label_map(spark, ["x", "y"]), E.label_map(spark, ["y", "x"])
    assert E.label_map_difference(a, a).count() == 0
    rows = {tuple(r) for r in E.label_map_difference(a, b).collect()}
    assert rows == {("x", 0, "fitted"), ("y", 1, "fitted"), ("y", 0, "target"), ("x", 1, "target")}


def test_fitted_values(spark, binary):
    df = binary.select("label", array_to_vector("features").alias("v"))
    model = Pipeline(
        stages=[
            StandardScaler(inputCol="v", outputCol="features", withMean=True),
            LogisticRegression(maxIter=5),
        ]
    ).fit(df)
    rows = E.fitted_values(spark, model).collect()
    by_name = {}
    for r in rows:
        by_name.setdefault((r.stage, r.name), []).append(r.value)
    assert len(by_name[0, "mean"]) == len(by_name[1, "coefficient"]) == 3
    assert by_name[1, "objective"][0] > by_name[1, "objective"][-1]
