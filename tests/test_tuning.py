import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.functions import array_to_vector

from linfit.functions.features import polynomial
from linfit.operators.logistic import logistic_fit, logistic_predict
from linfit.operators.metrics import AreaUnderRoc, binary_scores, confusion_matrix
from linfit.operators.resample import fold_pairs, with_fold
from linfit.plans import tuning as T

GRID = [(1, 5.0), (2, 0.0)]


@pytest.fixture(scope="module")
def folded(binary):
    return with_fold(binary, ["id"], 3).cache()


@pytest.mark.parametrize("method, rate", [("gradient", 4e-4), ("newton", 1.0)])
def test_shared_passes_equal_separate_fits(folded, method, rate):
    """Every fold and grid point fitted alone, on expanded columns, scored with plain operators."""
    options = dict(method=method, max_iter=3, learning_rate=rate)
    result = T.cross_validate_logistic(folded, k=3, grid=GRID, **options)
    got = {(r["degree"], r["lambda"], r["fold"]): r["score"] for r in result.folds().collect()}
    assert len(got) == 6
    for degree, l2 in GRID:
        expanded = folded.withColumn("features", polynomial("features", 3, degree))
        for fold, (train, test) in enumerate(fold_pairs(expanded, 3)):
            model = logistic_fit(train, l2=l2, **options)
            scores = binary_scores(confusion_matrix(logistic_predict(test, model))).first()
            assert got[degree, l2, fold] == pytest.approx(scores.accuracy, abs=1e-12)
    best = folded.withColumn("features", polynomial("features", 3, result.best[0]))
    refit = logistic_fit(best, l2=result.best[1], **options)
    assert np.allclose(result.model.theta, refit.theta, rtol=1e-8)
    assert result.model.intercept == pytest.approx(refit.intercept, rel=1e-8)
    held = T.score_best(folded, result).first()
    direct = binary_scores(confusion_matrix(logistic_predict(best, refit))).first()
    assert held.accuracy == direct.accuracy


def test_a_subset_of_the_grid_is_searched_as_given(folded):
    result = T.cross_validate_logistic(
        folded, k=3, grid=[(1, 0.5), (2, 0.0)], max_iter=2, learning_rate=1e-4
    )
    points = {(r["degree"], r["lambda"]) for r in result.scores().collect()}
    assert points == {(1, 0.5), (2, 0.0)}


def test_hot_fold_is_still_exact(folded):
    """Two thirds of all rows in one fold: nothing is dropped and nothing moves."""
    from pyspark.sql import functions as F

    skewed = folded.withColumn("fold", F.when(F.col("id") % 3 < 2, 0).otherwise(1))
    result = T.cross_validate_logistic(
        skewed, k=2, grid=[(1, 0.0)], max_iter=3, learning_rate=4e-4
    )
    got = {r["fold"]: r["score"] for r in result.folds().collect()}
    for fold, (train, test) in enumerate(fold_pairs(skewed, 2)):
        model = logistic_fit(train, max_iter=3, learning_rate=4e-4)
        scores = binary_scores(confusion_matrix(logistic_predict(test, model))).first()
        assert got[fold] == pytest.approx(scores.accuracy, abs=1e-12)


def test_means_and_best(spark):
    rows = [(1, 0.1, 0, 0.5), (1, 0.1, 1, 0.7), (2, 0.1, 0, 0.6), (2, 0.1, 1, 0.6),
            (1, 0.5, 0, None), (1, 0.5, 1, 1.0)]
    folds = spark.createDataFrame(rows, T.SCORE_SCHEMA)
    means = T.mean_scores(folds, 2)
    got = {(r["degree"], r["lambda"]): r.score for r in means.collect()}
    assert got == {(1, 0.1): pytest.approx(0.6), (2, 0.1): pytest.approx(0.6), (1, 0.5): None}
    tied = spark.createDataFrame(
        [(2, 0.1, 0.6), (1, 0.5, 0.6), (1, 0.1, 0.6), (1, 0.0, None)],
        "degree int, lambda double, score double",
    )
    assert tuple(T.best_score(tied).first()) == (1, 0.1, 0.6)


def test_grid_rules(folded):
    assert T.param_grid((1, 2), (0.1, 0.5)) == [(1, 0.1), (1, 0.5), (2, 0.1), (2, 0.5)]
    for bad in ([(0, 0.1)], [(1, -0.1)], []):
        with pytest.raises(ValueError):
            T.check_grid(bad)
    for bad in (dict(k=1), dict(threshold=0.0), dict(score_type="f1"), dict(max_iter=0)):
        with pytest.raises(ValueError):
            T.cross_validate_logistic(folded, **bad)


def test_library_search(spark, folded):
    df = folded.select("label", "fold", array_to_vector("features").alias("features"))
    expand = PolynomialExpansion(inputCol="features", outputCol="terms")
    fit = LogisticRegression(featuresCol="terms", maxIter=20)
    model = T.cross_validate_native(
        df, [expand, fit], [(expand.degree, [1, 2])], AreaUnderRoc(), 3, fold="fold"
    )
    scores = T.native_scores(spark, model).orderBy("point").collect()
    assert [s.params for s in scores] == ["degree=1", "degree=2"]
    assert scores[1].score > scores[0].score > 0.7
    assert model.bestModel.stages[0].getDegree() == 2
