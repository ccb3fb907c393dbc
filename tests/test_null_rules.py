"""One rule at every width: a null vector, element, label or another length raises."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from linfit.functions.scalar import clip_probability
from linfit.operators import logistic as L
from linfit.operators.encoding import Scaling, fit_scaling
from linfit.operators.linear import LinearModel, linear_predict, ridge_fit
from linfit.operators.metrics import (
    area_under_roc,
    confusion_matrix,
    multiclass_accuracy,
    multiclass_cross_entropy,
    rmse,
)
from linfit.operators.moments import column_means, gram, vector_sum
from linfit.plans.tuning import CVResult, score_best

WIDTHS = (2, 64, 65, 100)
SHAPE = "label double, features array<double>"


def table(spark, width, bad):
    good = [(float(i % 2), [float(i + j) for j in range(width)]) for i in range(6)]
    rows = {
        "element": (1.0, [None] + [1.0] * (width - 1)),
        "vector": (1.0, None),
        "long": (1.0, [1.0] * (width + 1)),
        "label": (None, [1.0] * width),
    }
    return spark.createDataFrame([*good, rows[bad]], SHAPE)


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("bad", ["element", "vector", "long"])
def test_bad_vectors_raise(spark, width, bad):
    df = table(spark, width, bad)
    theta = [0.1] * width
    model = L.LogisticModel(theta, 0.0, [])
    runs = [
        lambda: L.fused_gradient_loss(df, theta).collect(),
        lambda: L.logloss_gradient(df, theta).collect(),
        lambda: L.binary_cross_entropy(df, theta).collect(),
        lambda: L.logistic_hessian(df, theta).collect(),
        lambda: L.logistic_predict(df, model).collect(),
        lambda: linear_predict(df, LinearModel(theta)).collect(),
        lambda: gram(df, width=width).collect(),
        lambda: gram(df).collect(),
        lambda: ridge_fit(df, l2=1.0, width=width),
        lambda: vector_sum(df).collect(),
        lambda: column_means(df).collect(),
        lambda: fit_scaling(df),
        lambda: df.select(Scaling([0.0] * width, [1.0] * width).apply("features", True, True)).collect(),
    ]
    for run in runs:
        with pytest.raises(Exception, match="null feature|feature vectors|vector of|ength|imension"):
            run()


@pytest.mark.parametrize("width", WIDTHS)
def test_null_labels_raise(spark, width):
    df = table(spark, width, "label")
    for run in (
        lambda: L.fused_gradient_loss(df, [0.1] * width).collect(),
        lambda: L.binary_cross_entropy(df, [0.1] * width).collect(),
        lambda: ridge_fit(df, l2=1.0, width=width),
    ):
        with pytest.raises(Exception, match="null"):
            run()


def test_scores_of_nulls_raise(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, None)], "label double, prediction double")
    for score in (confusion_matrix, rmse, multiclass_accuracy):
        with pytest.raises(Exception, match="null"):
            score(df).collect()
        with pytest.raises(Exception, match="null"):
            score(df, "prediction", "label").collect()


def test_cross_entropy_of_null_nan_zero_and_one(spark):
    def entropy(p):
        df = spark.createDataFrame([(0.0, p)], "label double, probability array<double>")
        return multiclass_cross_entropy(df).first()[0]

    assert np.isnan(entropy([float("nan"), 0.5]))
    assert entropy([1.0, 0.0]) == pytest.approx(0.0, abs=1e-12)
    assert entropy([0.0, 1.0]) == pytest.approx(-np.log(1e-15))
    with pytest.raises(Exception, match="null probability"):
        entropy([None, 1.0])
    row = spark.range(1).select(clip_probability(F.lit(None).cast("double")).alias("p")).first()
    assert row.p is None


def test_area_of_nan_raises(spark):
    df = spark.createDataFrame([(1.0, 0.5), (0.0, float("nan"))], "label double, score double")
    with pytest.raises(Exception, match="not a number"):
        area_under_roc(df)


def test_wide_winner_is_scored(spark, binary):
    """28 features of degree 3: thousands of terms, and the same counts as on columns."""
    rng = np.random.default_rng(1)
    terms = L.graded_terms(28, 3)
    order = L.monomials(28, 3)
    theta = rng.normal(size=len(order)) / 50
    model = L.LogisticModel(theta.tolist(), 0.1, [])
    x = rng.normal(size=(50, 28))
    rows = [(float(i % 2), x[i].tolist()) for i in range(50)]
    result = CVResult(spark, [], 3, 28, (3, 0.0), model)
    row = score_best(spark.createDataFrame(rows, SHAPE), result).first()
    at = dict(zip(order, theta))
    said = [sum(at[t] * np.prod(v[list(t)]) for t in terms) + 0.1 >= 0 for v in x]
    assert row.true_positive == sum(s and i % 2 for i, s in enumerate(said))
    assert row.true_negative == sum(not s and not i % 2 for i, s in enumerate(said))


def test_newton_is_bounded(spark, binary, monkeypatch):
    monkeypatch.setattr(L, "HESSIAN_BYTES", 70)
    with pytest.raises(ValueError, match="use gradient descent"):
        L.logistic_fit(binary, method="newton")
    monkeypatch.setattr(L, "HESSIAN_BYTES", 170)
    fits = {i: L.Fit(L.graded_terms(3, 1)) for i in range(3)}
    assert [len(b) for b in L._batches(fits, True)] == [2, 1]
