import math

import numpy as np
import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from linfit.operators import metrics as S


def test_confusion_and_scores(spark):
    counts = spark.createDataFrame(
        [(100, 10, 50, 5)],
        "true_positive long, true_negative long, false_positive long, false_negative long",
    )
    row = S.binary_scores(counts).first()
    assert (row.accuracy, row.precision, row.recall) == (110 / 165, 100 / 150, 100 / 105)
    assert S.score(100, 10, 50, 5) == 110 / 165
    assert S.score(100, 10, 50, 5, "precision") == 100 / 150
    assert S.score(100, 10, 50, 5, "recall") == 100 / 105
    assert S.score(0, 3, 0, 1, "precision") is None
    with pytest.raises(ValueError):
        S.score(1, 1, 1, 1, "f1")


def test_confusion_counts_every_row(spark):
    rows = [(1.0, 1.0)] * 3 + [(0.0, 0.0)] * 2 + [(0.0, 1.0)] * 4 + [(1.0, 0.0)] + [(7.0, 0.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    row = S.confusion_matrix(df).first()
    assert tuple(row) == (3, 2, 4, 2) or sum(row) == len(rows)
    assert sum(row) == len(rows)


def test_no_predicted_positives_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "label double, prediction double")
    row = S.binary_scores(S.confusion_matrix(df)).first()
    assert row.precision is None and row.recall == 0.0


def test_cross_entropy_clips(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0])], "label int, probability array<double>")
    got = S.multiclass_cross_entropy(df).first().cross_entropy
    assert got == pytest.approx(-math.log(1e-15))
    with pytest.raises(ValueError):
        S.multiclass_cross_entropy(df, label="nothing")
    with pytest.raises(Exception, match="outside the classes"):
        S.multiclass_cross_entropy(df.withColumn("label", F.lit(-1))).collect()
    with pytest.raises(TypeError):
        S.multiclass_cross_entropy(df.withColumn("probability", array_to_vector("probability")))


def test_cross_entropy_equals_library(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet(np.ones(4), size=300)
    df = spark.createDataFrame(
        [(float(rng.integers(4)), [float(v) for v in r]) for r in p],
        "label double, probability array<double>",
    )
    vectors = df.withColumn("probability", array_to_vector("probability")).withColumn(
        "prediction", F.lit(0.0)
    )
    native = MulticlassClassificationEvaluator(metricName="logLoss", eps=1e-15).evaluate(vectors)
    assert S.multiclass_cross_entropy(df).first().cross_entropy == pytest.approx(native, rel=1e-12)


def test_accuracy_and_auc(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, 0.9), (0.0, 1.0, 0.5), (1.0, 0.0, 0.5), (0.0, 0.0, 0.1)],
        "label double, prediction double, score double",
    )
    assert S.multiclass_accuracy(df).first().accuracy == 0.5
    assert S.area_under_roc(df) == pytest.approx(3.5 / 4)


@pytest.mark.parametrize("digits", [1, 6])
def test_auc_equals_library(spark, digits):
    """Coarse scores make many ties; a third of all rows share one score."""
    rng = np.random.default_rng(9)
    y = (rng.random(3000) < 0.4).astype(float)
    s = np.round(y * 0.3 + rng.random(3000), digits)
    s[::3] = 0.5
    df = spark.createDataFrame(
        [(float(a), float(b)) for a, b in zip(y, s)], "label double, score double"
    ).repartition(6)
    native = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert S.area_under_roc(df) == pytest.approx(native, rel=1e-12)


def test_auc_rejects_one_class_and_nulls(spark):
    df = spark.createDataFrame([(1.0, 0.2), (1.0, 0.3)], "label double, score double")
    with pytest.raises(ValueError, match="both classes"):
        S.area_under_roc(df)
    with pytest.raises(Exception, match="null score"):
        S.area_under_roc(df.withColumn("score", F.lit(None).cast("double")))
