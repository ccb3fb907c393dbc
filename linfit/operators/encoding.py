"""Fitted transformers: scaling, category indexing, one-hot, and reading fitted stages back."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScalerModel,
    StringIndexer,
    StringIndexerModel,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegressionModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linfit.functions.features import column
from linfit.functions.vectors import MAX_GENERATED_TERMS, doubles, known, sized, whole


@dataclass
class Scaling:
    """Per-feature mean and sample deviation of a training table."""

    mean: list[float]
    std: list[float]

    def apply(self, features: Column | str, with_mean: bool, with_std: bool) -> Column:
        """Centre and/or divide; a feature without spread is scaled to 0.0.

        A null vector or element and a vector of another length raise.
        """
        x = doubles(column(features) if isinstance(features, str) else features)
        shift = self.mean if with_mean else [0.0] * len(self.mean)
        factor = [(1.0 / s if s else 0.0) if with_std else 1.0 for s in self.std]
        if len(shift) <= MAX_GENERATED_TERMS:
            scaled = F.array(
                *[
                    (known(F.get(x, F.lit(i)), "feature") - F.lit(m)) * F.lit(f)
                    for i, (m, f) in enumerate(zip(shift, factor))
                ]
            )
            return sized(x, len(shift), scaled)
        pairs = F.arrays_zip(
            F.array(*[F.lit(m) for m in shift]).alias("m"),
            F.array(*[F.lit(f) for f in factor]).alias("f"),
        )
        scaled = F.zip_with(
            x, pairs, lambda v, p: (known(v, "feature") - p["m"]) * p["f"]
        )
        return sized(x, len(shift), scaled)


def fit_scaling(df: DataFrame, features: str = "features") -> Scaling:
    """One pass; one row of d-sized vectors comes back."""
    summary = Summarizer.metrics("mean", "std").summary(
        array_to_vector(whole(doubles(column(features))))
    )
    row = df.agg(summary.alias("s")).select("s.mean", "s.std").first()
    return Scaling([float(v) for v in row["mean"]], [float(v) for v in row["std"]])


def scale(
    df: DataFrame,
    features: str = "features",
    out: str = "scaled",
    with_mean: bool = False,
    with_std: bool = True,
) -> DataFrame:
    """Fit on ``df`` and apply to ``df``."""
    fitted = fit_scaling(df, features)
    return df.withColumn(out, fitted.apply(features, with_mean, with_std))


def fit_index(
    df: DataFrame,
    category: str,
    out: str,
    vocabulary: Sequence[str] = (),
    handle_invalid: str = "error",
) -> StringIndexerModel:
    """Category to number: by the given vocabulary's order, else by falling frequency.

    Equal frequencies are ordered by value. Frequencies are counted per partition before the
    shuffle, so a category holding most of the rows costs nothing extra. Only the distinct
    values, the model itself, reach the driver. A fitted index passes over tables that lack the
    input column, so an unlabelled table can go through the same stages.
    """
    if vocabulary:
        return StringIndexerModel.from_labels(
            list(vocabulary), inputCol=category, outputCol=out, handleInvalid=handle_invalid
        )
    return StringIndexer(inputCol=category, outputCol=out, handleInvalid=handle_invalid).fit(df)


def one_hot(df: DataFrame, index: str, out: str) -> DataFrame:
    """Index to array<double> of 0/1 with the last category left out as all zeros."""
    fitted = OneHotEncoder(inputCol=index, outputCol="_one_hot").fit(df)
    encoded = fitted.transform(df)
    return encoded.withColumn(out, vector_to_array("_one_hot")).drop("_one_hot")


def label_map(spark: SparkSession, labels: Sequence[str]) -> DataFrame:
    """``(value, idx)`` of an index's labels."""
    return spark.createDataFrame(
        [(v, i) for i, v in enumerate(labels)], schema="value string, idx int"
    )


def label_map_difference(fitted: DataFrame, target: DataFrame) -> DataFrame:
    """Entries that only one of two label maps has, with the side they are on."""
    return (
        fitted.exceptAll(target)
        .withColumn("side", F.lit("fitted"))
        .unionAll(target.exceptAll(fitted).withColumn("side", F.lit("target")))
    )


def fitted_values(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """What a fitted pipeline learned, as ``(stage, name, idx, value, label)`` rows."""
    rows: list[tuple[int, str, int, float | None, str | None]] = []

    def put(stage: int, name: str, values: Sequence[float]) -> None:
        rows.extend((stage, name, i, float(v), None) for i, v in enumerate(values))

    for at, stage in enumerate(model.stages):
        if isinstance(stage, StandardScalerModel):
            put(at, "mean", stage.mean)
            put(at, "std", stage.std)
        elif isinstance(stage, StringIndexerModel):
            rows.extend((at, "label", i, None, v) for i, v in enumerate(stage.labels))
        elif isinstance(stage, LinearRegressionModel):
            put(at, "coefficient", stage.coefficients)
            put(at, "intercept", [stage.intercept])
            put(at, "reg_param", [stage.getRegParam()])
            if stage.hasSummary:
                put(at, "rmse", [stage.summary.rootMeanSquaredError])
        elif isinstance(stage, LogisticRegressionModel):
            put(at, "coefficient", stage.coefficientMatrix.toArray().ravel())
            put(at, "intercept", stage.interceptVector)
            put(at, "reg_param", [stage.getRegParam()])
            if stage.hasSummary:
                put(at, "objective", stage.summary.objectiveHistory)
    return spark.createDataFrame(
        rows, schema="stage int, name string, idx int, value double, label string"
    )
