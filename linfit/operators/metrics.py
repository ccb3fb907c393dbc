"""Scores of predictions. All are ordinary aggregates: no row leaves the executors."""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linfit.functions.features import cast_label, column
from linfit.functions.scalar import clip_probability
from linfit.functions.vectors import known, whole
from linfit.operators import kernels

SCORE_TYPES = ("accuracy", "precision", "recall")


def confusion_matrix(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row of counts; a row that is none of TP, TN, FN counts as FP, a null raises."""
    said = known(column(prediction).cast("double"), "prediction")
    truth = known(column(label).cast("double"), "label")
    kind = (
        F.when((said == 1.0) & (truth == 1.0), "tp")
        .when((said == 0.0) & (truth == 0.0), "tn")
        .when((said == 0.0) & (truth == 1.0), "fn")
        .otherwise("fp")
    )
    return predictions.agg(
        F.count_if(kind == "tp").alias("true_positive"),
        F.count_if(kind == "tn").alias("true_negative"),
        F.count_if(kind == "fp").alias("false_positive"),
        F.count_if(kind == "fn").alias("false_negative"),
    )


def score_columns() -> dict[str, Column]:
    """Accuracy, precision and recall over confusion columns; 0/0 is null."""
    tp, tn, fp, fn = (
        F.col(c).cast("double")
        for c in ("true_positive", "true_negative", "false_positive", "false_negative")
    )
    return {
        "accuracy": F.try_divide(tp + tn, tp + tn + fp + fn),
        "precision": F.try_divide(tp, tp + fp),
        "recall": F.try_divide(tp, tp + fn),
    }


def binary_scores(confusion: DataFrame) -> DataFrame:
    """``(accuracy, precision, recall)`` per row of counts."""
    return confusion.select(*[value.alias(name) for name, value in score_columns().items()])


def score(tp: int, tn: int, fp: int, fn: int, score_type: str = "accuracy") -> float | None:
    """One score of counts already on the driver; None for 0/0."""
    over = {
        "accuracy": (tp + tn, tp + tn + fp + fn),
        "precision": (tp, tp + fp),
        "recall": (tp, tp + fn),
    }
    if score_type not in over:
        raise ValueError(f"unknown score {score_type!r}: use one of {', '.join(SCORE_TYPES)}")
    part, whole = over[score_type]
    return part / whole if whole else None


def rmse(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row ``rmse``; a null label or prediction raises."""
    off = known((column(label) - column(prediction)).cast("double"), "label or prediction")
    return predictions.agg(F.sqrt(F.avg(off * off)).alias("rmse"))


def multiclass_accuracy(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row ``accuracy``; a null label or prediction raises."""
    hit = known((column(prediction) == column(label)).cast("double"), "label or prediction")
    return predictions.agg(F.avg(hit).alias("accuracy"))


def multiclass_cross_entropy(
    predictions: DataFrame, label: str = "label", probability: str = "probability"
) -> DataFrame:
    """One row ``cross_entropy``: mean of -log of the true class's clipped probability.

    ``probability`` is an array column, one entry per class. A label outside it and a null raise;
    of a NaN the mean is NaN.
    """
    for name in (label, probability):
        if name not in predictions.columns:
            raise ValueError(f"no column {name!r}")
    if not isinstance(predictions.schema[probability].dataType, T.ArrayType):
        raise TypeError(f"{probability!r} must be an array; convert with vector_to_array")
    at, p = cast_label(column(label)), column(probability)
    inside = (at >= 0) & (at < F.size(p))
    chosen = F.when(inside, F.get(p, at)).otherwise(
        F.raise_error(F.concat_ws(" ", F.lit("label outside the classes:"), at.cast("string")))
    )
    chosen = known(chosen.cast("double"), "probability of the true class")
    return predictions.agg(F.avg(-F.ln(clip_probability(chosen))).alias("cross_entropy"))


def area_under_roc(
    predictions: DataFrame, label: str = "label", score: str = "score", rows: str | None = None
) -> float:
    """Exact area under the ROC curve: the share of (positive, negative) pairs ranked right.

    Rows are first counted per score, so a score that many rows share is one row from there on.
    Distinct scores are dealt out by range; every partition counts its own pairs and reports one
    row, and a partition's positives also beat all negatives of the partitions below. A row counts
    as often as ``rows`` says, where that is given.
    """
    positive = known((column(label) == 1.0).cast("double"), "label")
    value = column(score).cast("double")
    value = F.when(value.isNotNull() & ~F.isnan(value), value).otherwise(
        F.raise_error(F.lit("null score or not a number"))
    )
    times = known(column(rows).cast("double"), "count") if rows else F.lit(1.0)
    each = predictions.select(value.alias("score"), (positive * times).alias("pos"), times.alias("n"))
    counts = each.groupBy("score").agg(
        F.sum("pos").alias("pos"), F.sum(F.col("n") - F.col("pos")).alias("neg")
    )
    ranged = counts.repartitionByRange("score").sortWithinPartitions("score")
    parts = ranged.mapInArrow(
        kernels.roc_pass, "lowest double, pos double, neg double, area double"
    ).collect()
    pairs = negatives = 0.0
    for part in sorted(parts, key=lambda r: r.lowest):
        pairs += part.area + part.pos * negatives
        negatives += part.neg
    whole = sum(r.pos for r in parts) * negatives
    if not whole:
        raise ValueError("the area needs rows of both classes")
    return pairs / whole


def areas_under_roc(
    predictions: DataFrame, scores: str = "scores", label: str = "label"
) -> list[float]:
    """``area_under_roc`` of every position of an array column of scores, in one job.

    Rows are counted by (position, score) before anything is sorted. All arrays must be of one
    length; a null label, array or score raises.
    """
    positive = known((column(label) == 1.0).cast("double"), "label")
    each = predictions.select(
        positive.alias("pos"),
        F.posexplode(whole(column(scores).cast("array<double>"))).alias("fit", "score"),
    )
    value = F.when(F.col("score").isNotNull() & ~F.isnan("score"), F.col("score")).otherwise(
        F.raise_error(F.lit("null score or not a number"))
    )
    rows = each.select("fit", value.alias("score"), "pos", (1.0 - F.col("pos")).alias("neg"))
    found = ranked_areas(rows)
    if len({whole for _, whole in found.values()}) > 1:
        raise ValueError("arrays of scores differ in length")
    if any(area is None for area, _ in found.values()) or not found:
        raise ValueError("the area needs rows of both classes")
    return [found[i][0] for i in range(len(found))]


def ranked_areas(rows: DataFrame) -> dict[int, tuple[float | None, float]]:
    """By fit the ROC area and the number of rows, of (fit int, score, pos, neg) counts.

    (fit, score) counts are dealt out by range, so one fit's scores may lie in several partitions
    and a partition may end one fit and begin another; each reports one row of pair counts for
    each fit it holds. A fit whose rows are all of one class has no area.
    """
    counts = rows.groupBy("fit", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    ranged = counts.repartitionByRange("fit", "score").sortWithinPartitions("fit", "score")
    parts = ranged.mapInArrow(
        kernels.roc_many_pass, "fit int, lowest double, pos double, neg double, area double"
    ).collect()
    sums: dict[int, list[float]] = {}
    for part in sorted(parts, key=lambda r: (r.fit, r.lowest)):
        own = sums.setdefault(part.fit, [0.0, 0.0, 0.0])
        own[0] += part.area + part.pos * own[2]
        own[1] += part.pos
        own[2] += part.neg
    return {i: (pairs / (p * n) if p * n else None, p + n) for i, (pairs, p, n) in sums.items()}


class AreaUnderRoc(Evaluator):
    """``area_under_roc`` of the raw prediction, for the library's search."""

    def __init__(
        self, label: str = "label", raw_prediction: str = "rawPrediction", rows: str | None = None
    ) -> None:
        super().__init__()
        self.label, self.raw_prediction, self.rows = label, raw_prediction, rows

    def _evaluate(self, dataset: DataFrame) -> float:
        margin = vector_to_array(column(self.raw_prediction))[1]
        rows = dataset.select(
            column(self.label).alias("label"),
            margin.alias("score"),
            *([column(self.rows).alias("rows")] if self.rows else []),
        )
        return area_under_roc(rows, rows="rows" if self.rows else None)

    def isLargerBetter(self) -> bool:
        return True
