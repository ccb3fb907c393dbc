"""Weighted sparse instances: categories of any size beside numbers, fitted without dense rows.

An instance is (label, weight, indices, values): positions of the entries that are not zero. Blocks
hold rows compressed, so memory follows the entries and not the width; gradients are as wide as the
model and leave the tasks in pieces. Columns are scaled by their deviation, never centred, which
would fill them; the scaling is folded into the weights of the model.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfit.functions.features import column
from linfit.functions.scalar import sigmoid
from linfit.functions.vectors import known
from linfit.operators import kernels
from linfit.operators.moments import PARTIALS, part_sum, sum_partials
from linfit.operators.quasi_newton import descend

#: Numbers that one pass sends to and gathers from a task, or one point; more points take several passes.
PASS_NUMBERS = 1 << 20


def sparse_instances(
    df: DataFrame,
    label: str,
    numeric: Sequence[str] = (),
    categories: Sequence[tuple[str, int]] = (),
    weight: str | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """``(keys.., label, weight, indices array<int>, values array<double>)``.

    Numbers come first, then one position for each value of each category, given as an index
    column and the number of its values. An index that is null or out of range has no entry, and
    neither has a zero; a null number raises. Without ``weight`` every row weighs 1.
    """
    entries: list[Column] = []
    for i, name in enumerate(numeric):
        value = known(column(name).cast("double"), name)
        entries.append(F.struct(F.lit(i).alias("i"), value.alias("v")))
    at = len(numeric)
    for name, size in categories:
        index = column(name).cast("int")
        inside = (index >= 0) & (index < size)
        entries.append(
            F.struct((index + at).alias("i"), F.when(inside, 1.0).otherwise(0.0).alias("v"))
        )
        at += size
    kind = "array<struct<i:int,v:double>>"
    every = F.array(*entries).cast(kind) if entries else F.array().cast(kind)
    rows = df.select(
        *[column(k) for k in keys],
        column(label).cast("double").alias("label"),
        (column(weight).cast("double") if weight else F.lit(1.0)).alias("weight"),
        F.filter(every, lambda e: e["v"] != 0.0).alias("entries"),
    )
    return rows.select(
        *keys, "label", "weight", F.col("entries.i").alias("indices"), F.col("entries.v").alias("values")
    )


def sparse_width(numeric: Sequence[str] = (), categories: Sequence[tuple[str, int]] = ()) -> int:
    return len(numeric) + sum(size for _, size in categories)


@dataclass
class SparseModel:
    """Coefficients by position, on the scale of the instances."""

    theta: np.ndarray
    intercept: float
    losses: list[float] = field(default_factory=list)


def _inverse(sums: np.ndarray, width: int) -> np.ndarray:
    """Of each column's deviation; 0 for a column without any."""
    whole, squares = sums[-2], sums[-1]
    first, second = sums[:width], sums[width : 2 * width]
    free = whole - squares / whole
    variance = (second - first * first / whole) / free if free > 0 else np.zeros(width)
    deviation = np.sqrt(np.where(variance > 1e-14 * second / whole, variance, 0.0))
    return np.where(deviation > 0, 1.0 / np.where(deviation > 0, deviation, 1.0), 0.0)


def sparse_logistic_fit(
    instances: DataFrame,
    width: int,
    l2: float = 0.0,
    max_iter: int = 100,
    tol: float = 1e-6,
    standardize: bool = True,
) -> SparseModel:
    """Weighted logistic regression by quasi-Newton steps, one job a step.

    Minimises the weighted mean cross-entropy plus ``l2`` / 2 times the squared coefficients of
    scaled columns; the intercept is not penalised. A column without deviation stays at 0. Labels
    other than 0 and 1, weights that are null or negative, null arrays or entries, positions
    outside the width and an empty table raise; rows of weight 0 do not count.
    """
    if width < 1 or l2 < 0 or max_iter < 1 or not tol >= 0:
        raise ValueError("width and max_iter must be at least 1; l2 and tol must not be negative")
    rows = instances.select("label", "weight", "indices", "values")
    packed = rows.mapInArrow(kernels.sparse_packer(width), kernels.SPARSE_SCHEMA)
    packed = packed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        facts = packed.withColumn("at", F.spark_partition_id()).agg(
            F.sum("rows").alias("rows"),
            F.sum("unusable").alias("unusable"),
            (F.max("at") + 1).alias("partitions"),
        ).first()
        if not facts.rows:
            raise ValueError("no instances to fit on")
        if facts.unusable:
            raise ValueError(f"{facts.unusable} rows have an unusable label, weight or entry")
        blocks, total = packed.select("y", "w", "ends", "places", "at", "x"), part_sum()

        def add(kernel, rows: int, numbers: int) -> np.ndarray:
            """The sums of a pass, put together from the partials that ``sparse_chunks`` cut them into."""
            partials = blocks.mapInArrow(kernel, PARTIALS)
            out, each = np.zeros((rows, numbers)), -(-numbers // kernels.CHUNK)
            for batch in sum_partials(partials, facts.partitions, total).toArrow().to_batches():
                for fit, part in zip(batch.column("fit").to_pylist(), batch.column("part")):
                    i, start = fit // each, fit % each * kernels.CHUNK
                    out[i, start : start + len(part)] = part.values.to_numpy(zero_copy_only=False)
            return out

        sums = add(kernels.sparse_moments_pass(width), 1, 2 * width + 2)[0]
        whole = float(sums[-2])
        if whole <= 0:
            raise ValueError("all weights are 0")
        inverse = _inverse(sums, width) if standardize else np.ones(width)
        del sums

        together = max(1, PASS_NUMBERS // width)

        def evaluate(points: dict[int, list[np.ndarray]]):
            out = []
            for start in range(0, len(points[0]), together):
                trials = points[0][start : start + together]
                kernel = kernels.sparse_logistic_pass(np.stack([p[:-1] * inverse for p in trials]), np.array([p[-1] for p in trials]))
                for p, found in zip(trials, add(kernel, len(trials), width + 2), strict=True):
                    slope, level, loss = found[:width] * inverse, found[width], found[width + 1]
                    gradient = np.append(slope / whole + l2 * p[:-1], level / whole)
                    out.append((float(loss / whole + 0.5 * l2 * (p[:-1] @ p[:-1])), gradient))
            return {0: out}

        fit = descend([np.zeros(width + 1)], evaluate, max_iter, tol)[0]
    finally:
        packed.unpersist()
    return SparseModel(fit.point[:-1] * inverse, float(fit.point[-1]), list(fit.losses))


def sparse_predict(instances: DataFrame, model: SparseModel, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys.., label, prediction_prob)``; positions outside the model raise."""
    rows = instances.select(*[column(k) for k in keys], "label", "indices", "values")
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-2]]
    kernel = kernels.sparse_margins(model.theta, model.intercept)
    scored = rows.mapInArrow(kernel, ", ".join([*kinds, "margin double"]))
    return scored.select(*keys, "label", sigmoid(F.col("margin")).alias("prediction_prob"))
