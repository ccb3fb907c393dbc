"""Numerically stable scalar maths as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PROBABILITY_FLOOR = 1e-15


def sigmoid(z: Column) -> Column:
    """1 / (1 + exp(-z)) without overflow: exp is only ever taken of a non-positive number."""
    shrunk = F.exp(-F.abs(z))
    return F.when(z < 0, shrunk / (1.0 + shrunk)).otherwise(1.0 / (1.0 + shrunk))


def log1p_exp(x: Column) -> Column:
    """log(1 + exp(x)) without overflow."""
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def binary_log_loss(z: Column, label: Column) -> Column:
    """Cross-entropy of one row at margin ``z``; label 1.0 is positive, anything else negative."""
    return log1p_exp(F.when(label == 1.0, -z).otherwise(z))


def clip_probability(p: Column, floor: float = PROBABILITY_FLOOR) -> Column:
    """``p`` within the floor of 0 and 1; null and NaN stay, which least and greatest would hide."""
    clipped = F.greatest(F.least(p, F.lit(1.0 - floor)), F.lit(floor))
    return F.when(p.isNull() | F.isnan(p), p).otherwise(clipped)
