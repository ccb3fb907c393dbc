"""Arithmetic on ``array<double>`` columns.

Everything is a native higher-order function, so a projection over any number of rows stays in
the JVM. Two-array operations raise on unequal lengths instead of padding or truncating.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Above this width a generated sum of scalar terms stops paying off against one array pass.
MAX_GENERATED_TERMS = 64


def doubles(a: Column) -> Column:
    return a.cast("array<double>")


def known(x: Column, what: str) -> Column:
    """``x``, or an error where it is null."""
    return F.coalesce(x, F.raise_error(F.lit(f"null {what}")).cast("double"))


def sized(a: Column, width: int, value: Column) -> Column:
    """``value`` where the vector ``a`` has ``width`` elements, an error for any other or null."""
    size = F.coalesce(F.size(a).cast("string"), F.lit("null"))
    message = F.concat_ws(" ", F.lit(f"expected feature vectors of {width}, not"), size)
    return F.when(F.size(a) == width, value).otherwise(F.raise_error(message))


def whole(a: Column) -> Column:
    """The vector ``a``, or an error where it is null or holds null."""
    broken = a.isNull() | F.exists(a, lambda x: x.isNull())
    return F.when(broken, F.raise_error(F.lit("null feature vector or element"))).otherwise(a)


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def _same_length(a: Column, b: Column, value: Column) -> Column:
    message = F.concat_ws(
        " ", F.lit("vectors differ in length:"), F.size(a).cast("string"), F.size(b).cast("string")
    )
    return F.when(F.size(a) == F.size(b), value).otherwise(F.raise_error(message))


def dot(a: Column, b: Column) -> Column:
    return _same_length(a, b, total(F.zip_with(a, b, lambda x, y: x * y)))


def scale(a: Column, factor: Column | float) -> Column:
    factor = F.lit(factor) if isinstance(factor, (int, float)) else factor
    return F.transform(a, lambda x: x * factor)


def add(a: Column, b: Column) -> Column:
    return _same_length(a, b, F.zip_with(a, b, lambda x, y: x + y))


def negate(a: Column) -> Column:
    return F.transform(a, lambda x: -x)


def norm_power(a: Column, order: int) -> Column:
    """Sum of |x|**order; no root is taken."""
    return total(F.transform(a, lambda x: F.pow(F.abs(x), F.lit(float(order)))))


def outer_packed(a: Column) -> Column:
    """Upper triangle of ``a aT`` by columns: (0,0), (0,1), (1,1), (0,2), ..."""
    return F.flatten(
        F.transform(a, lambda x, i: F.transform(F.slice(a, F.lit(1), i + 1), lambda y: x * y))
    )


def outer(a: Column, b: Column) -> Column:
    """Dense ``a bT`` by columns: all of ``a`` times b[0], then times b[1], ..."""
    return F.flatten(F.transform(b, lambda y: F.transform(a, lambda x: x * y)))


def dot_constant(a: Column, weights: Sequence[float]) -> Column:
    """``a . weights`` for weights known to the driver.

    Narrow vectors become a plain sum of products, which stays inside whole-stage codegen; wide
    ones fall back to one pass over the array.
    """
    w = [float(v) for v in weights]
    if not w:
        return F.lit(0.0)
    if len(w) <= MAX_GENERATED_TERMS:
        terms = [F.get(a, F.lit(i)) * F.lit(v) for i, v in enumerate(w)]
        value = reduce(lambda left, right: left + right, terms)
        message = F.concat_ws(
            " ", F.lit(f"expected a vector of {len(w)}, got"), F.size(a).cast("string")
        )
        return F.when(F.size(a) == len(w), value).otherwise(F.raise_error(message))
    return dot(a, F.array(*[F.lit(v) for v in w]))


def linear_projection(a: Column, rows: Sequence[Sequence[float]]) -> Column:
    """Matrix times vector for a matrix given by its rows."""
    return F.array(*[dot_constant(a, row) for row in rows])
