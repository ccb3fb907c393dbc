"""Sums over a whole table of vectors and of their products.

A symmetric matrix is a *moment table* ``(i int, j int, v double)`` with ``j <= i``. Whatever the
size of the input, only these d or d*d numbers leave the executors.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linfit.functions.features import column
from linfit.functions.vectors import doubles, known, sized, whole
from linfit.operators import kernels

# One generated sum per matrix entry stays inside one compiled aggregate up to about here.
MAX_GENERATED_SUMS = 66
# From this many partials on, they are added in two steps so that no single task reads them all.
TREE_PARTITIONS = 1024


# What a kernel emits; as an object, since a string would be parsed again for every pass.
PARTIALS = T.StructType(
    [
        T.StructField("fit", T.IntegerType()),
        T.StructField("part", T.ArrayType(T.DoubleType())),
    ]
)


def part_sum() -> Column:
    """Element-wise sum of ``part``; an iterative caller makes it once for all its passes.

    The summarizer keeps running means, so a sum of whole numbers may be off in the last bit.
    """
    return vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("part")


def sum_partials(partials: DataFrame, partitions: int = 0, total: Column | None = None) -> DataFrame:
    """Element-wise sum of ``part`` per ``fit``, in two steps for very many partitions.

    Where ``partials`` carry a ``width``, its ``low`` and ``high`` come along.
    """
    total = part_sum() if total is None else total
    low, high = "width", "width"
    if partitions > TREE_PARTITIONS:
        salt = F.spark_partition_id() % int(partitions**0.5)
        salted = partials.withColumn("salt", salt).groupBy("fit", "salt")
        if "width" in partials.columns:
            partials, low, high = salted.agg(total, F.min("width").alias("low"), F.max("width").alias("high")), "low", "high"
        else:
            partials = salted.agg(total)
    if not {"width", "low"} & set(partials.columns):
        return partials.groupBy("fit").agg(total)
    return partials.groupBy("fit").agg(total, F.min(low).alias("low"), F.max(high).alias("high"))


def likely_partitions(df: DataFrame) -> int:
    """At least the number of partitions that ``df`` has, judged by the planner's size, without a job."""
    spark = df.sparkSession
    conf = spark._jsparkSession.sessionState().conf()
    size = int(str(df._jdf.queryExecution().analyzed().stats().sizeInBytes()))
    return max(size // conf.filesMaxPartitionBytes() + 1, conf.numShufflePartitions(), spark.sparkContext.defaultParallelism)


def vector_sum(df: DataFrame, features: str = "features") -> DataFrame:
    """Element-wise sum of a vector column as ``(i, v)``."""
    return _by_index(df, features, Summarizer.sum)


def column_means(df: DataFrame, features: str = "features") -> DataFrame:
    """Element-wise mean of a vector column as ``(i, v)``."""
    return _by_index(df, features, Summarizer.mean)


def _by_index(df: DataFrame, features: str, summary) -> DataFrame:
    vector = array_to_vector(whole(doubles(column(features))))
    one = df.agg(vector_to_array(summary(vector)).alias("s"))
    return one.select(F.posexplode("s").alias("i", "v"))


def gram(
    df: DataFrame,
    features: str = "features",
    width: int | None = None,
    weight: Column | None = None,
    method: str = "auto",
) -> DataFrame:
    """Moment table of sum w x xT over all rows.

    With ``width`` known and small, every entry is one generated sum inside a compiled
    aggregate. Otherwise each partition multiplies its Arrow batches and emits one square. Either
    way a null vector, element or weight and a vector of another length raise.
    """
    if method not in ("auto", "generated", "arrow"):
        raise ValueError(f"unknown method {method!r}")
    if method == "generated" and width is None:
        raise ValueError("generated sums need the width")
    x = doubles(column(features))
    narrow = width is not None and width * (width + 1) // 2 <= MAX_GENERATED_SUMS
    if method == "generated" or (method == "auto" and narrow):
        return _gram_generated(df, x, width, weight)
    x = x if width is None else sized(x, width, x)
    inputs = [x.alias("x")]
    if weight is not None:
        inputs.append(known(weight.cast("double"), "weight").alias("w"))
    partials = df.select(*inputs).mapInArrow(kernels.gram_pass, PARTIALS)
    rows = sum_partials(partials.withColumn("width", F.get("part", F.lit(0))), likely_partitions(df))
    message = F.lit("feature vectors differ in length between partitions")
    row = F.when(F.col("low") == F.col("high"), F.slice("part", 2, 1 << 30)).otherwise(F.raise_error(message))
    return _entries(rows.select("fit", row.alias("part")))


def _entries(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("fit").alias("i"), F.posexplode("part").alias("j", "v"))


def _gram_generated(
    df: DataFrame, features: Column, width: int, weight: Column | None
) -> DataFrame:
    # The length check has to reach the result, or column pruning would drop it.
    checked = sized(F.col("x"), width, F.lit(0.0))
    w = known(weight.cast("double"), "weight") if weight is not None else F.lit(1.0)
    elements = [known(F.get("x", F.lit(i)), "feature").alias(f"x{i}") for i in range(width)]
    rows = df.select(features.alias("x"), w.alias("w"))
    rows = rows.select("w", checked.alias("checked"), *elements)
    pairs = [(i, j) for i in range(width) for j in range(i + 1)]
    sums = rows.agg(
        F.max("checked").alias("checked"),
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}") * F.col("w")).alias(f"m{i}_{j}") for i, j in pairs],
    )
    entries = [
        F.struct(
            F.lit(i).alias("i"),
            F.lit(j).alias("j"),
            (F.col(f"m{i}_{j}") + F.col("checked")).alias("v"),
        )
        for i, j in pairs
    ]
    return sums.select(F.inline(F.array(*entries)))


def normal_terms(
    df: DataFrame, features: str = "features", label: str = "label", width: int | None = None
) -> DataFrame:
    """Moment table of (features, label): XtX, then Xty as the last row, then yty, in one pass."""
    augmented = df.select(
        F.concat(doubles(column(features)), F.array(column(label).cast("double"))).alias("x")
    )
    return gram(augmented, "x", None if width is None else width + 1)


def xty(df: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """Sum of y x as ``(i, v)``."""
    products = F.transform(doubles(column(features)), lambda x: x * column(label).cast("double"))
    return vector_sum(df.select(products.alias("x")), "x")


def cross_moment(df: DataFrame, a: str, b: str) -> DataFrame:
    """Sum of a bT over two array columns as ``(i, j, v)``, i over ``a``, j over ``b``."""
    pair = df.select(doubles(column(a)).alias("a"), doubles(column(b)).alias("b"))
    partials = pair.mapInArrow(kernels.cross_pass, PARTIALS)
    return _entries(sum_partials(partials, likely_partitions(df)))


def merge_moments(*tables: DataFrame) -> DataFrame:
    """Sum of moment tables: the moments of the union of their rows."""
    union = reduce(DataFrame.unionAll, [t.select("i", "j", "v") for t in tables])
    return union.groupBy("i", "j").agg(F.sum("v").alias("v"))


def normalize_moments(moments: DataFrame, factor: Column | float) -> DataFrame:
    factor = F.lit(float(factor)) if isinstance(factor, (int, float)) else factor
    return moments.withColumn("v", F.col("v") * factor)


def ridge_penalty(moments: DataFrame, l2: float) -> DataFrame:
    """Add ``l2`` to the diagonal."""
    return moments.withColumn(
        "v", F.col("v") + F.when(F.col("i") == F.col("j"), F.lit(float(l2))).otherwise(F.lit(0.0))
    )


def collect_symmetric(moments: DataFrame) -> np.ndarray:
    """A moment table as a dense d x d matrix on the driver."""
    rows = moments.collect()
    d = 1 + max(r.i for r in rows)
    out = np.zeros((d, d))
    for r in rows:
        out[r.i, r.j] = out[r.j, r.i] = r.v
    return out
