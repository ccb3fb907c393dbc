"""Bootstrap aggregation: many replicates of a fit in the passes of one.

A replicate counts each row as often as a Poisson draw of mean 1 says, the limit of drawing n rows
with replacement. The draw is a function of the row's key and the replicate's number, so nothing is
moved or copied, and a lost block draws the same again. Draws stand beside the cached blocks, one
byte a replicate; all replicates advance in one job an iteration.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import exp, factorial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfit.functions.features import column
from linfit.functions.scalar import PROBABILITY_FLOOR
from linfit.functions.vectors import doubles
from linfit.operators import kernels
from linfit.operators.instances import pack_blocks
from linfit.operators.logistic import Fit, LogisticModel, check_fit_parameters, fit_many, graded_terms
from linfit.operators.moments import PARTIALS, sum_partials
from linfit.operators.resample import BUCKETS, HASHES

#: Hashes from the k-th of these on draw a row more than k times. A count beyond the last one has
#: a chance below 2**-32.
POISSON = tuple(
    int(BUCKETS * exp(-1.0) * sum(1.0 / factorial(i) for i in range(k + 1))) for k in range(12)
)

#: Replicates whose draws are written out one by one.
MAX_GENERATED_DRAWS = 32


def replicate_bucket(keys: Sequence[str], replicate: Column, hash_fn: str = "xxhash64") -> Column:
    """A number in [0, 2**32) that depends on the key values and the replicate alone.

    As ``key_bucket``, with the replicate's number as the last value.
    """
    if hash_fn == "xxhash64":
        return F.pmod(F.xxhash64(*(column(k) for k in keys), replicate.cast("long")), F.lit(BUCKETS))
    if hash_fn == "md5":
        return F.conv(F.substring(F.md5(_key_text(keys, replicate)), 1, 8), 16, 10).cast("long")
    raise ValueError(f"unknown hash {hash_fn!r}: use one of {', '.join(HASHES)}")


def _key_text(keys: Sequence[str], replicate: Column) -> Column:
    columns = [*(column(k) for k in keys), replicate.cast("long")]
    return F.concat_ws("|", *[c.cast("string") for c in columns]).cast("binary")


def poisson_draws(keys: Sequence[str], replicates: int, hash_fn: str = "xxhash64") -> Column:
    """How often each replicate draws a row: ``array<int>``.

    Rows of one key are drawn together, so the key should identify a row, or the unit that is to
    be drawn, such as a customer.
    """
    if not keys or replicates < 1:
        raise ValueError("draws need a key and at least one replicate")

    def count(u: Column, limit) -> Column:
        out = F.when(u < limit(POISSON[0]), 0)
        for k, least in enumerate(POISSON[1:], 1):
            out = out.when(u < limit(least), k)
        return out.otherwise(len(POISSON))

    if hash_fn == "md5":
        # Eight hexadecimal digits are ordered as the number they write.
        def digits(r: Column) -> Column:
            return F.substring(F.md5(_key_text(keys, r)), 1, 8)

        return _each(replicates, digits, lambda u: count(u, lambda n: F.lit(f"{n:08x}")))
    return _each(replicates, lambda r: replicate_bucket(keys, r, hash_fn), lambda u: count(u, F.lit))


def _each(replicates: int, draw, count) -> Column:
    """An array over the replicates; written out, and so compiled, where there are few."""
    numbers = F.sequence(F.lit(0), F.lit(replicates - 1))
    if replicates <= MAX_GENERATED_DRAWS:
        numbers = F.array(*(draw(F.lit(r)) for r in range(replicates)))
    else:
        numbers = F.transform(numbers, draw)
    return F.transform(numbers, count)


@dataclass
class BaggedModel:
    """Coefficients by replicate, and scores on the rows that replicates left out.

    ``rows`` counts the rows that at least one replicate left out; each is scored by the mean
    probability of the replicates that did.
    """

    theta: np.ndarray
    intercepts: np.ndarray
    rows: int
    accuracy: float | None
    cross_entropy: float | None

    def mean(self) -> LogisticModel:
        return LogisticModel(self.theta.mean(axis=0).tolist(), float(self.intercepts.mean()))

    def interval(self, level: float = 0.95) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper ends by percentile, of every coefficient and last the intercept."""
        if not 0.0 < level < 1.0:
            raise ValueError("level must lie strictly between 0 and 1")
        every = np.column_stack([self.theta, self.intercepts])
        low, high = np.quantile(every, [(1.0 - level) / 2.0, (1.0 + level) / 2.0], axis=0)
        return low, high


def bagged_logistic_fit(
    df: DataFrame,
    keys: Sequence[str],
    features: str = "features",
    label: str = "label",
    replicates: int = 50,
    method: str = "newton",
    max_iter: int = 25,
    learning_rate: float = 1.0,
    l2: float = 0.0,
    tol: float = 1e-9,
    fit_intercept: bool = True,
    hash_fn: str = "xxhash64",
    out_of_bag: bool = True,
) -> BaggedModel:
    """Fit every bootstrap replicate by the steps of ``logistic_fit``, in shared passes.

    Nulls, labels other than 0 and 1, vectors of different lengths and an empty table raise, and so
    does a replicate that drew no row. With one replicate and few rows, none may be left out; the
    scores are then None. With ``out_of_bag`` every row keeps its own draws, to be scored by them;
    without, no row is scored, and equal rows of a partition are one row with the sum of their draws.
    """
    check_fit_parameters(method, max_iter, [l2], tol, fit_intercept)
    draws = poisson_draws(keys, replicates, hash_fn)
    with pack_blocks(df, label, features, draws=draws, merge=not out_of_bag) as blocks:
        fits = [Fit(graded_terms(blocks.width, 1), l2) for _ in range(replicates)]
        fit_many(blocks, fits, method, max_iter, learning_rate, tol, fit_intercept)
        theta = np.stack([f.theta for f in fits])
        intercepts = np.array([f.intercept for f in fits])
        if not out_of_bag:
            return BaggedModel(theta, intercepts, 0, None, None)
        kernel = kernels.out_of_bag_pass(blocks.width, theta, intercepts, PROBABILITY_FLOOR)
        sums = sum_partials(blocks.read().mapInArrow(kernel, PARTIALS), blocks.partitions).first()
    rows, hits, loss = sums.part
    rows = round(rows)
    return BaggedModel(
        theta, intercepts, rows, hits / rows if rows else None, loss / rows if rows else None
    )


def bagged_predict(
    df: DataFrame, model: BaggedModel, features: str = "features", keys: Sequence[str] = ()
) -> DataFrame:
    """``(keys.., prediction_prob)``: the mean probability over the replicates.

    A null vector or element and a vector of another length raise.
    """
    rows = df.select(*[column(k) for k in keys], doubles(column(features)).alias("features"))
    kinds = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    kernel = kernels.bagged_scores(model.theta, model.intercepts)
    return rows.mapInArrow(kernel, ", ".join([*kinds, "prediction_prob double"]))
