"""Splits, folds, unions and samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfit.functions.features import column

BUCKETS = 1 << 32
HASHES = ("xxhash64", "md5")


def key_bucket(keys: Sequence[str], hash_fn: str = "xxhash64") -> Column:
    """A number in [0, 2**32) that depends on the key values alone.

    ``xxhash64`` is the cheap one; ``md5`` over the ``|``-joined text is slower but gives the
    same buckets in any other engine.
    """
    if hash_fn == "xxhash64":
        return F.pmod(F.xxhash64(*[column(k) for k in keys]), F.lit(BUCKETS))
    if hash_fn == "md5":
        text = F.concat_ws("|", *[column(k).cast("string") for k in keys])
        return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
    raise ValueError(f"unknown hash {hash_fn!r}: use one of {', '.join(HASHES)}")


def holdout(
    df: DataFrame, keys: Sequence[str], fraction: float = 0.3, hash_fn: str = "xxhash64"
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with about ``fraction`` of the keys in test.

    A row's side is a function of its key: it survives re-reading, repartitioning and lost
    executors, needs no shuffle and no seed. The key should identify a row.
    """
    if not 0.0 < fraction < 1.0:
        raise ValueError("fraction must lie strictly between 0 and 1")
    marked = df.withColumn("_test", key_bucket(keys, hash_fn) < int(fraction * BUCKETS))
    return marked.filter(~F.col("_test")).drop("_test"), marked.filter("_test").drop("_test")


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 42
) -> list[DataFrame]:
    """Row-wise random split for tables without a key."""
    return df.randomSplit(list(weights), seed)


def check_folds(k: int) -> None:
    if not 2 <= k <= 20:
        raise ValueError(f"{k} folds: a search takes from 2 to 20")


def with_fold(
    df: DataFrame,
    keys: Sequence[str] = (),
    k: int = 3,
    name: str = "fold",
    hash_fn: str = "xxhash64",
    seed: int = 42,
) -> DataFrame:
    """One more column: the row's fold, 0 to k-1.

    Fold i's training rows are those with another number, so no table is ever unioned. All rows
    of one key share a fold; where a key may hold a large part of the table, pass none, and
    every row gets a random fold of its own.
    """
    check_folds(k)
    fold = key_bucket(keys, hash_fn) % k if keys else F.floor(F.rand(seed) * k)
    return df.withColumn(name, fold.cast("int"))


def fold_pairs(df: DataFrame, k: int = 3, name: str = "fold") -> list[tuple[DataFrame, DataFrame]]:
    """(train, test) per fold of a table that has a fold column."""
    check_folds(k)
    return [(df.filter(F.col(name) != i), df.filter(F.col(name) == i)) for i in range(k)]


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """Bag union by position."""
    if not tables:
        raise ValueError("union_all needs at least one table")
    return reduce(DataFrame.unionAll, tables)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)
