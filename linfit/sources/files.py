"""File scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linfit.functions.features import column


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = False
) -> DataFrame:
    """CSV with a schema given up front: no inference pass, and unused columns are not parsed."""
    return spark.read.schema(schema).csv(path, header=header)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def header_vocabulary(spark: SparkSession, path: str, delimiter: str = ",") -> list[str]:
    """Class names from a file's header line, in file order and without the leading id field.

    Only the first line is read, so the size of the file does not matter.
    """
    first = spark.read.text(path).first()
    if first is None:
        raise ValueError(f"no header line in {path}")
    return first["value"].split(delimiter)[1:]


def write_csv(
    df: DataFrame, path: str, columns: Sequence[str], keys: Sequence[str] = ()
) -> None:
    """CSV with header. ``keys`` come first, so that predictions can be joined back to rows."""
    df.select(*[column(c) for c in [*keys, *columns]]).write.csv(path, header=True)


def write_probabilities(
    df: DataFrame, path: str, key: str = "id", probability: str = "probability"
) -> None:
    """JSON lines of ``(key, probability)`` with the probabilities as a plain array."""
    values = column(probability)
    if not isinstance(df.schema[probability].dataType, T.ArrayType):
        values = vector_to_array(values)
    df.select(column(key), values.alias(probability)).write.json(path)


def preview(df: DataFrame, keys: Sequence[str], n: int = 20) -> DataFrame:
    """The ``n`` first rows by key: a top-n per partition, never a full sort."""
    return df.orderBy(*[F.asc(c) for c in keys]).limit(n)
