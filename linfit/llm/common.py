"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linfit.sources.scratch import scratch_path

#: Rows of an Arrow batch that become Python objects at one time.
SLICE = 512
#: Characters that the contracts count as white space.
BLANK = r"[\x20\x09-\x0D]"


def read(spark: SparkSession, folder: str, table: str, *columns: str) -> DataFrame:
    """Columns of a given table; all of them if none is named."""
    df = spark.read.parquet(f"{folder}/{table}.parquet")
    return df.select(*columns) if columns else df


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends, lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Hand memory that is free back to the system; a worker process outlives its task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError, TypeError):  # only some C libraries can
        ctypes.CDLL(None).malloc_trim(0)


def slices(batch: pa.RecordBatch, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, size):
        yield batch.slice(start, size)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def map_rows(
    df: DataFrame,
    start: Callable[[], Callable[[pa.RecordBatch], dict]],
    schema: str,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``df`` with columns added in Python, batch by batch and without a shuffle.

    ``start`` runs once in a task and returns the function from a slice of rows to a dict of
    new columns. The columns in ``carry`` stay; one that ``schema`` names as well is replaced.
    """
    added = T._parse_datatype_string(schema)
    kept = [c for c in carry if c not in added.names]
    fields = [df.schema[c] for c in kept] + list(added)
    out = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        target = arrow_schema(out)
        try:
            for batch in batches:
                for rows in slices(batch):
                    new = work(rows)
                    columns = [rows.column(c) for c in kept]
                    columns += [pa.array(new[f.name], target.field(f.name).type) for f in added]
                    columns = [c.cast(f.type) for c, f in zip(columns, target, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, schema=target)
        finally:
            work = batch = rows = new = columns = None
            give_back()

    return df.mapInArrow(run, out)


def unused(name: str, columns: Iterable[str]) -> str:
    """``name``, lengthened until no column is called so, whatever the case of its letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(key: Column) -> Column:
    """One key in four is kept from learning; a null key never is."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (id, root) per vertex with an edge.

    ``root`` is the component's smallest id. Large-star and small-star rounds, each a pair of
    shuffles over the edges left and each written to the shared folder, until nothing moves;
    a chain of n vertices takes about log n rounds. Null ends and loops are ignored.
    """
    pairs = (
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    pairs = stored(pairs, f"{name}-edges")
    while not _stars(pairs):
        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        small = (
            small.where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(lowest.select("a", F.col("m").alias("b")))
            .distinct()
        )
        pairs = stored(small, f"{name}-star")
    ids = pairs.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return ids.union(pairs.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())


def _stars(pairs: DataFrame) -> bool:
    """Whether every vertex hangs on one other at most, which hangs on none."""
    ends = pairs.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(pairs.select("b", F.lit(0), F.lit(1)))
    seen = ends.groupBy("v").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return seen.where("up > 1 or up = 1 and down > 0").isEmpty()
