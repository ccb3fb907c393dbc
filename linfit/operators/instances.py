"""(label, features) tables and the packed blocks the iterative fits run on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfit.functions.features import column, with_bias
from linfit.functions.vectors import doubles
from linfit.operators import kernels


def instances(
    df: DataFrame, label: str | Column, features: str | Column, bias: bool = False
) -> DataFrame:
    """``label double, features array<double>``; with ``bias`` a 1.0 follows the last feature."""
    label = column(label) if isinstance(label, str) else label
    features = doubles(column(features) if isinstance(features, str) else features)
    return df.select(
        label.cast("double").alias("label"),
        (with_bias(features) if bias else features).alias("features"),
    )


def feature_arity(df: DataFrame, features: str = "features") -> DataFrame:
    """One row ``(arity, min_arity, max_arity)``; arity is null where rows disagree."""
    size = F.size(column(features))
    return df.agg(F.min(size).alias("min_arity"), F.max(size).alias("max_arity")).select(
        F.when(F.col("min_arity") == F.col("max_arity"), F.col("min_arity")).alias("arity"),
        "min_arity",
        "max_arity",
    )


def constant_arity(df: DataFrame, features: str = "features") -> int:
    row = feature_arity(df, features).first()
    if row.arity is None:
        raise ValueError(f"feature vectors differ in length: {row.min_arity} to {row.max_arity}")
    return row.arity


def spread(df: DataFrame) -> DataFrame:
    """Use every core for a table that will be read many times.

    A scan of few, large row groups has fewer partitions with rows than the cluster has cores.
    Such a table is dealt out once; one with enough splits, any large table, passes through
    without a shuffle. Judged by the planner's size of the table, so no job runs. Meant for scans
    and projections of scans.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().analyzed().stats().sizeInBytes()))
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(cores) if size // split < cores else df


#: The fold number of rows that have none.
UNFOLDED = -1


@dataclass
class Blocks:
    """Persisted instance blocks and the facts one counting job learned about them."""

    df: DataFrame
    width: int
    rows: int
    partitions: int

    def read(self, part: int | None = None) -> DataFrame:
        """The blocks for a pass. Arrow batches end by bytes, so no setting has to change.

        With ``part`` only the blocks of that fold, for blocks packed apart.
        """
        df = self.df if part is None else self.df.where(F.col("part") == part)
        return df.select("y", "fold", "x", *(c for c in ("times", "draws") if c in self.df.columns))

    def __enter__(self) -> "Blocks":
        return self

    def __exit__(self, *_: object) -> None:
        self.df.unpersist()


def pack_blocks(
    df: DataFrame,
    label: str = "label",
    features: str = "features",
    fold: str | None = None,
    classes: int | None = 2,
    draws: Column | None = None,
    apart: bool = False,
    merge: bool = False,
) -> Blocks:
    """Cache instances as small dense blocks; labels are below ``classes``, or any if that is None.

    ``draws`` are counts of the row by replicate, an array of one length, kept beside the block.
    With ``apart`` every block is of one fold, and those of a fold lie together in a partition, so
    that a pass over one fold skips the cached batches of the others. With ``merge`` equal rows of
    a partition (label, fold and features) are one row with a count, and their draws are added up:
    a table of few different rows then costs a pass as much as these, whatever its size. Tasks stop
    merging where it pays little. Only the logistic passes know counts.

    An iterative fit reads its table once per step. Handing Python whole matrices instead of
    rows leaves only linear algebra in that loop. Blocks are cut within partitions, so nothing
    is shuffled, and a lost block is rebuilt from the input's own lineage. The counting job that
    fills the cache also checks labels, nulls and vector lengths.
    """
    rows = df.select(
        column(label).cast("double").alias("label"),
        (column(fold).cast("int") if fold else F.lit(UNFOLDED)).alias("fold"),
        doubles(column(features)).alias("features"),
        *([draws.alias("draws")] if draws is not None else []),
    )
    rows = rows.sortWithinPartitions("fold") if apart else rows
    if apart and merge:
        raise ValueError("blocks packed apart are not merged")
    schema = kernels.BLOCK_SCHEMA + (", times binary" if merge else "")
    schema += ", draws binary" if draws is not None else ""
    kernel = kernels.merging_packer(classes) if merge else kernels.packer(classes, apart)
    packed = rows.mapInArrow(kernel, schema)
    packed = packed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        facts = packed.withColumn("at", F.spark_partition_id()).agg(
            F.sum("rows").alias("rows"),
            F.sum("unusable").alias("unusable"),
            F.min("min_width").alias("narrow"),
            F.max("max_width").alias("wide"),
            (F.max("at") + 1).alias("partitions"),
        ).first()
        if not facts.rows:
            raise ValueError("no instances to fit on")
        if facts.unusable:
            allowed = "not finite" if classes is None else f"other than 0 to {classes - 1}"
            allowed = "other than 0 and 1" if classes == 2 else allowed
            raise ValueError(f"{facts.unusable} labels or features are null, or labels {allowed}")
        if facts.narrow != facts.wide or facts.narrow < 1:
            raise ValueError(f"feature vectors differ in length: {facts.narrow} to {facts.wide}")
    except Exception:
        packed.unpersist()
        raise
    return Blocks(packed, facts.wide, facts.rows, facts.partitions)
