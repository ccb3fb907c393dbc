"""Arithmetic on vector columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linfit.catalog.base import ELEMENT_SQL, elements, embeddings, query, rounded, sql_rounded
from linfit.functions.vectors import (
    add,
    dot,
    linear_projection,
    negate,
    norm_power,
    outer_packed,
    scale,
)

def plain() -> Column:
    return F.col("features")


def mirrored() -> Column:
    return F.reverse("features")


def _vector(spark: SparkSession, folder: str, value: Column) -> DataFrame:
    table = embeddings(spark, folder).withColumn("features", value)
    return elements(table, "features", "vec_id")


@query(
    "vec_dot",
    f"""WITH {ELEMENT_SQL}
        SELECT vec_id, {sql_rounded('sum(v * v)', 8)} AS squared,
               {sql_rounded('sum(v * w)', 8)} AS mirrored
        FROM elements GROUP BY vec_id""",
)
def vec_dot(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings(spark, folder).select(
        "vec_id",
        rounded(dot(plain(), plain()), 8).alias("squared"),
        rounded(dot(plain(), mirrored()), 8).alias("mirrored"),
    )


@query("vec_scale", f"WITH {ELEMENT_SQL} SELECT vec_id, pos, v * 2.5 AS v FROM elements")
def vec_scale(spark: SparkSession, folder: str) -> DataFrame:
    return _vector(spark, folder, scale(plain(), 2.5))


@query("vec_add", f"WITH {ELEMENT_SQL} SELECT vec_id, pos, v + w AS v FROM elements")
def vec_add(spark: SparkSession, folder: str) -> DataFrame:
    return _vector(spark, folder, add(plain(), mirrored()))


@query("vec_negate", f"WITH {ELEMENT_SQL} SELECT vec_id, pos, -v AS v FROM elements")
def vec_negate(spark: SparkSession, folder: str) -> DataFrame:
    return _vector(spark, folder, negate(plain()))


@query(
    "vec_norm_power",
    f"""WITH {ELEMENT_SQL}
        SELECT vec_id, {sql_rounded('sum(abs(v))', 8)} AS first,
               {sql_rounded('sum(pow(abs(v), 2))', 8)} AS second,
               {sql_rounded('sum(pow(abs(v), 3))', 8)} AS third
        FROM elements GROUP BY vec_id""",
)
def vec_norm_power(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings(spark, folder).select(
        "vec_id",
        *[
            rounded(norm_power(plain(), p), 8).alias(name)
            for p, name in ((1, "first"), (2, "second"), (3, "third"))
        ],
    )


@query(
    "vec_outer_packed",
    f"""WITH {ELEMENT_SQL}
        SELECT a.vec_id, count(*) AS entries,
               {sql_rounded('sum(a.v * b.v * (a.pos * (a.pos + 1) // 2 + b.pos + 1))', 5)}
               AS checksum
        FROM elements a JOIN elements b ON a.vec_id = b.vec_id AND b.pos <= a.pos
        GROUP BY a.vec_id""",
)
def vec_outer_packed(spark: SparkSession, folder: str) -> DataFrame:
    """The packed triangle of every row, shown as its length and a position-weighted sum."""
    packed = embeddings(spark, folder).select("vec_id", outer_packed(plain()).alias("m"))
    weighted = F.aggregate(
        F.transform("m", lambda v, p: v * (p + 1)), F.lit(0.0), lambda acc, v: acc + v
    )
    return packed.select(
        "vec_id",
        F.size("m").cast("long").alias("entries"),
        rounded(weighted, 5).alias("checksum"),
    )


def projection_rows(width: int = 64) -> list[list[float]]:
    return [[((r + 1) * (i + 1) % 7 - 3) / 8 for i in range(width)] for r in range(3)]


@query(
    "linear_projection",
    f"WITH {ELEMENT_SQL} SELECT vec_id, "
    + ", ".join(
        sql_rounded(f"sum(v * ((({r} + 1) * (pos + 1)) % 7 - 3) / 8)", 8) + f" AS p{r}"
        for r in range(3)
    )
    + " FROM elements GROUP BY vec_id",
)
def linear_projection_query(spark: SparkSession, folder: str) -> DataFrame:
    projected = embeddings(spark, folder).select(
        "vec_id", linear_projection(plain(), projection_rows()).alias("p")
    )
    return projected.select(
        "vec_id", *[rounded(F.get("p", F.lit(r)), 8).alias(f"p{r}") for r in range(3)]
    )
