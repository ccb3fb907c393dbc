"""The registry and the tables that the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linfit.functions.features import column
from linfit.operators.resample import key_bucket
from linfit.sources.files import read_table
from linfit.sources.schemas import (
    CLICK_CATEGORIES,
    CLICK_COLUMNS,
    CLICK_LABEL,
    CLICK_WEIGHT,
    click_numeric_features,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TEST_BUCKETS = int(0.3 * (1 << 32))
KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
KEY_LIST = ", ".join(KEYS)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def rounded(c: Column | str, digits: int) -> Column:
    """Rounded for comparison: the two engines add floats in different orders."""
    return F.round(column(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def sql_rounded(expression: str, digits: int) -> str:
    return f"(round({expression}, {digits}) + 0.0)"


# Line items as instances: two features and a binary label, or the price as a numeric label.
LINE_SQL = f"""
lines AS MATERIALIZED (
  SELECT {KEY_LIST},
         CASE WHEN l_returnflag = 'R' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label,
         (l_quantity - 25.5) / 14.4 AS x0,
         (l_discount - 0.05) / 0.03 AS x1,
         (l_extendedprice - 38000) / 23000 AS price,
         l_quantity AS quantity,
         CAST(('0x' || substr(md5(concat_ws('|', {KEY_LIST})), 1, 8)) AS BIGINT) AS bucket
  FROM lineitem)"""


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Keys, ``label``, ``x0``, ``x1``, ``price``, ``quantity`` and ``features`` = [x0, x1]."""
    table = read_table(spark, folder, "lineitem")
    return table.select(
        *KEYS,
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        ((F.col("l_quantity") - 25.5) / 14.4).alias("x0"),
        ((F.col("l_discount") - 0.05) / 0.03).alias("x1"),
        ((F.col("l_extendedprice") - 38000) / 23000).alias("price"),
        F.col("l_quantity").alias("quantity"),
    ).withColumn("features", F.array("x0", "x1"))


def line_bucket() -> Column:
    return key_bucket(KEYS, "md5")


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """``vec_id``, ``label`` and ``features``: the embedding as doubles."""
    return read_table(spark, folder, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("features")
    )


# One row per vector element, positions from 0.
ELEMENT_SQL = """
elements AS MATERIALIZED (
  SELECT vec_id, label, CAST(p - 1 AS INTEGER) AS pos, CAST(embedding[p] AS DOUBLE) AS v,
         CAST(embedding[len(embedding) + 1 - p] AS DOUBLE) AS w
  FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS p
        FROM embeddings))"""


def elements(df: DataFrame, features: str, *keys: str) -> DataFrame:
    return df.select(*keys, F.posexplode(features).alias("pos", "v"))


def _click_expressions() -> dict[str, str]:
    """Click columns from orders, in SQL that both engines read; some values are missing."""
    out = {
        "channel": "o_orderstatus",
        "client": "CASE o_custkey % 5 WHEN 0 THEN 'web' WHEN 1 THEN 'app' ELSE 'tablet' END",
        "algorithm": "CASE o_orderkey % 3 WHEN 0 THEN 'alpha' WHEN 1 THEN 'beta' ELSE 'gamma' END",
        "l1": "CASE WHEN o_custkey % 13 = 0 THEN NULL WHEN o_custkey % 2 = 0 THEN 'even' "
        "ELSE 'odd' END",
        CLICK_WEIGHT: "o_totalprice / 100000",
        CLICK_LABEL: "CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') "
        "THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    }
    for k, name in enumerate(click_numeric_features(), 1):
        out[name] = (
            f"CASE WHEN (o_orderkey + {k}) % 11 = 0 THEN NULL "
            f"ELSE CAST((o_orderkey * {k} + o_custkey * {k * k}) % 97 AS DOUBLE) / 97 END"
        )
    return {name: out[name] for name in CLICK_COLUMNS}


CLICK_EXPRESSIONS = _click_expressions()


def clicks(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, folder, "orders")
    return table.select(*[F.expr(e).alias(name) for name, e in CLICK_EXPRESSIONS.items()])


def click_sql(filled: bool) -> str:
    """The click table in plain SQL, numeric nulls filled with 0 on request."""

    def value(name: str, expression: str) -> str:
        numeric = name not in CLICK_CATEGORIES
        return f"coalesce({expression}, CAST(0 AS DOUBLE))" if filled and numeric else expression

    chosen = ", ".join(f'{value(n, e)} AS "{n}"' for n, e in CLICK_EXPRESSIONS.items())
    return f"SELECT {chosen} FROM orders"
