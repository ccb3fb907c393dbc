"""Fitted transformers and staged models."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfit.catalog.base import (
    ELEMENT_SQL,
    KEY_LIST,
    KEYS,
    LINE_SQL,
    TEST_BUCKETS,
    elements,
    embeddings,
    lines,
    query,
    rounded,
    sql_rounded,
)
from linfit.operators.encoding import (
    fit_index,
    fitted_values,
    label_map,
    label_map_difference,
    one_hot,
    scale,
)
from linfit.operators.moments import column_means
from linfit.operators.resample import holdout
from linfit.sources.files import read_table

STATS_SQL = f"""{ELEMENT_SQL},
stats AS MATERIALIZED (
  SELECT pos, avg(v) AS m, stddev_samp(v) AS s FROM elements GROUP BY pos)"""


def _scaled_sql(value: str) -> str:
    return (
        f"WITH {STATS_SQL} SELECT vec_id, pos, {sql_rounded(value, 8)} AS v "
        "FROM elements JOIN stats USING (pos)"
    )


def _scaled(spark: SparkSession, folder: str, with_mean: bool, with_std: bool) -> DataFrame:
    table = scale(embeddings(spark, folder), "features", "x", with_mean, with_std)
    return elements(table, "x", "vec_id").select("vec_id", "pos", rounded("v", 8).alias("v"))


@query("scale_center", _scaled_sql("v - m"))
def scale_center(spark: SparkSession, folder: str) -> DataFrame:
    return _scaled(spark, folder, True, False)


@query("scale_std", _scaled_sql("v / s"))
def scale_std(spark: SparkSession, folder: str) -> DataFrame:
    return _scaled(spark, folder, False, True)


@query("scale_center_std", _scaled_sql("(v - m) / s"))
def scale_center_std(spark: SparkSession, folder: str) -> DataFrame:
    return _scaled(spark, folder, True, True)


@query("column_means", f"WITH {STATS_SQL} SELECT pos AS i, {sql_rounded('m', 9)} AS v FROM stats")
def column_means_query(spark: SparkSession, folder: str) -> DataFrame:
    return column_means(embeddings(spark, folder)).select("i", rounded("v", 9).alias("v"))


FREQUENCY_SQL = """
ranks AS (
  SELECT value, row_number() OVER (ORDER BY n DESC, value) - 1 AS idx
  FROM (SELECT {column} AS value, count(*) AS n FROM {table} GROUP BY {column}))"""


def frequency_sql(table: str, column: str) -> str:
    return FREQUENCY_SQL.format(table=table, column=column)


@query(
    "index_by_frequency",
    f"""WITH {frequency_sql('orders', 'o_orderpriority')}
        SELECT o_orderkey, o_orderpriority, CAST(idx AS DOUBLE) AS idx
        FROM orders JOIN ranks ON o_orderpriority = value""",
)
def index_by_frequency(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return fit_index(table, "o_orderpriority", "idx").transform(table)


@query(
    "index_by_vocabulary",
    """WITH words AS (SELECT value, row_number() OVER (ORDER BY value DESC) - 1 AS idx
                      FROM (SELECT DISTINCT c_mktsegment AS value FROM customer))
       SELECT c_custkey, c_mktsegment, CAST(idx AS DOUBLE) AS idx
       FROM customer JOIN words ON c_mktsegment = value""",
)
def index_by_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    segments = table.select("c_mktsegment").distinct().orderBy(F.desc("c_mktsegment")).collect()
    vocabulary = [r.c_mktsegment for r in segments]
    return fit_index(table, "c_mktsegment", "idx", vocabulary).transform(table)


@query(
    "one_hot",
    f"""WITH {frequency_sql('orders', 'o_orderpriority')}
        SELECT o_orderkey, CAST(slot.idx AS INTEGER) AS pos,
               CASE WHEN ranks.idx = slot.idx THEN CAST(1 AS DOUBLE)
                    ELSE CAST(0 AS DOUBLE) END AS v
        FROM orders JOIN ranks ON o_orderpriority = ranks.value
        CROSS JOIN (SELECT idx FROM ranks WHERE idx < (SELECT max(idx) FROM ranks)) AS slot""",
)
def one_hot_query(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    indexed = fit_index(table, "o_orderpriority", "idx").transform(table)
    return elements(one_hot(indexed, "idx", "x"), "x", "o_orderkey")


@query(
    "label_map",
    f"""WITH {frequency_sql('documents', 'source')}
        SELECT value, CAST(idx AS INTEGER) AS idx FROM ranks""",
)
def label_map_query(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, folder, "documents").select("source")
    return label_map(spark, fit_index(table, "source", "idx").labels)


@query(
    "label_map_difference",
    f"""WITH {frequency_sql('documents', 'lang')},
        target AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS idx FROM ranks)
        SELECT value, CAST(idx AS INTEGER) AS idx, 'fitted' AS side
        FROM (SELECT value, idx FROM ranks EXCEPT ALL SELECT value, idx FROM target)
        UNION ALL
        SELECT value, CAST(idx AS INTEGER), 'target'
        FROM (SELECT value, idx FROM target EXCEPT ALL SELECT value, idx FROM ranks)""",
)
def label_map_difference_query(spark: SparkSession, folder: str) -> DataFrame:
    """Labels by falling frequency against the same labels in alphabetical order."""
    table = read_table(spark, folder, "documents").select("lang")
    labels = fit_index(table, "lang", "idx").labels
    return label_map_difference(label_map(spark, labels), label_map(spark, sorted(labels)))


TRAIN_SQL = f"""{LINE_SQL},
train AS MATERIALIZED (SELECT * FROM lines WHERE bucket >= {TEST_BUCKETS}),
test AS MATERIALIZED (SELECT * FROM lines WHERE bucket < {TEST_BUCKETS}),
st AS MATERIALIZED (
  SELECT avg(x0) AS m0, stddev_samp(x0) AS s0, avg(x1) AS m1, stddev_samp(x1) AS s1 FROM train),
gram AS MATERIALIZED (
  SELECT sum(z0 * z0) AS g00, sum(z0 * z1) AS g01, sum(z1 * z1) AS g11,
         sum(z0 * price) AS h0, sum(z1 * price) AS h1
  FROM (SELECT (x0 - m0) / s0 AS z0, (x1 - m1) / s1 AS z1, price FROM train, st)),
theta AS MATERIALIZED (
  SELECT (g11 * h0 - g01 * h1) / (g00 * g11 - g01 * g01) AS t0,
         (g00 * h1 - g01 * h0) / (g00 * g11 - g01 * g01) AS t1 FROM gram)"""


def _two_stage(spark: SparkSession, folder: str):
    train, test = holdout(lines(spark, folder), KEYS, 0.3, "md5")
    stages = [
        VectorAssembler(inputCols=["x0", "x1"], outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
        LinearRegression(
            featuresCol="scaled", labelCol="price", solver="normal", fitIntercept=False
        ),
    ]
    return Pipeline(stages=stages).fit(train), test


@query(
    "staged_fit_transform",
    f"""WITH {TRAIN_SQL}
        SELECT {KEY_LIST}, price, {sql_rounded('(x0 - m0) / s0 * t0 + (x1 - m1) / s1 * t1', 7)}
               AS prediction FROM test, st, theta""",
)
def staged_fit_transform(spark: SparkSession, folder: str) -> DataFrame:
    """Scaler and regression fitted on the training split, applied to the other one."""
    model, test = _two_stage(spark, folder)
    return model.transform(test).select(
        *KEYS, "price", rounded("prediction", 7).alias("prediction")
    )


@query(
    "model_coefficients",
    f"""WITH {TRAIN_SQL}
        SELECT CAST(stage AS INTEGER) AS stage, name, CAST(idx AS INTEGER) AS idx,
               {sql_rounded('value', 7)} AS value
        FROM (SELECT 1 AS stage, 'mean' AS name, 0 AS idx, m0 AS value FROM st
              UNION ALL SELECT 1, 'mean', 1, m1 FROM st
              UNION ALL SELECT 1, 'std', 0, s0 FROM st
              UNION ALL SELECT 1, 'std', 1, s1 FROM st
              UNION ALL SELECT 2, 'coefficient', 0, t0 FROM theta
              UNION ALL SELECT 2, 'coefficient', 1, t1 FROM theta
              UNION ALL SELECT 2, 'intercept', 0, CAST(0 AS DOUBLE)
              UNION ALL SELECT 2, 'reg_param', 0, CAST(0 AS DOUBLE)
              UNION ALL SELECT 2, 'rmse', 0, sqrt(avg(
                  pow(price - (x0 - m0) / s0 * t0 - (x1 - m1) / s1 * t1, 2)))
                  FROM train, st, theta)""",
)
def model_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    model, _ = _two_stage(spark, folder)
    found = fitted_values(spark, model)
    return found.select("stage", "name", "idx", rounded("value", 7).alias("value"))
