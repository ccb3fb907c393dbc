"""Model fits and predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfit.catalog.base import (
    KEY_LIST,
    KEYS,
    LINE_SQL,
    embeddings,
    lines,
    query,
    rounded,
    sql_rounded,
)
from linfit.catalog.sql_fits import gradient_steps, named_rows, newton_steps
from linfit.operators.instances import spread
from linfit.operators.linear import linear_predict, ridge_fit, ridge_native, ridge_reg_param
from linfit.operators.logistic import (
    LogisticModel,
    logistic_fit,
    logistic_native,
    logistic_predict,
)

ITERATIONS = 5
RIDGE = 2.5


def named(
    spark: SparkSession, values: Sequence[tuple[str, float]], digits: int
) -> DataFrame:
    table = spark.createDataFrame(list(values), schema="name string, value double")
    return table.select("name", rounded("value", digits).alias("value"))


RIDGE_SQL = f"""{LINE_SQL},
terms AS MATERIALIZED (
  SELECT sum(x0 * x0) + {RIDGE} AS a, sum(x0 * x1) AS b, sum(x1 * x1) + {RIDGE} AS c,
         sum(x0 * price) AS p, sum(x1 * price) AS q FROM lines),
theta AS MATERIALIZED (
  SELECT (c * p - b * q) / (a * c - b * b) AS t0, (a * q - b * p) / (a * c - b * b) AS t1
  FROM terms)"""
THETA_ROWS = named_rows("theta", [("theta0", "t0"), ("theta1", "t1")], 9)


@query("ridge_fit", f"WITH {RIDGE_SQL} {THETA_ROWS}")
def ridge_fit_query(spark: SparkSession, folder: str) -> DataFrame:
    model = ridge_fit(lines(spark, folder), "features", "price", RIDGE, width=2)
    return named(spark, [(f"theta{i}", v) for i, v in enumerate(model.theta)], 9)


@query("ridge_native", f"WITH {RIDGE_SQL} {THETA_ROWS.replace(', 9)', ', 7)')}")
def ridge_native_query(spark: SparkSession, folder: str) -> DataFrame:
    """The library's solver at the regularisation that has the same optimum."""
    table = lines(spark, folder)
    reg_param = ridge_reg_param(table, RIDGE, "price")
    model = ridge_native(table, "features", "price", reg_param, standardization=False)
    return named(spark, [(f"theta{i}", v) for i, v in enumerate(model.theta)], 7)


@query(
    "linear_predict",
    f"""WITH {RIDGE_SQL}
        SELECT {KEY_LIST}, price AS label, {sql_rounded('x0 * t0 + x1 * t1', 9)} AS prediction
        FROM lines, theta""",
)
def linear_predict_query(spark: SparkSession, folder: str) -> DataFrame:
    table = lines(spark, folder)
    model = ridge_fit(table, "features", "price", RIDGE, width=2)
    found = linear_predict(table, model, "features", "price", KEYS)
    return found.withColumn("prediction", rounded("prediction", 9))


# The gradient is a sum over rows, so the rate is a constant over the number of rows.
RATE = 2.0
L2 = 0.1
GD_SQL = f"""{LINE_SQL},
points AS (SELECT 0 AS fit, -2 AS held, CAST({L2} AS DOUBLE) AS l2, 1 AS degree),
numbered AS (SELECT *, -1 AS fold FROM lines),
{gradient_steps('numbered', 'points', [('x0', 1), ('x1', 1)], ITERATIONS,
                f'(SELECT CAST({RATE} AS DOUBLE) / count(*) FROM lines)')}"""


def gradient_fit(spark: SparkSession, folder: str) -> LogisticModel:
    table = lines(spark, folder)
    return logistic_fit(
        spread(table.select("label", "features")),
        max_iter=ITERATIONS,
        learning_rate=RATE / table.count(),
        l2=L2,
    )


def coefficients(model: LogisticModel) -> list[tuple[str, float]]:
    return [(f"theta{i}", v) for i, v in enumerate(model.theta)] + [
        ("intercept", model.intercept)
    ]


NAMES = [("theta0", "t0"), ("theta1", "t1"), ("intercept", "b")]


@query("logistic_gd_fit", f"WITH {GD_SQL} {named_rows(f's{ITERATIONS}', NAMES, 9)}")
def logistic_gd_fit(spark: SparkSession, folder: str) -> DataFrame:
    return named(spark, coefficients(gradient_fit(spark, folder)), 9)


@query(
    "logistic_gd_losses",
    f"WITH {GD_SQL} "
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS iteration, {sql_rounded('loss', 9)} AS loss FROM p{i}"
        for i in range(ITERATIONS)
    ),
)
def logistic_gd_losses(spark: SparkSession, folder: str) -> DataFrame:
    model = gradient_fit(spark, folder)
    table = spark.createDataFrame(
        list(enumerate(model.losses)), schema="iteration int, loss double"
    )
    return table.select("iteration", rounded("loss", 9).alias("loss"))


NEWTON_NAMES = [("theta0", "t0"), ("theta1", "t1"), ("intercept", "t2")]


@query(
    "logistic_newton_fit",
    f"WITH {LINE_SQL}, {newton_steps('lines', 3)} {named_rows('n3', NEWTON_NAMES, 8)}",
)
def logistic_newton_fit(spark: SparkSession, folder: str) -> DataFrame:
    model = logistic_fit(
        spread(lines(spark, folder).select("label", "features")),
        method="newton",
        max_iter=3,
        tol=0.0,
    )
    return named(spark, coefficients(model), 8)


@query(
    "logistic_predict",
    f"""WITH {GD_SQL}, scored AS (
          SELECT lines.*, 1 / (1 + exp(-(x0 * t0 + x1 * t1 + b))) AS p
          FROM lines, s{ITERATIONS})
        SELECT {KEY_LIST}, label, {sql_rounded('p', 9)} AS prediction_prob,
               CASE WHEN p >= 0.35 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction
        FROM scored""",
)
def logistic_predict_query(spark: SparkSession, folder: str) -> DataFrame:
    model = gradient_fit(spark, folder)
    found = logistic_predict(lines(spark, folder), model, 0.35, keys=KEYS)
    return found.withColumn("prediction_prob", rounded("prediction_prob", 9))


@query(
    "logistic_native",
    f"WITH {LINE_SQL}, {newton_steps('lines', 7)} {named_rows('n7', NEWTON_NAMES, 4)}",
)
def logistic_native_query(spark: SparkSession, folder: str) -> DataFrame:
    """The library's fit, which has the same optimum as Newton's method run to the end."""
    fitted = logistic_native(
        spread(lines(spark, folder).select("label", "features")), maxIter=100, tol=1e-12
    )
    model = LogisticModel([float(c) for c in fitted.coefficients], float(fitted.intercept))
    return named(spark, coefficients(model), 4)


@query(
    "logistic_weighted",
    f"WITH {LINE_SQL}, {newton_steps('lines', 7, 'quantity')} "
    f"{named_rows('n7', NEWTON_NAMES, 4)}",
)
def logistic_weighted(spark: SparkSession, folder: str) -> DataFrame:
    """Every row counts as often as its quantity says."""
    fitted = logistic_native(
        spread(lines(spark, folder).select("label", "features", "quantity")),
        weight="quantity",
        maxIter=100,
        tol=1e-12,
    )
    model = LogisticModel([float(c) for c in fitted.coefficients], float(fitted.intercept))
    return named(spark, coefficients(model), 4)


@query("logistic_multinomial")
def logistic_multinomial(spark: SparkSession, folder: str) -> DataFrame:
    """Class probabilities of every embedding under a ten-class fit."""
    table = embeddings(spark, folder)
    fitted = logistic_native(table, regParam=0.003, maxIter=400)
    vectors = table.select("vec_id", "label", array_to_vector("features").alias("features"))
    return fitted.transform(vectors).select(
        "vec_id", "label", vector_to_array("probability").alias("probability"), "prediction"
    )
