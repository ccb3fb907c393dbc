"""Sums, moments, losses and scores over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfit.catalog.base import (
    ELEMENT_SQL,
    LINE_SQL,
    embeddings,
    lines,
    query,
    rounded,
    sql_rounded,
)
from linfit.functions.features import with_bias
from linfit.functions.vectors import scale, total
from linfit.operators.logistic import (
    binary_cross_entropy,
    fused_gradient_loss,
    logistic_hessian,
    logloss_gradient,
)
from linfit.operators.metrics import (
    area_under_roc,
    binary_scores,
    confusion_matrix,
    multiclass_accuracy,
    multiclass_cross_entropy,
    rmse,
)
from linfit.operators.moments import (
    cross_moment,
    gram,
    merge_moments,
    normalize_moments,
    ridge_penalty,
    vector_sum,
    xty,
)

# A fixed point at which gradients, losses and Hessians are evaluated.
THETA, INTERCEPT = (0.3, -0.2), 0.1

MARGIN_SQL = f"""{LINE_SQL},
margins AS MATERIALIZED (
  SELECT *, 1 / (1 + exp(-z)) AS sigma, label - 1 / (1 + exp(-z)) AS miss,
         CASE WHEN label = 1 THEN ln(1 + exp(-z)) ELSE ln(1 + exp(z)) END AS loss
  FROM (SELECT *, x0 * 0.3 - x1 * 0.2 + 0.1 AS z FROM lines))"""


@query(
    "vector_sum",
    f"WITH {ELEMENT_SQL} SELECT pos AS i, {sql_rounded('sum(v)', 7)} AS v "
    "FROM elements GROUP BY pos",
)
def vector_sum_query(spark: SparkSession, folder: str) -> DataFrame:
    return vector_sum(embeddings(spark, folder)).select("i", rounded("v", 7).alias("v"))


@query(
    "gram_matrix",
    f"""WITH {LINE_SQL}
        SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, {sql_rounded('v', 4)} AS v FROM (
          SELECT 0 AS i, 0 AS j, sum(x0 * x0) AS v FROM lines
          UNION ALL SELECT 1, 0, sum(x1 * x0) FROM lines
          UNION ALL SELECT 1, 1, sum(x1 * x1) FROM lines
          UNION ALL SELECT 2, 0, sum(x0) FROM lines
          UNION ALL SELECT 2, 1, sum(x1) FROM lines
          UNION ALL SELECT 2, 2, CAST(count(*) AS DOUBLE) FROM lines)""",
)
def gram_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Narrow case: generated sums."""
    biased = lines(spark, folder).select(with_bias("features").alias("features"))
    return gram(biased, width=3).select("i", "j", rounded("v", 4).alias("v"))


PAIR_SQL = f"""{ELEMENT_SQL},
pairs AS MATERIALIZED (
  SELECT a.vec_id, a.label, a.pos AS i, b.pos AS j, a.v * b.v AS v
  FROM elements a JOIN elements b ON a.vec_id = b.vec_id AND b.pos <= a.pos)"""


@query(
    "gram_matrix_wide",
    f"WITH {PAIR_SQL} SELECT i, j, {sql_rounded('sum(v)', 6)} AS v FROM pairs GROUP BY i, j",
)
def gram_matrix_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Wide case: one triangle per partition."""
    return gram(embeddings(spark, folder)).select("i", "j", rounded("v", 6).alias("v"))


@query(
    "xty",
    f"WITH {ELEMENT_SQL} SELECT pos AS i, {sql_rounded('sum(v * label)', 6)} AS v "
    "FROM elements GROUP BY pos",
)
def xty_query(spark: SparkSession, folder: str) -> DataFrame:
    return xty(embeddings(spark, folder)).select("i", rounded("v", 6).alias("v"))


@query(
    "cross_moment",
    f"""WITH {ELEMENT_SQL}
        SELECT a.pos AS i, b.pos AS j, {sql_rounded('sum(a.v * b.w)', 6)} AS v
        FROM elements a JOIN elements b ON a.vec_id = b.vec_id GROUP BY a.pos, b.pos""",
)
def cross_moment_query(spark: SparkSession, folder: str) -> DataFrame:
    table = embeddings(spark, folder).withColumn("mirrored", F.reverse("features"))
    return cross_moment(table, "features", "mirrored").select(
        "i", "j", rounded("v", 6).alias("v")
    )


@query(
    "merge_moments",
    f"WITH {PAIR_SQL} SELECT i, j, {sql_rounded('sum(v)', 6)} AS v FROM pairs GROUP BY i, j",
)
def merge_moments_query(spark: SparkSession, folder: str) -> DataFrame:
    """Moments of even and odd classes, merged into the moments of all rows."""
    table = embeddings(spark, folder)
    parts = [gram(table.filter(F.col("label") % 2 == side)) for side in (0, 1)]
    return merge_moments(*parts).select("i", "j", rounded("v", 6).alias("v"))


@query(
    "normalize_moments",
    f"""WITH {PAIR_SQL} SELECT i, j, {sql_rounded('sum(v) / count(*)', 9)} AS v
        FROM pairs GROUP BY i, j""",
)
def normalize_moments_query(spark: SparkSession, folder: str) -> DataFrame:
    table = embeddings(spark, folder)
    mean = normalize_moments(gram(table), 1.0 / table.count())
    return mean.select("i", "j", rounded("v", 9).alias("v"))


@query(
    "ridge_penalty",
    f"""WITH {PAIR_SQL}
        SELECT i, j, {sql_rounded('sum(v) + CASE WHEN i = j THEN 0.5 ELSE 0 END', 6)} AS v
        FROM pairs GROUP BY i, j""",
)
def ridge_penalty_query(spark: SparkSession, folder: str) -> DataFrame:
    penalised = ridge_penalty(gram(embeddings(spark, folder)), 0.5)
    return penalised.select("i", "j", rounded("v", 6).alias("v"))


_GRADIENT_SQL = ", ".join(
    f"{sql_rounded(e, 5)} AS {n}"
    for n, e in (
        ("g0", "sum(-miss * x0)"),
        ("g1", "sum(-miss * x1)"),
        ("g_intercept", "sum(-miss)"),
    )
)


@query("logloss_gradient", f"WITH {MARGIN_SQL} SELECT {_GRADIENT_SQL} FROM margins")
def logloss_gradient_query(spark: SparkSession, folder: str) -> DataFrame:
    found = logloss_gradient(lines(spark, folder), THETA, INTERCEPT)
    return found.select(*[rounded(c, 5).alias(c) for c in found.columns])


@query(
    "binary_cross_entropy",
    f"WITH {MARGIN_SQL} SELECT {sql_rounded('avg(loss)', 9)} AS cross_entropy FROM margins",
)
def binary_cross_entropy_query(spark: SparkSession, folder: str) -> DataFrame:
    found = binary_cross_entropy(lines(spark, folder), THETA, INTERCEPT)
    return found.select(rounded("cross_entropy", 9).alias("cross_entropy"))


@query(
    "fused_gradient_loss",
    f"""WITH {MARGIN_SQL}
        SELECT {_GRADIENT_SQL}, {sql_rounded('sum(loss)', 5)} AS loss, count(*) AS n
        FROM margins""",
)
def fused_gradient_loss_query(spark: SparkSession, folder: str) -> DataFrame:
    found = fused_gradient_loss(lines(spark, folder), THETA, INTERCEPT)
    return found.select(*[rounded(c, 5).alias(c) for c in found.columns[:-1]], "n")


@query(
    "logistic_hessian",
    f"""WITH {MARGIN_SQL}, weights AS (SELECT *, sigma * (1 - sigma) AS s FROM margins)
        SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, {sql_rounded('v', 5)} AS v FROM (
          SELECT 0 AS i, 0 AS j, sum(s * x0 * x0) AS v FROM weights
          UNION ALL SELECT 1, 0, sum(s * x1 * x0) FROM weights
          UNION ALL SELECT 1, 1, sum(s * x1 * x1) FROM weights
          UNION ALL SELECT 2, 0, sum(s * x0) FROM weights
          UNION ALL SELECT 2, 1, sum(s * x1) FROM weights
          UNION ALL SELECT 2, 2, sum(s) FROM weights)""",
)
def logistic_hessian_query(spark: SparkSession, folder: str) -> DataFrame:
    biased = lines(spark, folder).select(with_bias("features").alias("features"))
    found = logistic_hessian(biased, (*THETA, INTERCEPT))
    return found.select("i", "j", rounded("v", 5).alias("v"))


# A crude classifier of returned items by quantity and price, to have something to score.
SAID_SQL = f"""{LINE_SQL},
said AS (SELECT label, price, x0,
                CASE WHEN x0 + x1 >= price THEN 1 ELSE 0 END AS prediction FROM lines)"""
COUNTS_SQL = """
  SELECT count(*) FILTER (WHERE prediction = 1 AND label = 1) AS true_positive,
         count(*) FILTER (WHERE prediction = 0 AND label = 0) AS true_negative,
         count(*) FILTER (WHERE prediction = 1 AND label = 0) AS false_positive,
         count(*) FILTER (WHERE prediction = 0 AND label = 1) AS false_negative
  FROM said"""


def _said(spark: SparkSession, folder: str) -> DataFrame:
    guess = F.when(F.col("x0") + F.col("x1") >= F.col("price"), 1.0).otherwise(0.0)
    return lines(spark, folder).withColumn("prediction", guess)


@query("confusion_matrix", f"WITH {SAID_SQL} {COUNTS_SQL}")
def confusion_matrix_query(spark: SparkSession, folder: str) -> DataFrame:
    return confusion_matrix(_said(spark, folder))


SCORES_SQL = ", ".join(
    f"{sql_rounded(f'CAST({part} AS DOUBLE) / nullif({whole}, 0)', 10)} AS {name}"
    for name, part, whole in (
        (
            "accuracy",
            "(true_positive + true_negative)",
            "(true_positive + true_negative + false_positive + false_negative)",
        ),
        ("precision", "true_positive", "(true_positive + false_positive)"),
        ("recall", "true_positive", "(true_positive + false_negative)"),
    )
)


@query("binary_scores", f"WITH {SAID_SQL} SELECT {SCORES_SQL} FROM ({COUNTS_SQL})")
def binary_scores_query(spark: SparkSession, folder: str) -> DataFrame:
    found = binary_scores(confusion_matrix(_said(spark, folder)))
    return found.select(*[rounded(c, 10).alias(c) for c in found.columns])


@query(
    "rmse",
    f"WITH {SAID_SQL} SELECT {sql_rounded('sqrt(avg(pow(price - x0, 2)))', 9)} AS rmse FROM said",
)
def rmse_query(spark: SparkSession, folder: str) -> DataFrame:
    found = rmse(lines(spark, folder), "price", "x0")
    return found.select(rounded("rmse", 9).alias("rmse"))


@query(
    "multiclass_accuracy",
    f"""WITH {ELEMENT_SQL},
        best AS (SELECT vec_id, label, arg_max(pos, v) AS prediction
                 FROM (SELECT * FROM elements WHERE pos < 10 ORDER BY vec_id, pos)
                 GROUP BY vec_id, label)
        SELECT {sql_rounded('avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END)', 10)}
               AS accuracy FROM best""",
)
def multiclass_accuracy_query(spark: SparkSession, folder: str) -> DataFrame:
    """The position of the largest of the first ten elements, taken as the predicted class."""
    ten = F.slice("features", 1, 10)
    guess = (F.array_position(ten, F.array_max(ten)) - 1).cast("double")
    found = multiclass_accuracy(embeddings(spark, folder).withColumn("prediction", guess))
    return found.select(rounded("accuracy", 10).alias("accuracy"))


@query(
    "multiclass_cross_entropy",
    f"""WITH {ELEMENT_SQL},
        shares AS (SELECT *, CASE WHEN v > 0 THEN v ELSE 0 END
                          / sum(CASE WHEN v > 0 THEN v ELSE 0 END) OVER (PARTITION BY vec_id) AS p
                   FROM elements)
        SELECT {sql_rounded('avg(-ln(greatest(least(p, 1 - 1e-15), 1e-15)))', 9)} AS cross_entropy
        FROM shares WHERE pos = label""",
)
def multiclass_cross_entropy_query(spark: SparkSession, folder: str) -> DataFrame:
    """Positive parts as shares: about half the classes get probability 0 and meet the clip."""
    positive = F.transform("features", lambda v: F.greatest(v, F.lit(0.0)))
    table = embeddings(spark, folder).withColumn("positive", positive)
    shares = scale(F.col("positive"), F.lit(1.0) / total(F.col("positive")))
    found = multiclass_cross_entropy(table.withColumn("probability", shares))
    return found.select(rounded("cross_entropy", 9).alias("cross_entropy"))


@query(
    "area_under_roc",
    f"""WITH {LINE_SQL},
        groups AS (SELECT quantity, sum(label) AS pos, sum(1 - label) AS neg
                   FROM lines GROUP BY quantity),
        below AS (SELECT pos, neg,
                         sum(neg) OVER (ORDER BY quantity ROWS UNBOUNDED PRECEDING) - neg AS less
                  FROM groups)
        SELECT {sql_rounded('sum(pos * (less + neg / 2)) / (sum(pos) * sum(neg))', 9)} AS auc
        FROM below""",
)
def area_under_roc_query(spark: SparkSession, folder: str) -> DataFrame:
    """Quantity as the score: few distinct values, so most pairs are ties."""
    value = area_under_roc(lines(spark, folder), "label", "quantity")
    return spark.createDataFrame([(round(value, 9) + 0.0,)], schema="auc double")
