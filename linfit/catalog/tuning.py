"""Splits, folds, grids and searches."""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import PolynomialExpansion, StandardScaler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linfit.catalog.aggregates import COUNTS_SQL, SCORES_SQL
from linfit.catalog.base import (
    KEY_LIST,
    KEYS,
    LINE_SQL,
    TEST_BUCKETS,
    embeddings,
    lines,
    query,
    rounded,
    sql_rounded,
)
from linfit.catalog.sql_fits import gradient_steps
from linfit.functions.features import monomials
from linfit.operators.instances import pack_blocks, spread
from linfit.operators.logistic import Fit, fit_many, graded_terms
from linfit.operators.metrics import AreaUnderRoc
from linfit.operators.resample import (
    bernoulli_sample,
    holdout,
    random_split,
    union_all,
    with_fold,
)
from linfit.plans.tuning import (
    CountedScaler,
    CVResult,
    best_score,
    cross_entropy_evaluator,
    cross_validate_logistic,
    cross_validate_native,
    native_scores,
    param_grid,
    score_best,
)
from linfit.sources.files import read_table

DEGREES, LAMBDAS, FOLDS, ITERATIONS = (1, 2, 3), (0.001, 0.01, 0.1, 0.5), 3, 100
RATE = 1.0
THRESHOLD = 0.34


@query(
    "holdout_split",
    f"""WITH {LINE_SQL}
        SELECT {KEY_LIST}, CASE WHEN bucket < {TEST_BUCKETS} THEN 'test' ELSE 'train' END AS part
        FROM lines""",
)
def holdout_split(spark: SparkSession, folder: str) -> DataFrame:
    train, test = holdout(lines(spark, folder).select(*KEYS), KEYS, 0.3, "md5")
    return union_all(
        [train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test"))]
    )


@query("random_split", f"SELECT {KEY_LIST} FROM lineitem")
def random_split_query(spark: SparkSession, folder: str) -> DataFrame:
    """Both sides of a random split together hold every row once."""
    return union_all(random_split(lines(spark, folder).select(*KEYS)))


@query(
    "kfold_assign",
    f"WITH {LINE_SQL} SELECT {KEY_LIST}, CAST(bucket % {FOLDS} AS INTEGER) AS fold FROM lines",
)
def kfold_assign(spark: SparkSession, folder: str) -> DataFrame:
    return with_fold(lines(spark, folder).select(*KEYS), KEYS, FOLDS, hash_fn="md5")


@query(
    "kfold_pairs",
    f"""WITH {LINE_SQL}
        SELECT CAST(f AS INTEGER) AS fold, count(*) FILTER (WHERE bucket % {FOLDS} <> f) AS train,
               count(*) FILTER (WHERE bucket % {FOLDS} = f) AS test
        FROM lines CROSS JOIN range({FOLDS}) AS folds(f) GROUP BY f""",
)
def kfold_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes of every (train, test) pair from one count per fold; the window spans k rows."""
    table = with_fold(lines(spark, folder).select(*KEYS), KEYS, FOLDS, hash_fn="md5")
    counts = table.groupBy("fold").agg(F.count(F.lit(1)).alias("test"))
    whole = F.sum("test").over(Window.partitionBy())
    return counts.select("fold", (whole - F.col("test")).alias("train"), "test")


@query(
    "union_all",
    """SELECT c_custkey AS k, c_nationkey AS nation, c_acctbal AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier
       UNION ALL SELECT c_custkey, c_nationkey, c_acctbal FROM customer""",
)
def union_all_query(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("k"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
    )
    supplier = read_table(spark, folder, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return union_all([customer, supplier, customer])


@query("bernoulli_sample")
def bernoulli_sample_query(spark: SparkSession, folder: str) -> DataFrame:
    return bernoulli_sample(lines(spark, folder).select(*KEYS, "label", "x0", "x1"), 0.1)


def _terms_sql() -> list[tuple[str, int]]:
    """The polynomial terms in the library's order, each with the lowest degree that has it."""
    return [("*".join(f"x{i}" for i in t), len(t)) for t in monomials(2, max(DEGREES))]


def _points_sql(folds: list[int]) -> str:
    """One row per fit of the grid, with the fold it does not see."""
    rows = [(d, v, f) for d in DEGREES for v in LAMBDAS for f in folds]
    return "points(fit, degree, l2, held) AS (VALUES " + ", ".join(
        f"({i}, {d}, CAST({v} AS DOUBLE), {f})" for i, (d, v, f) in enumerate(rows)
    ) + ")"


RATE_SQL = f"(SELECT CAST({RATE} AS DOUBLE) / count(*) FROM lines)"


@query(
    "param_grid",
    f"""WITH {LINE_SQL}, {_points_sql([-2])}, numbered AS (SELECT *, -1 AS fold FROM lines),
        {gradient_steps('numbered', 'points', _terms_sql(), ITERATIONS, RATE_SQL)}
        SELECT CAST(degree AS INTEGER) AS degree, l2 AS lambda, {sql_rounded('last', 9)} AS loss
        FROM s{ITERATIONS}""",
)
def param_grid_query(spark: SparkSession, folder: str) -> DataFrame:
    """The training loss at every grid point, all points fitted in the same passes."""
    table = lines(spark, folder)
    grid = param_grid(DEGREES, LAMBDAS)
    with pack_blocks(spread(table.select("label", "features")), merge=True) as blocks:
        fits = [Fit(graded_terms(blocks.width, d), v) for d, v in grid]
        fit_many(blocks, fits, max_iter=ITERATIONS, learning_rate=RATE / blocks.rows)
    rows = [(d, v, fit.losses[-1]) for (d, v), fit in zip(grid, fits)]
    out = spark.createDataFrame(rows, schema="degree int, lambda double, loss double")
    return out.select("degree", "lambda", rounded("loss", 9).alias("loss"))


SEEN_SQL = f"seen AS (SELECT * FROM lines WHERE bucket >= {TEST_BUCKETS})"


def _search_sql(source: str = "lines") -> str:
    """Fold scores of every grid point as ``fold_scores``, and their means as ``means``.

    ``source`` is ``lines``, or ``seen`` for the training split alone.
    """
    z = " + ".join(f"f{i} * t{i}" for i in range(len(_terms_sql()))) + " + b"
    return f"""{LINE_SQL}, {SEEN_SQL}, {_points_sql(list(range(FOLDS)))},
numbered AS (SELECT *, bucket % {FOLDS} AS fold FROM {source}),
{gradient_steps('numbered', 'points', _terms_sql(), ITERATIONS, RATE_SQL)},
fold_scores AS MATERIALIZED (
  SELECT degree, l2, held,
         avg(CASE WHEN (CASE WHEN 1 / (1 + exp(-({z}))) >= {THRESHOLD} THEN 1 ELSE 0 END) = label
             THEN 1.0 ELSE 0.0 END) AS score
  FROM basis JOIN s{ITERATIONS} ON held = fold GROUP BY degree, l2, held),
means AS MATERIALIZED (
  SELECT degree, l2, round(sum(score) / {FOLDS}, 12) AS score FROM fold_scores
  GROUP BY degree, l2)"""


def search(spark: SparkSession, folder: str, score_type: str = "accuracy") -> CVResult:
    table = lines(spark, folder)
    return search_on(with_fold(table, KEYS, FOLDS, hash_fn="md5"), table.count(), score_type)


def search_on(table: DataFrame, rows: int, score_type: str = "accuracy") -> CVResult:
    return cross_validate_logistic(
        spread(table.select("label", "features", "fold")),
        k=FOLDS,
        grid=param_grid(DEGREES, LAMBDAS),
        max_iter=ITERATIONS,
        learning_rate=RATE / rows,
        score_type=score_type,
        threshold=THRESHOLD,
    )


@query(
    "cv_logistic_scores",
    f"""WITH {_search_sql()}
        SELECT CAST(degree AS INTEGER) AS degree, l2 AS lambda, CAST(held AS INTEGER) AS fold,
               {sql_rounded('score', 9)} AS score FROM fold_scores""",
)
def cv_logistic_scores(spark: SparkSession, folder: str) -> DataFrame:
    found = search(spark, folder).folds()
    return found.withColumn("score", rounded("score", 9))


_MEANS_SQL = f"""SELECT CAST(degree AS INTEGER) AS degree, l2 AS lambda,
                        {sql_rounded('score', 9)} AS score FROM means"""


@query("cv_mean_scores", f"WITH {_search_sql()} {_MEANS_SQL}")
def cv_mean_scores(spark: SparkSession, folder: str) -> DataFrame:
    return search(spark, folder).scores().withColumn("score", rounded("score", 9))


_BEST_ORDER = "ORDER BY score DESC NULLS LAST, degree, l2 LIMIT 1"


@query("cv_best", f"WITH {_search_sql()} {_MEANS_SQL} {_BEST_ORDER}")
def cv_best(spark: SparkSession, folder: str) -> DataFrame:
    found = best_score(search(spark, folder).scores())
    return found.withColumn("score", rounded("score", 9))


def _refit_sql(source: str = "lines") -> str:
    steps = gradient_steps("all_rows", "winner", _terms_sql(), ITERATIONS, RATE_SQL)
    steps = re.sub(r"\b(basis|[sp]\d+)\b", r"r\1", steps)
    return f"""{_search_sql(source)},
winner AS MATERIALIZED (SELECT 0 AS fit, degree, l2, -2 AS held FROM means {_BEST_ORDER}),
all_rows AS (SELECT *, -1 AS fold FROM {source}),
{steps}"""


@query(
    "cv_logistic_best",
    f"WITH {_refit_sql()} "
    + " UNION ALL ".join(
        f"""SELECT CAST(degree AS INTEGER) AS degree, l2 AS lambda, '{n}' AS name,
            {sql_rounded(c, 8)} AS value FROM rs{ITERATIONS} WHERE degree >= {low}"""
        for n, c, low in [("intercept", "b", 1)]
        + [(e, f"t{i}", low) for i, (e, low) in enumerate(_terms_sql())]
    ),
)
def cv_logistic_best(spark: SparkSession, folder: str) -> DataFrame:
    """The winner's coefficients after the refit on all rows."""
    found = search(spark, folder)
    names = [e for e, low in _terms_sql() if low <= found.best[0]]
    values = [("intercept", found.model.intercept), *zip(names, found.model.theta)]
    table = spark.createDataFrame(
        [(*found.best, n, v) for n, v in values],
        schema="degree int, lambda double, name string, value double",
    )
    return table.withColumn("value", rounded("value", 8))


_HOLDOUT_Z = " + ".join(f"{e} * t{i}" for i, (e, _) in enumerate(_terms_sql())) + " + b"


@query(
    "cv_best_holdout_score",
    f"""WITH {_refit_sql('seen')}, said AS (
          SELECT label, CASE WHEN 1 / (1 + exp(-({_HOLDOUT_Z}))) >= {THRESHOLD} THEN 1 ELSE 0 END
                 AS prediction FROM lines, rs{ITERATIONS} WHERE bucket < {TEST_BUCKETS}),
        counts AS ({COUNTS_SQL})
        SELECT *, {SCORES_SQL} FROM counts""",
)
def cv_best_holdout_score(spark: SparkSession, folder: str) -> DataFrame:
    table = lines(spark, folder)
    train, test = holdout(table, KEYS, 0.3, "md5")
    result = search_on(with_fold(train, KEYS, FOLDS, hash_fn="md5"), table.count())
    found = score_best(test, result, threshold=THRESHOLD)
    return found.withColumns({c: rounded(c, 10) for c in ("accuracy", "precision", "recall")})


@query("cv_native_auc")
def cv_native_auc(spark: SparkSession, folder: str) -> DataFrame:
    """The library's search over degree and regularisation, by area under the ROC curve.

    It reads its rows again for every step of every fit, so equal ones become one with a count.
    """
    table = with_fold(lines(spark, folder), KEYS, FOLDS, hash_fn="md5")
    counted = table.groupBy("label", "fold", "features").agg(F.count("*").cast("double").alias("rows"))
    table = counted.select("label", "fold", "rows", array_to_vector("features").alias("features"))
    table = table.coalesce(spark.sparkContext.defaultParallelism)
    expand = PolynomialExpansion(inputCol="features", outputCol="terms")
    scale = CountedScaler("terms", "scaled", "rows")
    fit = LogisticRegression(featuresCol="scaled", weightCol="rows", standardization=False, maxIter=40)
    model = cross_validate_native(
        table,
        [expand, scale, fit],
        [(expand.degree, [1, 2, 3]), (fit.regParam, [0.1, 0.01])],
        AreaUnderRoc(rows="rows"),
        FOLDS,
        fold="fold",
    )
    return native_scores(spark, model)


@query("cv_native_logloss")
def cv_native_logloss(spark: SparkSession, folder: str) -> DataFrame:
    """The library's search by multiclass cross-entropy; the lowest mean wins."""
    table = with_fold(embeddings(spark, folder), ["vec_id"], FOLDS).select(
        F.col("label").cast("double").alias("label"),
        "fold",
        array_to_vector("features").alias("raw"),
    )
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    fit = LogisticRegression(maxIter=400)
    model = cross_validate_native(
        spread(table),
        [scaler, fit],
        [(fit.regParam, [0.003, 0.3])],
        cross_entropy_evaluator(),
        FOLDS,
        fold="fold",
    )
    return native_scores(spark, model)
