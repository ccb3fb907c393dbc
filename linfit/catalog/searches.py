"""Fits that share passes: multinomial, quasi-Newton, and searches by moments of folds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfit.catalog.base import (
    KEYS,
    LINE_SQL,
    embeddings,
    lines,
    query,
    rounded,
    sql_rounded,
)
from linfit.catalog.jobs import SONG_L2
from linfit.catalog.models import NEWTON_NAMES, named
from linfit.catalog.sql_fits import named_rows, newton_steps
from linfit.operators.elastic_net import elastic_net_path
from linfit.operators.fold_moments import fold_moments, ridge_search
from linfit.operators.instances import pack_blocks, spread
from linfit.operators.multinomial import cross_validate_multinomial, multinomial_fit
from linfit.operators.resample import with_fold
from linfit.operators.sparse import (
    sparse_instances,
    sparse_logistic_fit,
    sparse_predict,
    sparse_width,
)
from linfit.plans.jobs import song_year_job
from linfit.sources.files import read_lines, read_table
from linfit.sources.schemas import SONG_FIELDS
from linfit.sources.scratch import scratch_path

CLASSES = ("A", "N", "R")
STEPS, RATE, L2 = 4, 1.0, 0.05
FLAG_SQL = """
flags AS MATERIALIZED (
  SELECT (l_quantity - 25.5) / 14.4 AS x0, (l_discount - 0.05) / 0.03 AS x1,
         CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS flag
  FROM lineitem)"""


def softmax_steps(source: str, steps: int, rate: float, l2: float) -> str:
    """CTEs ``m0 .. m<steps>``: gradient descent of three classes on ``x0``, ``x1``."""
    names = [f"{p}{k}" for k in range(3) for p in ("u", "v", "b")]
    ctes = ["m0 AS MATERIALIZED (SELECT " + ", ".join(f"CAST(0 AS DOUBLE) AS {n}" for n in names) + ")"]
    for step in range(steps):
        odds = ", ".join(f"exp(x0 * u{k} + x1 * v{k} + b{k}) AS e{k}" for k in range(3))
        off = ", ".join(
            f"e{k} / (e0 + e1 + e2) - CASE WHEN flag = {k} THEN 1 ELSE 0 END AS r{k}" for k in range(3)
        )
        slopes = ", ".join(
            f"avg(r{k} * x0) AS du{k}, avg(r{k} * x1) AS dv{k}, avg(r{k}) AS db{k}" for k in range(3)
        )
        moved = ", ".join(
            f"{n} - {rate} * (d{n} + {0.0 if n.startswith('b') else l2} * {n}) AS {n}" for n in names
        )
        ctes.append(
            f"w{step} AS MATERIALIZED (SELECT {slopes} FROM (SELECT x0, x1, {off} FROM "
            f"(SELECT x0, x1, flag, {odds} FROM {source}, m{step})))"
        )
        ctes.append(f"m{step + 1} AS MATERIALIZED (SELECT {moved} FROM m{step}, w{step})")
    return ", ".join(ctes)


def flags(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with the return flag as one of three classes."""
    table = read_table(spark, folder, "lineitem")
    flag = F.array_position(F.array(*map(F.lit, CLASSES)), F.col("l_returnflag")) - 1
    return table.select(
        *KEYS,
        flag.cast("double").alias("label"),
        F.array((F.col("l_quantity") - 25.5) / 14.4, (F.col("l_discount") - 0.05) / 0.03).alias("features"),
    )


@query(
    "multinomial_gd_fit",
    f"WITH {FLAG_SQL}, {softmax_steps('flags', STEPS, RATE, L2)} "
    + named_rows(
        f"m{STEPS}",
        [(f"{c}_{n}", f"{p}{k}") for k, c in enumerate(CLASSES) for n, p in (("theta0", "u"), ("theta1", "v"))]
        + [(f"{c}_intercept", f"b{k} - (b0 + b1 + b2) / 3") for k, c in enumerate(CLASSES)],
        9,
    ),
)
def multinomial_gd_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Softmax regression of the return flag by plain gradient steps."""
    model = multinomial_fit(
        spread(flags(spark, folder).select("label", "features")), len(CLASSES), l2=L2,
        max_iter=STEPS, standardize=False, method="gradient", learning_rate=RATE,
    )
    values = [(f"{c}_theta{i}", float(model.theta[k, i])) for k, c in enumerate(CLASSES) for i in range(2)]
    values += [(f"{c}_intercept", float(model.intercepts[k])) for k, c in enumerate(CLASSES)]
    return named(spark, values, 9)


@query(
    "logistic_quasi_newton_fit",
    f"WITH {LINE_SQL}, {newton_steps('lines', 7)} {named_rows('n7', NEWTON_NAMES, 5)}",
)
def logistic_quasi_newton_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Two classes by quasi-Newton steps: their difference is the binary fit, run to the end."""
    model = multinomial_fit(
        spread(lines(spark, folder).select("label", "features")), 2, max_iter=200, tol=0.0
    )
    theta, intercept = model.theta[1] - model.theta[0], model.intercepts[1] - model.intercepts[0]
    values = [(f"theta{i}", float(v)) for i, v in enumerate(theta)] + [("intercept", float(intercept))]
    return named(spark, values, 5)


FOLDS, PENALTIES = 10, (0.0, 0.1, 1.0, 10.0, 100.0, 1000.0)
FOLD_SQL = f"""{LINE_SQL},
folds(f) AS (SELECT range FROM range({FOLDS})),
split AS MATERIALIZED (SELECT *, bucket % {FOLDS} AS fold FROM lines)"""


@query(
    "fold_scaling",
    f"""WITH {FOLD_SQL},
        seen AS (SELECT f, x0, x1 FROM folds JOIN split ON fold <> f)
        SELECT CAST(f AS INTEGER) AS fold, CAST(0 AS INTEGER) AS i,
               {sql_rounded('avg(x0)', 9)} AS mean, {sql_rounded('stddev_samp(x0)', 9)} AS deviation
        FROM seen GROUP BY f
        UNION ALL SELECT CAST(f AS INTEGER), CAST(1 AS INTEGER), {sql_rounded('avg(x1)', 9)},
                         {sql_rounded('stddev_samp(x1)', 9)} FROM seen GROUP BY f""",
)
def fold_scaling(spark: SparkSession, folder: str) -> DataFrame:
    """The scaler of every training split, from one pass of moments by fold."""
    table = with_fold(lines(spark, folder), KEYS, FOLDS, hash_fn="md5")
    with pack_blocks(spread(table.select("label", "features", "fold")), fold="fold") as blocks:
        moments = fold_moments(blocks, FOLDS)
    rows = []
    for f in range(FOLDS):
        mean, deviation = moments.scaling(f)
        rows += [(f, i, float(m), float(s)) for i, (m, s) in enumerate(zip(mean, deviation))]
    out = spark.createDataFrame(rows, schema="fold int, i int, mean double, deviation double")
    return out.select("fold", "i", rounded("mean", 9).alias("mean"), rounded("deviation", 9).alias("deviation"))


RIDGE_CV_SQL = f"""{FOLD_SQL},
penalties(l2) AS (VALUES {", ".join(f"(CAST({v} AS DOUBLE))" for v in PENALTIES)}),
means AS MATERIALIZED (
  SELECT f, avg(x0) AS m0, avg(x1) AS m1, avg(price) AS my FROM folds JOIN split ON fold <> f GROUP BY f),
terms AS MATERIALIZED (
  SELECT f, sum((x0 - m0) * (x0 - m0)) AS a, sum((x0 - m0) * (x1 - m1)) AS b,
         sum((x1 - m1) * (x1 - m1)) AS c, sum((x0 - m0) * (price - my)) AS p,
         sum((x1 - m1) * (price - my)) AS q
  FROM means JOIN split ON fold <> f GROUP BY f),
theta AS MATERIALIZED (
  SELECT f, l2, ((c + l2) * p - b * q) / ((a + l2) * (c + l2) - b * b) AS t0,
         ((a + l2) * q - b * p) / ((a + l2) * (c + l2) - b * b) AS t1
  FROM terms, penalties),
scores AS MATERIALIZED (
  SELECT l2, theta.f AS fold, sqrt(avg(pow(price - my - (x0 - m0) * t0 - (x1 - m1) * t1, 2))) AS rmse
  FROM theta JOIN means ON theta.f = means.f JOIN split ON split.fold = theta.f GROUP BY l2, theta.f)"""


def ridge_folds(spark: SparkSession, folder: str):
    table = lines(spark, folder).withColumn("label", F.col("price"))
    return ridge_search(spread(with_fold(table, KEYS, FOLDS, hash_fn="md5")), FOLDS, PENALTIES)


@query(
    "ridge_cv_scores",
    f"""WITH {RIDGE_CV_SQL}
        SELECT l2 AS lambda, CAST(fold AS INTEGER) AS fold, {sql_rounded('rmse', 9)} AS rmse FROM scores""",
)
def ridge_cv_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out errors of ten folds and six penalties, from one pass."""
    found = spark.createDataFrame(ridge_folds(spark, folder).fold_scores, schema="lambda double, fold int, rmse double")
    return found.withColumn("rmse", rounded("rmse", 9))


@query(
    "ridge_cv_best",
    f"""WITH {RIDGE_CV_SQL}
        SELECT l2 AS lambda, {sql_rounded('mean', 9)} AS rmse
        FROM (SELECT l2, round(sum(rmse) / {FOLDS}, 12) AS mean FROM scores GROUP BY l2)
        ORDER BY mean, l2 LIMIT 1""",
)
def ridge_cv_best(spark: SparkSession, folder: str) -> DataFrame:
    found = ridge_folds(spark, folder)
    mean = float(np.sum([s for v, _, s in found.fold_scores if v == found.best]) / FOLDS)
    out = spark.createDataFrame([(found.best, mean)], schema="lambda double, rmse double")
    return out.withColumn("rmse", rounded("rmse", 9))


@query("cv_multinomial_logloss")
def cv_multinomial_logloss(spark: SparkSession, folder: str) -> DataFrame:
    """Ten folds and six penalties of a ten-class fit in shared passes; the lowest mean wins."""
    table = with_fold(embeddings(spark, folder), ["vec_id"], 10)
    rows = table.select(F.col("label").cast("double").alias("label"), "fold", "features")
    found = cross_validate_multinomial(
        spread(rows), 10, (0.000003, 0.00003, 0.0003, 0.003, 0.03, 0.3), 10, max_iter=400
    )
    return spark.createDataFrame(list(found.means.items()), schema="lambda double, score double")


@query("job_song_year")
def job_song_year(spark: SparkSession, folder: str) -> DataFrame:
    """Ridge regression on text lines of all 91 numbers: every mean, and own and library errors."""
    path = scratch_path(spark, "song-lines")
    keys = [F.col(c).cast("long") for c in ("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")]
    # Each field has a modulus of its own, so no two are alike. One function over the fields: written
    # out, their code is longer than the JVM compiles.
    noise = F.transform(
        F.sequence(F.lit(1).cast("long"), F.lit(SONG_FIELDS - 1).cast("long")),
        lambda j: F.pmod(keys[0] * (j + 3) + keys[1] * j * j + keys[2] * (2 * j + 1), 89 + 2 * j) + keys[3],
    ).cast("array<string>")
    year = (1920 + F.pmod(keys[0], F.lit(89)) + keys[3]).cast("string")
    read_table(spark, folder, "lineitem").select(F.concat_ws(",", year, noise).alias("value")).write.text(path)
    found = song_year_job(read_lines(spark, path), 0.3, SONG_L2)
    means = spark.createDataFrame([(f"mean{i}", float(v)) for i, v in enumerate(found.means)], schema="name string, value double")
    errors = F.expr("stack(3, 'own_rmse', own_rmse, 'native_rmse', native_rmse, 'native_train_rmse', native_train_rmse)")
    return means.union(found.scores.select(errors))


@query(
    "logistic_sparse_weighted",
    f"WITH {LINE_SQL}, {newton_steps('lines', 7, 'quantity')} {named_rows('n7', NEWTON_NAMES, 5)}",
)
def logistic_sparse_weighted(spark: SparkSession, folder: str) -> DataFrame:
    """The own weighted fit on compressed rows: every row counts as often as its quantity says."""
    rows = sparse_instances(lines(spark, folder), "label", ["x0", "x1"], weight="quantity")
    model = sparse_logistic_fit(spread(rows), 2, max_iter=200, tol=0.0)
    values = [(f"theta{i}", float(v)) for i, v in enumerate(model.theta)] + [("intercept", model.intercept)]
    return named(spark, values, 5)


@query("logistic_high_cardinality")
def logistic_high_cardinality(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by customer and status, a position for every customer; mean scores by label."""
    table = read_table(spark, folder, "orders").withColumn("label", F.expr("cast(o_orderpriority < '3' as int)"))
    top = int(table.agg(F.max("o_custkey")).first()[0] or 0) + 1
    state = F.array_position(F.array(*map(F.lit, "FOP")), F.col("o_orderstatus")) - 1
    table = table.withColumns(
        {"customer": F.col("o_custkey"), "state": state, "price": F.col("o_totalprice") / 100000}
    )
    kinds = [("customer", top), ("state", 3)]
    rows = sparse_instances(table, "label", ["price"], kinds, weight="o_totalprice")
    model = sparse_logistic_fit(spread(rows), sparse_width(["price"], kinds), l2=1e-4, max_iter=60)
    scored = sparse_predict(rows, model)
    return scored.groupBy("label").agg(F.count("*").alias("rows"), F.round(F.avg("prediction_prob"), 6).alias("mean_prob"))


NET_PENALTIES, NET_MIX, NET_ROUNDS = (0.3, 0.01, 0.001), 0.5, 30
_NET_MOVES = """SELECT l1, l2, t0, greatest(abs(d - b * t0) - l1, 0) * sign(d - b * t0) / (e + l2) AS t1, r + 1 AS r
  FROM (SELECT l1, l2, greatest(abs(c - b * t1) - l1, 0) * sign(c - b * t1) / (a + l2) AS t0, r FROM net"""


@query(
    "elastic_net_path",
    f"""WITH RECURSIVE {LINE_SQL},
        mean AS MATERIALIZED (SELECT avg(x0) AS m0, avg(x1) AS m1, avg(price) AS my FROM lines),
        moment AS MATERIALIZED (
          SELECT avg((x0 - m0) * (x0 - m0)) AS a, avg((x0 - m0) * (x1 - m1)) AS b,
                 avg((x1 - m1) * (x1 - m1)) AS e, avg((x0 - m0) * (price - my)) AS c,
                 avg((x1 - m1) * (price - my)) AS d FROM lines, mean),
        net AS (
          SELECT p * {NET_MIX} AS l1, p * (1 - {NET_MIX}) AS l2, CAST(0 AS DOUBLE) AS t0, CAST(0 AS DOUBLE) AS t1, 0 AS r
          FROM (VALUES {", ".join(f"(CAST({p} AS DOUBLE))" for p in NET_PENALTIES)}) AS penalties(p)
          UNION ALL
          {_NET_MOVES}, moment WHERE r < {NET_ROUNDS}), moment)
        SELECT l1 / {NET_MIX} AS lambda, {sql_rounded('t0', 9)} AS theta0, {sql_rounded('t1', 9)} AS theta1,
               {sql_rounded('my - t0 * m0 - t1 * m1', 9)} AS intercept
        FROM net, mean WHERE r = {NET_ROUNDS}""",
)
def elastic_net_path_query(spark: SparkSession, folder: str) -> DataFrame:
    """Elastic-net fits of the price at several penalties, from one pass."""
    table = lines(spark, folder).withColumn("label", F.col("price"))
    found = elastic_net_path(spread(table.select("label", "features")), NET_PENALTIES, NET_MIX)
    rows = [(p, *map(float, fit.theta), fit.intercept) for p, fit in found.items()]
    out = spark.createDataFrame(rows, schema="lambda double, theta0 double, theta1 double, intercept double")
    return out.select("lambda", *(rounded(c, 9).alias(c) for c in ("theta0", "theta1", "intercept")))
