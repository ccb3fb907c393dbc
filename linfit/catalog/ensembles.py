"""Bootstrap replicates, mini-batches, and ROC areas of many scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfit.catalog.base import KEY_LIST, KEYS, LINE_SQL, lines, query, rounded, sql_rounded
from linfit.catalog.models import NEWTON_NAMES, named
from linfit.catalog.sql_fits import named_rows, newton_steps, solve3
from linfit.catalog.tuning import ITERATIONS, _search_sql, _terms_sql, search
from linfit.operators.bagging import POISSON, BaggedModel, bagged_logistic_fit, poisson_draws
from linfit.operators.instances import spread
from linfit.operators.metrics import areas_under_roc
from linfit.operators.minibatch import batch_order, minibatch_logistic_fit

REPLICATES, NEWTON_STEPS = 12, 6
DRAW_SQL = f"""{LINE_SQL},
replicates(replicate) AS (SELECT CAST(range AS INTEGER) FROM range({REPLICATES})),
hashed AS MATERIALIZED (
  SELECT replicate, label, x0, x1,
         CAST(('0x' || substr(md5(concat_ws('|', {KEY_LIST}, replicate)), 1, 8)) AS BIGINT) AS u
  FROM lines, replicates),
drawn AS MATERIALIZED (
  SELECT replicate, label, x0, x1, {" + ".join(f"CAST(u >= {t} AS INTEGER)" for t in POISSON)} AS times
  FROM hashed)"""


def replicate_newton(iterations: int) -> str:
    """CTEs ``b0 .. b<iterations>``: Newton's steps of every replicate of ``drawn``."""
    zero, x, moved = "CAST(0 AS DOUBLE)", ("x0", "x1", "1"), solve3("h", "g")
    ctes = [f"b0 AS MATERIALIZED (SELECT replicate, {zero} AS t0, {zero} AS t1, {zero} AS t2 FROM replicates)"]
    for step in range(iterations):
        sums = [f"sum(times * s * (1 - s) * {x[i]} * {x[j]}) AS h{i}{j}" for i in range(3) for j in range(i + 1)]
        sums += [f"sum(times * (s - label) * {x[i]}) AS g{i}" for i in range(3)]
        ctes.append(
            f"a{step} AS MATERIALIZED (SELECT replicate, {', '.join(sums)} FROM (SELECT *, "
            f"1 / (1 + exp(-(x0 * t0 + x1 * t1 + t2))) AS s FROM drawn JOIN b{step} USING (replicate) "
            f"WHERE times > 0) GROUP BY replicate)"
        )
        steps = ", ".join(f"t{i} - {moved[i]} AS t{i}" for i in range(3))
        ctes.append(
            f"b{step + 1} AS MATERIALIZED (SELECT replicate, {steps} FROM b{step} JOIN a{step} USING (replicate))"
        )
    return ", ".join(ctes)


@query(
    "bootstrap_draws",
    f"""WITH {DRAW_SQL}
        SELECT replicate, CAST(times AS INTEGER) AS times, count(*) AS "rows" FROM drawn GROUP BY ALL""",
)
def bootstrap_draws(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows each replicate drew how often."""
    draws = poisson_draws(KEYS, REPLICATES, "md5")
    each = lines(spark, folder).select(F.posexplode(draws).alias("replicate", "times"))
    return each.groupBy("replicate", "times").agg(F.count("*").alias("rows"))


def replicates_of(spark: SparkSession, folder: str, out_of_bag: bool = True) -> BaggedModel:
    return bagged_logistic_fit(
        spread(lines(spark, folder)), KEYS, replicates=REPLICATES, max_iter=NEWTON_STEPS, tol=0.0, hash_fn="md5",
        out_of_bag=out_of_bag,
    )


@query(
    "bootstrap_logistic_fit",
    f"""WITH {DRAW_SQL}, {replicate_newton(NEWTON_STEPS)}
        SELECT replicate, {sql_rounded('t0', 8)} AS theta0, {sql_rounded('t1', 8)} AS theta1,
               {sql_rounded('t2', 8)} AS intercept FROM b{NEWTON_STEPS}""",
)
def bootstrap_logistic_fit(spark: SparkSession, folder: str) -> DataFrame:
    """The coefficients of every replicate, all fitted in the same passes."""
    found = replicates_of(spark, folder, out_of_bag=False)
    rows = [(r, *map(float, t), float(b)) for r, (t, b) in enumerate(zip(found.theta, found.intercepts))]
    out = spark.createDataFrame(rows, schema="replicate int, theta0 double, theta1 double, intercept double")
    return out.select("replicate", *(rounded(c, 8).alias(c) for c in ("theta0", "theta1", "intercept")))


@query(
    "bootstrap_out_of_bag",
    f"""WITH {DRAW_SQL}, {replicate_newton(NEWTON_STEPS)},
        keyed AS (SELECT {KEY_LIST}, label, x0, x1, row_number() OVER () AS id FROM lines),
        free AS MATERIALIZED (
          SELECT id, replicate, label, x0, x1 FROM keyed, replicates
          WHERE CAST(('0x' || substr(md5(concat_ws('|', {KEY_LIST}, replicate)), 1, 8)) AS BIGINT) < {POISSON[0]}),
        scored AS (
          SELECT label, avg(1 / (1 + exp(-(x0 * t0 + x1 * t1 + t2)))) AS p
          FROM free JOIN b{NEWTON_STEPS} USING (replicate) GROUP BY id, label)
        SELECT count(*) AS "rows", {sql_rounded('avg(CASE WHEN (p >= 0.5) = (label = 1) THEN 1.0 ELSE 0.0 END)', 9)} AS accuracy,
               {sql_rounded('avg(-ln(CASE WHEN label = 1 THEN p ELSE 1 - p END))', 9)} AS cross_entropy
        FROM scored""",
)
def bootstrap_out_of_bag(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of the averaged model on rows that replicates left out."""
    found = replicates_of(spark, folder)
    row = (found.rows, found.accuracy, found.cross_entropy)
    out = spark.createDataFrame([row], schema="rows long, accuracy double, cross_entropy double")
    return out.select("rows", rounded("accuracy", 9).alias("accuracy"), rounded("cross_entropy", 9).alias("cross_entropy"))


BATCHES, EPOCHS, BATCH_RATE, DECAY = 8, 3, 0.5, 0.1


def _batch_steps() -> str:
    """CTEs ``m0 ..``: plain steps along one batch after another."""
    zero = "CAST(0 AS DOUBLE)"
    ctes = [f"m0 AS MATERIALIZED (SELECT {zero} AS t0, {zero} AS t1, {zero} AS t2)"]
    order = [b for e in range(EPOCHS) for b in batch_order(e, BATCHES)]
    for step, b in enumerate(order):
        rate = f"{BATCH_RATE} / (1 + {DECAY} * {step})"
        ctes.append(
            f"m{step + 1} AS MATERIALIZED (SELECT t0 - {rate} * d0 AS t0, t1 - {rate} * d1 AS t1, t2 - {rate} * d2 AS t2 "
            f"FROM m{step}, (SELECT avg(r * x0) AS d0, avg(r * x1) AS d1, avg(r) AS d2 FROM (SELECT x0, x1, "
            f"1 / (1 + exp(-(x0 * t0 + x1 * t1 + t2))) - label AS r FROM lines, m{step} WHERE bucket % {BATCHES} = {b})))"
        )
    return ", ".join(ctes)


@query(
    "logistic_minibatch_steps",
    f"WITH {LINE_SQL}, {_batch_steps()} {named_rows(f'm{BATCHES * EPOCHS}', NEWTON_NAMES, 8)}",
)
def logistic_minibatch_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Three epochs of plain steps, each along an eighth of the rows."""
    model = minibatch_logistic_fit(
        spread(lines(spark, folder)), KEYS, BATCHES, epochs=EPOCHS, learning_rate=BATCH_RATE, decay=DECAY,
        corrected=False, standardize=False, hash_fn="md5",
    )
    values = [(f"theta{i}", v) for i, v in enumerate(model.theta)] + [("intercept", model.intercept)]
    return named(spark, values, 8)


@query(
    "logistic_minibatch_fit",
    f"WITH {LINE_SQL}, {newton_steps('lines', 7)} {named_rows('n7', NEWTON_NAMES, 4)}",
)
def logistic_minibatch_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Corrected steps reach the optimum of the full fit."""
    model = minibatch_logistic_fit(spread(lines(spark, folder)), KEYS, 4, epochs=60, tol=1e-6)
    values = [(f"theta{i}", v) for i, v in enumerate(model.theta)] + [("intercept", model.intercept)]
    return named(spark, values, 4)


SCORES = ("quantity", "x1", "price", "-quantity", "x0 + x1", "x0 * x1")


@query(
    "areas_under_roc",
    f"""WITH {LINE_SQL},
        scores AS (SELECT label, [{", ".join(SCORES)}] AS s FROM lines),
        each AS (SELECT label, unnest(range(1, {len(SCORES) + 1})) AS p, unnest(s) AS score FROM scores),
        groups AS (SELECT p, score, sum(label) AS pos, sum(1 - label) AS neg FROM each GROUP BY p, score),
        below AS (SELECT p, pos, neg,
                         sum(neg) OVER (PARTITION BY p ORDER BY score ROWS UNBOUNDED PRECEDING) - neg AS less
                  FROM groups)
        SELECT CAST(p - 1 AS INTEGER) AS fit, {sql_rounded('sum(pos * (less + neg / 2)) / (sum(pos) * sum(neg))', 9)} AS auc
        FROM below GROUP BY p""",
)
def areas_under_roc_query(spark: SparkSession, folder: str) -> DataFrame:
    """The areas of six scores, few and many ties, from one sort."""
    scores = F.array(*(F.expr(e) for e in SCORES)).alias("scores")
    found = areas_under_roc(lines(spark, folder).select("label", scores))
    out = spark.createDataFrame(list(enumerate(found)), schema="fit int, auc double")
    return out.withColumn("auc", rounded("auc", 9))


def _area_sql() -> str:
    z = " + ".join(f"f{i} * t{i}" for i in range(len(_terms_sql()))) + " + b"
    area = sql_rounded("sum(pos * (less + neg / 2)) / (sum(pos) * sum(neg))", 9)
    return f"""WITH {_search_sql()},
        groups AS (SELECT degree, l2, held, {z} AS z, sum(label) AS pos, sum(1 - label) AS neg
                   FROM basis JOIN s{ITERATIONS} ON held = fold GROUP BY degree, l2, held, z),
        below AS (SELECT *, sum(neg) OVER (PARTITION BY degree, l2, held ORDER BY z ROWS UNBOUNDED PRECEDING) - neg AS less
                  FROM groups)
        SELECT CAST(degree AS INTEGER) AS degree, l2 AS lambda, CAST(held AS INTEGER) AS fold, {area} AS score
        FROM below GROUP BY degree, l2, held"""


@query("cv_logistic_areas", _area_sql())
def cv_logistic_areas(spark: SparkSession, folder: str) -> DataFrame:
    """The search by ROC area: every grid point and fold ranked in one job."""
    found = search(spark, folder, "area").folds()
    return found.withColumn("score", rounded("score", 9))
