"""The end-to-end jobs, on inputs derived from the given tables."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfit.catalog.base import clicks, embeddings, query, rounded, sql_rounded
from linfit.catalog.scans import collisions
from linfit.functions.features import feature_element
from linfit.operators.resample import holdout
from linfit.plans.jobs import click_job, collision_job, leaf_job, song_year_job
from linfit.sources.files import header_vocabulary, read_csv, read_lines
from linfit.sources.schemas import (
    LEAF_FEATURES,
    click_schema,
    collision_schema,
    leaf_schema,
)
from linfit.sources.scratch import scratch_path


@query("job_logistic_cv")
def job_logistic_cv(spark: SparkSession, folder: str) -> DataFrame:
    """Search on the 29-column collision file, then the winner's score on held-out rows."""
    path = scratch_path(spark, "collisions")
    collisions(spark, folder).write.csv(path, header=False)
    data = read_csv(spark, path, collision_schema())
    result = collision_job(data, max_iter=100, learning_rate=1.0 / data.count())
    degree, l2 = result.search.best
    return result.holdout_score.select(
        F.lit(degree).alias("degree"), F.lit(l2).alias("lambda"), "*"
    )


# Prices in whole cents and counts are exact in text, so both engines split the same lines.
SONG_LINE = "concat_ws(',', l_linenumber * 1000 + l_suppkey % 1000, l_orderkey % 97, l_partkey % 89)"
SONG_L2 = 0.1


@query(
    "job_ridge_year",
    f"""WITH text_lines AS (SELECT {SONG_LINE} AS value FROM lineitem),
        marked AS MATERIALIZED (
          SELECT CAST(split_part(value, ',', 1) AS DOUBLE) AS y,
                 CAST(split_part(value, ',', 2) AS DOUBLE) AS x0,
                 CAST(split_part(value, ',', 3) AS DOUBLE) AS x1,
                 CAST(('0x' || substr(md5(value), 1, 8)) AS BIGINT) < {int(0.3 * (1 << 32))} AS test
          FROM text_lines),
        st AS MATERIALIZED (SELECT avg(y) AS my, avg(x0) AS m0, avg(x1) AS m1
                            FROM marked WHERE NOT test),
        centred AS MATERIALIZED (SELECT y - my AS y, x0 - m0 AS x0, x1 - m1 AS x1, test
                                 FROM marked, st),
        terms AS (SELECT sum(x0 * x0) + {SONG_L2} AS a, sum(x0 * x1) AS b,
                         sum(x1 * x1) + {SONG_L2} AS c, sum(x0 * y) AS p, sum(x1 * y) AS q
                  FROM centred WHERE NOT test),
        theta AS MATERIALIZED (SELECT (c * p - b * q) / (a * c - b * b) AS t0,
                                      (a * q - b * p) / (a * c - b * b) AS t1 FROM terms)
        SELECT 'mean0' AS name, {sql_rounded('my', 6)} AS value FROM st
        UNION ALL SELECT 'mean1', {sql_rounded('m0', 6)} FROM st
        UNION ALL SELECT 'mean2', {sql_rounded('m1', 6)} FROM st
        UNION ALL SELECT 'theta0', {sql_rounded('t0', 6)} FROM theta
        UNION ALL SELECT 'theta1', {sql_rounded('t1', 6)} FROM theta
        UNION ALL SELECT 'own_rmse', {sql_rounded('sqrt(avg(pow(y - x0 * t0 - x1 * t1, 2)))', 5)}
        FROM centred, theta WHERE test""",
)
def job_ridge_year(spark: SparkSession, folder: str) -> DataFrame:
    """Ridge regression from text lines of three numbers."""
    path = scratch_path(spark, "songs")
    table = spark.read.parquet(f"{folder}/lineitem.parquet")
    table.select(F.expr(SONG_LINE).alias("value")).write.text(path)
    found = song_year_job(read_lines(spark, path), 0.3, SONG_L2, fields=3, hash_fn="md5")
    values = [(f"mean{i}", v) for i, v in enumerate(found.means)]
    values += [(f"theta{i}", v) for i, v in enumerate(found.own.theta)]
    known = spark.createDataFrame(values, schema="name string, value double").select(
        "name", rounded("value", 6).alias("value")
    )
    error = found.scores.select(
        F.lit("own_rmse").alias("name"), rounded("own_rmse", 5).alias("value")
    )
    return known.unionAll(error)


@query("job_click_prediction")
def job_click_prediction(spark: SparkSession, folder: str) -> DataFrame:
    """Fit on labelled clicks, then count the predictions written for unlabelled ones."""
    path, out = (scratch_path(spark, n) for n in ("clicks", "clicked"))
    clicks(spark, folder).write.csv(path, header=True)
    table = read_csv(spark, path, click_schema(), header=True)
    result = click_job(
        table,
        table.drop("clicked"),
        out,
        max_iter=100,
    )
    written = spark.read.schema("prediction double").csv(out, header=True)
    accuracy = result.accuracy.first()["accuracy"]
    return written.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("rows"), F.lit(accuracy).alias("validation_accuracy")
    )


def leaves(spark: SparkSession, folder: str) -> DataFrame:
    """The 194-column leaf layout: elements, their squares, and their products with the next."""
    table = embeddings(spark, folder)
    e = [feature_element("features", i) for i in range(64)]
    values = e + [x * x for x in e] + [e[i] * e[(i + 1) % 64] for i in range(64)]
    return table.select(
        F.col("vec_id").cast("int").alias("id"),
        F.concat(F.lit("species"), F.col("label")).alias("species"),
        *[v.alias(c) for v, c in zip(values, LEAF_FEATURES)],
    )


@query("job_multiclass_probabilities")
def job_multiclass_probabilities(spark: SparkSession, folder: str) -> DataFrame:
    """Probabilities per class for unlabelled leaves, in the order of a submission file."""
    labelled, unlabelled, order, out = (
        scratch_path(spark, n) for n in ("leaves", "new", "submission", "probabilities")
    )
    table = leaves(spark, folder)
    train, test = holdout(table, ["id"], 0.3)
    train.write.csv(labelled, header=True)
    test.drop("species").write.csv(unlabelled, header=True)
    names = [r.species for r in table.select("species").distinct().orderBy("species").collect()]
    table.select(
        "id", *[(F.col("species") == n).cast("double").alias(n) for n in names]
    ).write.csv(order, header=True)
    leaf_job(
        spark,
        read_csv(spark, labelled, leaf_schema(), header=True),
        read_csv(spark, unlabelled, leaf_schema(labelled=False), header=True),
        header_vocabulary(spark, order),
        out,
    )
    return spark.read.schema("id int, probability array<double>").json(out)


