"""File scans, sinks and instance extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfit.catalog.base import (
    ELEMENT_SQL,
    KEY_LIST,
    KEYS,
    LINE_SQL,
    click_sql,
    clicks,
    elements,
    embeddings,
    lines,
    query,
    sql_rounded,
)
from linfit.functions.features import feature_element, fill_numeric
from linfit.functions.vectors import scale, total
from linfit.operators.instances import feature_arity, instances
from linfit.sources.files import (
    header_vocabulary,
    preview,
    read_csv,
    read_lines,
    write_csv,
    write_probabilities,
)
from linfit.sources.schemas import COLLISION_FEATURES, click_schema, collision_schema
from linfit.sources.scratch import scratch_path


def collisions(spark: SparkSession, folder: str) -> DataFrame:
    """The 29-column collision layout, filled from the first 28 embedding elements."""
    return embeddings(spark, folder).select(
        (F.col("label") % 2).cast("double").alias("label"),
        *[feature_element("features", i).alias(c) for i, c in enumerate(COLLISION_FEATURES)],
    )


COLLISION_SQL = (
    "SELECT CAST(label % 2 AS DOUBLE) AS label, "
    + ", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS feature{i}" for i in range(1, 29))
    + " FROM embeddings"
)


@query("csv_scan_noheader", COLLISION_SQL)
def csv_scan_noheader(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "collisions")
    collisions(spark, folder).write.csv(path, header=False)
    return read_csv(spark, path, collision_schema())


@query("csv_scan_header", click_sql(filled=True))
def csv_scan_header(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "clicks")
    clicks(spark, folder).write.csv(path, header=True)
    return fill_numeric(read_csv(spark, path, click_schema(), header=True))


@query(
    "text_scan",
    f"SELECT concat_ws('|', {KEY_LIST}, l_returnflag, l_linestatus) AS value FROM lineitem",
)
def text_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    table = spark.read.parquet(f"{folder}/lineitem.parquet")
    line = F.concat_ws("|", *[F.col(c) for c in [*KEYS, "l_returnflag", "l_linestatus"]])
    table.select(line.alias("value")).write.text(path)
    return read_lines(spark, path)


@query(
    "header_vocabulary",
    """SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS idx,
              'class' || label AS value
       FROM (SELECT DISTINCT label FROM embeddings)""",
)
def header_vocabulary_query(spark: SparkSession, folder: str) -> DataFrame:
    """A submission-style table, one column per class, whose header names the classes."""
    path = scratch_path(spark, "submission")
    table = embeddings(spark, folder)
    classes = [r.label for r in table.select("label").distinct().orderBy("label").collect()]
    table.select(
        F.col("vec_id").alias("id"),
        *[(F.col("label") == c).cast("double").alias(f"class{c}") for c in classes],
    ).write.csv(path, header=True)
    found = header_vocabulary(spark, path)
    return spark.createDataFrame(list(enumerate(found)), schema="idx int, value string")


@query(
    "csv_sink",
    f"""WITH {LINE_SQL}
        SELECT {KEY_LIST}, CASE WHEN x0 - x1 >= 0 THEN CAST(1 AS DOUBLE)
                                ELSE CAST(0 AS DOUBLE) END AS prediction FROM lines""",
)
def csv_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "predictions")
    said = F.when(F.col("x0") - F.col("x1") >= 0, 1.0).otherwise(0.0)
    scored = lines(spark, folder).withColumn("prediction", said)
    write_csv(scored, path, ["prediction"], KEYS)
    written = scored.select(*KEYS, "prediction").schema
    return read_csv(spark, path, written, header=True)


@query(
    "json_sink",
    f"""WITH {ELEMENT_SQL}
        SELECT vec_id AS id, pos, {sql_rounded('abs(v) / sum(abs(v)) OVER (PARTITION BY vec_id)', 9)}
               AS probability FROM elements""",
)
def json_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "probabilities")
    size = F.transform("features", F.abs)
    table = embeddings(spark, folder).select(
        F.col("vec_id").alias("id"), scale(size, F.lit(1.0) / total(size)).alias("probability")
    )
    write_probabilities(table, path)
    back = spark.read.schema("id long, probability array<double>").json(path)
    flat = back.select("id", F.posexplode("probability").alias("pos", "p"))
    return flat.select("id", "pos", (F.round("p", 9) + 0.0).alias("probability"))


@query(
    "instances",
    f"WITH {ELEMENT_SQL} SELECT CAST(label AS DOUBLE) AS label, pos, v FROM elements",
)
def instances_query(spark: SparkSession, folder: str) -> DataFrame:
    return elements(instances(embeddings(spark, folder), "label", "features"), "features", "label")


@query(
    "instances_with_bias",
    f"WITH {LINE_SQL} SELECT label, x0 AS f0, x1 AS f1, CAST(1 AS DOUBLE) AS f2 FROM lines",
)
def instances_with_bias(spark: SparkSession, folder: str) -> DataFrame:
    table = instances(lines(spark, folder), "label", "features", bias=True)
    return table.select("label", *[F.get("features", F.lit(i)).alias(f"f{i}") for i in range(3)])


@query(
    "preview_limit",
    f"""WITH {LINE_SQL} SELECT {KEY_LIST}, label, x0, x1 FROM lines
        ORDER BY {KEY_LIST}, x0, x1, label LIMIT 20""",
)
def preview_limit(spark: SparkSession, folder: str) -> DataFrame:
    table = lines(spark, folder).select(*KEYS, "label", "x0", "x1")
    return preview(table, [*KEYS, "x0", "x1", "label"], 20)


@query(
    "feature_arity",
    """SELECT CASE WHEN min(len(embedding)) = max(len(embedding))
                   THEN CAST(min(len(embedding)) AS INTEGER) END AS arity,
              CAST(min(len(embedding)) AS INTEGER) AS min_arity,
              CAST(max(len(embedding)) AS INTEGER) AS max_arity
       FROM embeddings""",
)
def feature_arity_query(spark: SparkSession, folder: str) -> DataFrame:
    return feature_arity(embeddings(spark, folder))
