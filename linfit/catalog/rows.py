"""Row-wise feature preparation."""

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
    rounded,
    sql_rounded,
)
from linfit.catalog.scans import collisions
from linfit.functions.features import (
    append_polynomials,
    array_to_features,
    assemble,
    cast_label,
    feature_element,
    features_to_array,
    fill_numeric,
    safe_double,
    slice_features,
    tokenize,
)
from linfit.functions.scalar import log1p_exp, sigmoid
from linfit.sources.files import read_table
from linfit.sources.schemas import feature_group


@query("project_drop", f"SELECT {KEY_LIST}, l_returnflag, l_linestatus FROM lineitem")
def project_drop(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, folder, "lineitem")
    return table.drop("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")


@query(
    "cast_label",
    "SELECT o_orderkey, CAST(trunc(o_totalprice) AS INTEGER) AS label FROM orders",
)
def cast_label_query(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, folder, "orders")
    return table.select("o_orderkey", cast_label("o_totalprice").alias("label"))


@query("fill_numeric", click_sql(filled=True))
def fill_numeric_query(spark: SparkSession, folder: str) -> DataFrame:
    return fill_numeric(clicks(spark, folder))


_TEXTS = {
    "price": "CAST(o_totalprice AS VARCHAR)",
    "priority": "o_orderpriority",
    "level": "substr(o_orderpriority, 1, 1)",
    "missing": "CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE '-2.5E1' END",
}


@query(
    "safe_double",
    "SELECT o_orderkey, "
    + ", ".join(
        f"coalesce(TRY_CAST({e} AS DOUBLE), CAST(0 AS DOUBLE)) AS {n}" for n, e in _TEXTS.items()
    )
    + " FROM orders",
)
def safe_double_query(spark: SparkSession, folder: str) -> DataFrame:
    texts = {n: F.expr(e.replace("VARCHAR", "STRING")) for n, e in _TEXTS.items()}
    table = read_table(spark, folder, "orders")
    return table.select("o_orderkey", *[safe_double(e).alias(n) for n, e in texts.items()])


@query(
    "tokenize_line",
    """SELECT doc_id, CAST(p - 1 AS INTEGER) AS pos, t[p] AS token
       FROM (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS p
             FROM (SELECT doc_id, string_split(text, ',') AS t FROM documents))""",
)
def tokenize_line(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, folder, "documents")
    return table.select("doc_id", F.posexplode(tokenize("text", ",")).alias("pos", "token"))


@query(
    "array_to_features",
    f"""SELECT {KEY_LIST}, CAST(l_orderkey AS DOUBLE) AS f0, CAST(l_linenumber AS DOUBLE) AS f1,
               CAST(NULL AS DOUBLE) AS f2, l_quantity AS f3 FROM lineitem""",
)
def array_to_features_query(spark: SparkSession, folder: str) -> DataFrame:
    """Comma lines with an unreadable third field, parsed back into numbers."""
    table = read_table(spark, folder, "lineitem")
    line = F.concat_ws(",", "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    parsed = table.select(*KEYS, array_to_features(tokenize(line, ",", 4)).alias("x"))
    return parsed.select(*KEYS, *[feature_element("x", i).alias(f"f{i}") for i in range(4)])


@query(
    "features_to_array",
    f"WITH {ELEMENT_SQL} SELECT vec_id, pos, sqrt(abs(v)) AS v FROM elements",
)
def features_to_array_query(spark: SparkSession, folder: str) -> DataFrame:
    roots = features_to_array("features", lambda x: F.sqrt(F.abs(x)))
    return elements(embeddings(spark, folder).withColumn("features", roots), "features", "vec_id")


@query(
    "feature_element",
    "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS label, "
    "CAST(embedding[64] AS DOUBLE) AS final FROM embeddings",
)
def feature_element_query(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings(spark, folder).select(
        "vec_id",
        feature_element("features", 0).alias("label"),
        feature_element("features", 63).alias("final"),
    )


@query(
    "slice_features",
    f"""WITH {ELEMENT_SQL}
        SELECT vec_id, 'average' AS part, pos, v FROM elements WHERE pos < 12
        UNION ALL
        SELECT vec_id, 'covariance', CAST(pos - 12 AS INTEGER), v FROM elements WHERE pos >= 12
        UNION ALL
        SELECT vec_id, 'picked', CAST(CASE pos WHEN 40 THEN 0 WHEN 3 THEN 1 ELSE 2 END AS INTEGER), v
        FROM elements WHERE pos IN (40, 3, 17)""",
)
def slice_features_query(spark: SparkSession, folder: str) -> DataFrame:
    parts = {"average": range(0, 12), "covariance": range(12, 64), "picked": (40, 3, 17)}
    sliced = F.array(
        *[
            F.struct(F.lit(n).alias("part"), slice_features("features", at).alias("x"))
            for n, at in parts.items()
        ]
    )
    table = embeddings(spark, folder).select("vec_id", F.inline(sliced))
    return elements(table, "x", "vec_id", "part")


@query(
    "assemble_features",
    f"""WITH {ELEMENT_SQL}
        SELECT vec_id, CAST(0 AS INTEGER) AS pos, CAST(label AS DOUBLE) AS v FROM embeddings
        UNION ALL SELECT vec_id, 1, CAST(vec_id AS DOUBLE) FROM embeddings
        UNION ALL SELECT vec_id, CAST(pos + 2 AS INTEGER), v FROM elements""",
)
def assemble_features(spark: SparkSession, folder: str) -> DataFrame:
    both = assemble("label", "vec_id", arrays=["features"])
    return elements(embeddings(spark, folder).select("vec_id", both.alias("x")), "x", "vec_id")


def _group_sql(name: str) -> str:
    terms = " + ".join(f"{c} * {i}" for i, c in enumerate(feature_group(name), 1))
    return f"SELECT '{name}' AS grp, label, {sql_rounded(terms, 8)} AS checksum FROM collisions"


@query(
    "feature_group",
    "WITH collisions AS (SELECT CAST(label % 2 AS DOUBLE) AS label, "
    + ", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS feature{i}" for i in range(1, 29))
    + " FROM embeddings) "
    + " UNION ALL ".join(_group_sql(g) for g in ("low", "high", "all")),
)
def feature_group_query(spark: SparkSession, folder: str) -> DataFrame:
    """Each group assembled; a position-weighted sum stands for the vector."""
    groups = F.array(
        *[
            F.struct(F.lit(g).alias("grp"), assemble(feature_group(g)).alias("x"))
            for g in ("low", "high", "all")
        ]
    )
    table = collisions(spark, folder).select("label", F.inline(groups))
    weighted = F.aggregate(
        F.transform("x", lambda v, i: v * (i + 1)), F.lit(0.0), lambda acc, v: acc + v
    )
    return table.select("grp", "label", rounded(weighted, 8).alias("checksum"))


@query(
    "poly_expand_d2",
    f"""WITH {LINE_SQL}
        SELECT {KEY_LIST}, x0 AS t0, x0 * x0 AS t1, x1 AS t2, x0 * x1 AS t3, x1 * x1 AS t4,
               price AS t5, x0 * price AS t6, x1 * price AS t7, price * price AS t8
        FROM lines""",
)
def poly_expand_d2(spark: SparkSession, folder: str) -> DataFrame:
    table = lines(spark, folder).withColumn("x", F.array("x0", "x1", "price"))
    expanded = append_polynomials(table, "x", 3, [1, 2], "poly")
    return expanded.select(
        *KEYS, *[F.get("poly2", F.lit(i)).alias(f"t{i}") for i in range(9)]
    )


@query(
    "poly_expand_d3",
    f"""WITH {LINE_SQL}
        SELECT {KEY_LIST}, x0 AS t0, x0 * x0 AS t1, x0 * x0 * x0 AS t2, x1 AS t3, x0 * x1 AS t4,
               x0 * x0 * x1 AS t5, x1 * x1 AS t6, x0 * x1 * x1 AS t7, x1 * x1 * x1 AS t8
        FROM lines""",
)
def poly_expand_d3(spark: SparkSession, folder: str) -> DataFrame:
    expanded = append_polynomials(lines(spark, folder), "features", 2, [1, 3], "poly")
    return expanded.select(
        *KEYS, *[F.get("poly3", F.lit(i)).alias(f"t{i}") for i in range(9)]
    )


@query(
    "sigmoid",
    f"""WITH {LINE_SQL}
        SELECT {KEY_LIST}, {sql_rounded('''CASE WHEN x0 * 500 < 0
               THEN exp(x0 * 500) / (1 + exp(x0 * 500)) ELSE 1 / (1 + exp(-x0 * 500)) END''', 9)}
               AS p FROM lines""",
)
def sigmoid_query(spark: SparkSession, folder: str) -> DataFrame:
    """Margins of up to 850 either way, beyond where exp overflows."""
    p = sigmoid(F.col("x0") * 500)
    return lines(spark, folder).select(*KEYS, rounded(p, 9).alias("p"))


@query(
    "log1p_exp",
    f"""WITH {LINE_SQL}
        SELECT {KEY_LIST}, {sql_rounded('''CASE WHEN x0 * 500 > 0
               THEN x0 * 500 + ln(1 + exp(-x0 * 500)) ELSE ln(1 + exp(x0 * 500)) END''', 9)}
               AS loss FROM lines""",
)
def log1p_exp_query(spark: SparkSession, folder: str) -> DataFrame:
    loss = log1p_exp(F.col("x0") * 500)
    return lines(spark, folder).select(*KEYS, rounded(loss, 9).alias("loss"))
