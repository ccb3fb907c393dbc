import pytest
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from linfit.functions import features as X


def one(df, c):
    return df.select(c.alias("c")).first().c


def test_safe_double(spark):
    df = spark.createDataFrame([("1.5",), ("NA",), (None,), ("",), ("-2e1",)], "t string")
    assert [r.c for r in df.select(X.safe_double("t").alias("c")).collect()] == [
        1.5, 0.0, 0.0, 0.0, -20.0,
    ]


def test_cast_label_truncates(spark):
    df = spark.createDataFrame([(1.9,), (-1.9,)], "l double")
    assert [r.c for r in df.select(X.cast_label("l").alias("c")).collect()] == [1, -1]


def test_tokenize_keeps_empty_fields(spark):
    df = spark.createDataFrame([("1,,3",), ("1,,3E2,",)], "value string")
    got = [r.c for r in df.select(X.tokenize("value").alias("c")).collect()]
    assert got == [["1", "", "3"], ["1", "", "3E2", ""]]
    assert one(df, X.array_to_features(X.tokenize("value"))) == [1.0, None, 3.0]
    assert one(df, X.array_to_features(X.tokenize("value"), X.safe_double)) == [1.0, 0.0, 3.0]
    with pytest.raises(Exception, match="expected 3 fields, got 4"):
        df.select(X.tokenize("value", arity=3)).collect()


def test_tokenize_delimiter_is_literal(spark):
    df = spark.createDataFrame([("a.b|c",)], "value string")
    assert one(df, X.tokenize("value", ".")) == ["a", "b|c"]
    assert one(df, X.tokenize("value", "|")) == ["a.b", "c"]


def test_slice_and_element(spark):
    df = spark.createDataFrame([([0.0, 1.0, 2.0, 3.0, 4.0],)], "f array<double>")
    assert one(df, X.slice_features("f", range(1, 4))) == [1.0, 2.0, 3.0]
    assert one(df, X.slice_features("f", [4, 0])) == [4.0, 0.0]
    assert one(df, X.feature_element("f", 2)) == 2.0
    assert one(df, X.feature_element("f", 9)) is None


def test_assemble_odd_names_and_arrays(spark):
    df = spark.createDataFrame([(1, 2.5, [3.0, 4.0])], "`a+` int, `b.c` double, v array<double>")
    assert one(df, X.assemble("a+", "b.c", arrays=["v"])) == [1.0, 2.5, 3.0, 4.0]
    assert one(df, X.with_bias("v")) == [3.0, 4.0, 1.0]


def test_fill_numeric_leaves_strings(spark):
    df = spark.createDataFrame([(None, None)], "a double, b string")
    assert tuple(X.fill_numeric(df).first()) == (0.0, None)


@pytest.mark.parametrize("width, degree, terms", [(3, 2, 9), (7, 2, 35), (7, 3, 119), (2, 4, 14)])
def test_polynomial_matches_library(spark, width, degree, terms):
    values = [0.5 + i for i in range(width)]
    df = spark.createDataFrame([(values,)], "x array<double>")
    own = one(df, X.polynomial("x", width, degree))
    library = (
        PolynomialExpansion(degree=degree, inputCol="v", outputCol="o")
        .transform(df.select(array_to_vector("x").alias("v")))
        .select(vector_to_array("o").alias("o"))
        .first()
        .o
    )
    assert len(own) == terms
    assert own == pytest.approx(library, rel=1e-14)


def test_append_polynomials_skips_degree_one(spark):
    df = spark.createDataFrame([([2.0],)], "x array<double>")
    out = X.append_polynomials(df, "x", 1, [1, 2, 3], "p")
    assert out.columns == ["x", "p2", "p3"]
    assert tuple(out.first())[1:] == ([2.0, 4.0], [2.0, 4.0, 8.0])
    assert X.polynomial("x", 1, 1) is not None
    with pytest.raises(ValueError):
        X.monomials(2, 0)


def test_features_to_array(spark):
    df = spark.createDataFrame([([4.0, 9.0],)], "x array<double>")
    assert one(df, X.features_to_array("x")) == [4.0, 9.0]
    assert one(df, X.features_to_array("x", F.sqrt)) == [2.0, 3.0]
