import pytest
from pyspark.sql import functions as F

from linfit.functions import vectors as V
from linfit.functions.scalar import clip_probability, log1p_exp, sigmoid

V1, V2, V3 = [1.0, 2.0, 3.0], [2.0, 3.0, 4.0], [2.0, 3.0, -4.0]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(
        [(V1, V2, V3)], "v1 array<double>, v2 array<double>, v3 array<double>"
    )


def one(df, c):
    return df.select(c.alias("c")).first().c



@pytest.mark.parametrize(
    "make, expected",
    [
        (lambda: V.dot(F.col("v1"), F.col("v2")), 20.0),
        (lambda: V.outer(F.col("v1"), F.col("v2")), [2, 4, 6, 3, 6, 9, 4, 8, 12]),
        (lambda: V.negate(F.col("v1")), [-1, -2, -3]),
        (lambda: V.add(F.col("v1"), F.col("v2")), [3, 5, 7]),
        (lambda: V.scale(F.col("v1"), 4), [4, 8, 12]),
        (lambda: V.outer_packed(F.col("v1")), [1, 2, 4, 3, 6, 9]),
        (
            lambda: V.linear_projection(F.col("v1"), [[1, 4, 7], [2, 5, 8], [3, 6, 9]]),
            [30, 36, 42],
        ),
        (lambda: V.norm_power(F.col("v1"), 2), 14.0),
        (lambda: V.norm_power(F.col("v2"), 1), 9.0),
        (lambda: V.norm_power(F.col("v3"), 1), 9.0),
    ],
)
def test_literals(vectors, make, expected):
    assert one(vectors, make()) == expected


def test_unequal_lengths_raise(spark):
    df = spark.createDataFrame([([1.0], [1.0, 2.0])], "a array<double>, b array<double>")
    for make in (V.dot, V.add):
        with pytest.raises(Exception, match="differ in length"):
            df.select(make(F.col("a"), F.col("b"))).collect()
    with pytest.raises(Exception, match="expected a vector of 2"):
        df.select(V.dot_constant(F.col("a"), [1.0, 2.0])).collect()


@pytest.mark.parametrize("width", [3, V.MAX_GENERATED_TERMS, V.MAX_GENERATED_TERMS + 1])
def test_dot_constant_narrow_and_wide(spark, width):
    values = [float(i) for i in range(width)]
    df = spark.createDataFrame([(values,)], "x array<double>")
    weights = [1.0 / (i + 1) for i in range(width)]
    expected = sum(a * b for a, b in zip(values, weights))
    assert one(df, V.dot_constant(F.col("x"), weights)) == pytest.approx(expected, rel=1e-14)


def test_stable_scalars(spark):
    df = spark.createDataFrame([(1000.0,), (-1000.0,), (0.0,), (0.5,)], "z double")
    rows = {
        r.z: r
        for r in df.select(
            "z", sigmoid(F.col("z")).alias("s"), log1p_exp(F.col("z")).alias("l")
        ).collect()
    }
    assert (rows[1000.0].s, rows[-1000.0].s, rows[0.0].s) == (1.0, 0.0, 0.5)
    assert (rows[1000.0].l, rows[-1000.0].l) == (1000.0, 0.0)
    assert rows[0.5].l == pytest.approx(0.9740769841801067, rel=1e-15)


def test_clip(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (0.25,)], "p double")
    got = [r.c for r in df.select(clip_probability(F.col("p")).alias("c")).collect()]
    assert got == [1e-15, 1 - 1e-15, 0.25]
