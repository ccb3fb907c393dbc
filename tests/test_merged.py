"""Blocks in which equal rows are one row with a count."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from linfit.catalog import tuning as catalog
from linfit.operators import kernels
from linfit.operators.bagging import POISSON, bagged_logistic_fit, poisson_draws, replicate_bucket
from linfit.operators.instances import pack_blocks
from linfit.operators.logistic import Fit, area_many, confusion_many, fit_many, graded_terms
from linfit.operators.metrics import AreaUnderRoc
from linfit.plans import tuning


def stored(blocks) -> int:
    return blocks.df.agg(F.sum(F.octet_length("y") / 8)).first()[0]


@pytest.fixture(scope="module")
def few(spark):
    """6,000 rows of 24 different ones over two folds."""
    at = F.col("id")
    table = spark.range(0, 6000, 1, 3).select(
        (at % 2).cast("double").alias("label"),
        (F.floor(at / 2) % 2).cast("int").alias("fold"),
        F.array((at % 3 - 1).cast("double"), (F.floor(at / 12) % 2 + at % 2 * 0.5)).alias("features"),
    )
    return table.cache()


def test_passes_agree_with_unmerged_rows(few):
    found = []
    for merge in (False, True):
        with pack_blocks(few, fold="fold", merge=merge) as blocks:
            assert blocks.rows == 6000
            assert stored(blocks) == (3 * 24 if merge else 6000)
            fits = [Fit(graded_terms(2, d), 0.1, f) for d in (1, 2) for f in (-2, 0, 1)]
            fit_many(blocks, fits[:3], "newton", 4)
            fit_many(blocks, fits[3:], "gradient", 5, 1e-4)
            found.append((fits, confusion_many(blocks, fits), area_many(blocks, fits)))
    (a, counts, areas), (b, merged_counts, merged_areas) = found
    for x, y in zip(a, b, strict=True):
        assert np.allclose(x.theta, y.theta, rtol=1e-9) and x.losses == pytest.approx(y.losses)
    assert (counts == merged_counts).all() and counts.sum(axis=1).tolist() == [0, 3000, 3000] * 2
    assert areas == pytest.approx(merged_areas) and areas[0] is None


def test_a_search_holds_each_row_once(few, monkeypatch):
    held = []

    def packed(*args, **kwargs):
        held.append(pack_blocks(*args, **kwargs))
        assert stored(held[-1]) <= 3 * 24
        return held[-1]

    monkeypatch.setattr(tuning, "pack_blocks", packed)
    result = tuning.cross_validate_logistic(few, k=2, max_iter=2, learning_rate=1e-4)
    assert len(held) == 1 and result.width == 2


def test_different_rows_pass_through(spark, monkeypatch):
    table = spark.range(0, 3000, 1, 2).select(
        (F.col("id") % 2).cast("double").alias("label"), F.array(F.col("id").cast("double")).alias("features")
    )
    monkeypatch.setattr(kernels, "MERGE_ROWS", 64)
    monkeypatch.setattr(kernels, "MERGE_TRIAL", 128)
    with pack_blocks(table, merge=True) as blocks:
        assert blocks.rows == stored(blocks) == 3000


def test_what_cannot_be_merged_still_raises(spark):
    rows = [(0.0, [1.0, 2.0]), (1.0, [1.0]), (None, [1.0, 2.0]), (1.0, [None, 1.0]), (1.0, None), (2.0, [1.0, 2.0])]
    for bad in rows[1:]:
        table = spark.createDataFrame([rows[0], bad], "label double, features array<double>").coalesce(1)
        with pytest.raises(ValueError, match="null, or labels|differ in length"):
            pack_blocks(table, merge=True)
    with pytest.raises(ValueError, match="not merged"):
        pack_blocks(table, merge=True, apart=True)


@pytest.mark.parametrize("hash_fn", ["md5", "xxhash64"])
def test_replicates_of_merged_rows(few, hash_fn):
    keyed = few.withColumn("id", F.monotonically_increasing_id())
    draws = poisson_draws(["id"], 3, hash_fn)
    many = F.slice(poisson_draws(["id"], 40, hash_fn), 1, 3)
    buckets = [replicate_bucket(["id"], F.lit(r), hash_fn) for r in range(3)]
    counted = F.array(*(sum(((u >= t).cast("int") for t in POISSON), F.lit(0)) for u in buckets))
    assert keyed.where((draws != counted) | (many != counted)).count() == 0
    with pack_blocks(keyed, draws=draws, merge=True) as blocks:
        assert stored(blocks) < 100
    own, merged = (
        bagged_logistic_fit(keyed, ["id"], replicates=3, max_iter=4, l2=0.1, hash_fn=hash_fn, out_of_bag=scored)
        for scored in (True, False)
    )
    assert np.allclose(own.theta, merged.theta, rtol=1e-9) and np.allclose(own.intercepts, merged.intercepts)
    assert own.rows > 0 and merged.rows == 0 and merged.accuracy is None


def test_library_fits_of_counted_rows(few):
    rows = few.select("label", array_to_vector("features").alias("features"))
    counted = few.groupBy("label", "features").agg(F.count("*").cast("double").alias("rows"))
    counted = counted.select("label", "rows", array_to_vector("features").alias("features")).coalesce(2)
    plain = LogisticRegression(regParam=0.1, tol=1e-12).fit(rows)
    scale = tuning.CountedScaler("features", "scaled", "rows")
    fit = LogisticRegression(featuresCol="scaled", weightCol="rows", standardization=False, regParam=0.1, tol=1e-12)
    model = Pipeline(stages=[scale, fit]).fit(counted)
    factor = model.stages[0].getScalingVec().toArray()
    assert np.allclose(model.stages[1].coefficients.toArray() * factor, plain.coefficients.toArray(), atol=1e-8)
    area = AreaUnderRoc().evaluate(plain.transform(rows))
    assert AreaUnderRoc(rows="rows").evaluate(model.transform(counted)) == pytest.approx(area, abs=1e-12)
    constant = counted.withColumn("features", array_to_vector(F.array(F.lit(2.0))))
    assert scale.fit(constant).getScalingVec().toArray().tolist() == [0.0]


def test_the_native_search_reads_counted_rows(spark, small, monkeypatch):
    class Seen(Exception):
        pass

    def search(df, *_, **__):
        raise Seen(df.columns, df.count(), df.agg(F.sum("rows")).first()[0])

    monkeypatch.setattr(catalog, "cross_validate_native", search)
    with pytest.raises(Seen) as seen:
        catalog.cv_native_auc(spark, small)
    columns, different, rows = seen.value.args
    assert "rows" in columns and different < rows == spark.read.parquet(f"{small}/lineitem.parquet").count()
