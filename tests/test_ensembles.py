"""Bootstrap replicates, mini-batches and many ROC areas against plain numpy and single runs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from linfit.operators import minibatch
from linfit.operators.bagging import (
    POISSON,
    bagged_logistic_fit,
    bagged_predict,
    poisson_draws,
)
from linfit.operators.instances import pack_blocks
from linfit.operators.logistic import Fit, area_many, fit_many, graded_terms, logistic_fit
from linfit.operators.metrics import area_under_roc, areas_under_roc
from linfit.operators.minibatch import batch_order, minibatch_logistic_fit
from linfit.operators.resample import with_fold
from linfit.plans.tuning import cross_validate_logistic, param_grid


def newton(x, y, w, steps=25):
    x = np.column_stack([x, np.ones(len(x))])
    t = np.zeros(x.shape[1])
    for _ in range(steps):
        s = 1 / (1 + np.exp(-x @ t))
        t -= np.linalg.solve((x * (w * s * (1 - s))[:, None]).T @ x, x.T @ (w * (s - y)))
    return t


def test_draws_are_poisson_and_follow_the_key(spark, binary):
    draws = binary.select("id", poisson_draws(["id"], 20).alias("n"))
    first = {r.id: r.n for r in draws.collect()}
    again = {r.id: r.n for r in draws.repartition(3).collect()}
    assert first == again
    counts = np.array(list(first.values()))
    assert abs(counts.mean() - 1) < 0.02 and abs(counts.var() - 1) < 0.04
    assert abs(np.corrcoef(counts[:, 0], counts[:, 1])[0, 1]) < 0.08
    assert list(POISSON) == sorted(set(POISSON)) and POISSON[-1] < 1 << 32
    with pytest.raises(ValueError):
        poisson_draws([], 3)
    with pytest.raises(ValueError):
        poisson_draws(["id"], 3, "crc")


def test_replicates_are_weighted_fits(binary):
    rows = binary.select("*", poisson_draws(["id"], 6).alias("n")).collect()
    x, y = np.array([r.features for r in rows]), np.array([r.label for r in rows])
    n = np.array([r.n for r in rows])
    found = bagged_logistic_fit(binary, ["id"], replicates=6)
    p = np.zeros((6, len(y)))
    for r in range(6):
        t = newton(x, y, n[:, r])
        assert np.allclose([*found.theta[r], found.intercepts[r]], t, atol=1e-8)
        p[r] = 1 / (1 + np.exp(-(x @ t[:-1] + t[-1])))
    free = n == 0
    seen = free.any(axis=1)
    mean = np.array([p[free[i], i].mean() for i in np.flatnonzero(seen)])
    truth = y[seen] == 1
    assert found.rows == seen.sum()
    assert np.isclose(found.accuracy, ((mean >= 0.5) == truth).mean())
    assert np.isclose(found.cross_entropy, -np.log(np.where(truth, mean, 1 - mean)).mean(), atol=1e-9)
    scored = {r.id: r.prediction_prob for r in bagged_predict(binary, found, keys=["id"]).collect()}
    assert np.allclose([scored[r.id] for r in rows], p.mean(axis=0), atol=1e-8)
    with pytest.raises(Exception, match="vectors of 3"):
        bagged_predict(binary.select(F.array("label").alias("features")), found).collect()


def test_intervals_cover_the_known_truth(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 2))
    y = rng.random(4000) < 1 / (1 + np.exp(-(x @ [1.0, -0.5] + 0.3)))
    rows = [(i, float(b), [float(v) for v in a]) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, label double, features array<double>")
    low, high = bagged_logistic_fit(df, ["id"], replicates=60).interval(0.99)
    assert np.all(low < [1.0, -0.5, 0.3]) and np.all(high > [1.0, -0.5, 0.3])
    # About 2 x 2.58 deviations of sqrt(1 / (n x 0.2)).
    assert np.all(high - low < 0.35) and np.all(high - low > 0.08)


def test_tiny_and_broken_tables(spark, binary):
    with pytest.raises(ValueError, match="no instances"):
        bagged_logistic_fit(binary.where("id < 0"), ["id"], replicates=2)
    bad = binary.withColumn("label", F.when(F.col("id") == 5, None).otherwise(F.col("label")))
    with pytest.raises(ValueError, match="null"):
        bagged_logistic_fit(bad, ["id"], replicates=2)
    with pytest.raises(ValueError, match="no instances"):
        minibatch_logistic_fit(binary.where("id < 0"), ["id"])
    with pytest.raises(ValueError, match="at least 1"):
        minibatch_logistic_fit(binary, ["id"], batches=0)


def test_corrected_batches_reach_the_full_optimum(binary, l2=20.0):
    scaled = binary.withColumn("features", F.transform("features", lambda v, i: v * (1 + 9 * i) + 50 * i))
    full = logistic_fit(scaled, method="newton", l2=l2, tol=0.0, max_iter=20)
    found = minibatch_logistic_fit(scaled, ["id"], 3, l2=l2, epochs=60, tol=1e-6)
    assert np.allclose(found.theta, full.theta, atol=1e-4)
    assert np.isclose(found.intercept, full.intercept, atol=1e-3)
    assert found.losses[-1] <= found.losses[0]
    assert len(found.losses) < 60


def test_wide_tables_are_scaled_by_deviations(binary, monkeypatch):
    monkeypatch.setattr(minibatch, "MEMORY", 12)
    full = logistic_fit(binary, method="newton", tol=0.0, max_iter=20)
    found = minibatch_logistic_fit(binary, ["id"], 2, epochs=20, tol=1e-6)
    assert found.losses[0] > found.losses[-1] < full.losses[-1] + 0.02
    copied = binary.withColumn("features", F.concat("features", "features"))
    monkeypatch.undo()
    twice = minibatch_logistic_fit(copied, ["id"], 2, epochs=40, tol=1e-5)
    assert np.allclose(np.add(twice.theta[:3], twice.theta[3:]), full.theta, atol=1e-3)


def test_batches_do_not_depend_on_partitions(binary):
    one = minibatch_logistic_fit(binary, ["id"], 5, epochs=3)
    other = minibatch_logistic_fit(binary.orderBy(F.desc("id")).repartition(3), ["id"], 5, epochs=3)
    assert np.allclose(one.theta, other.theta, atol=1e-10)
    assert np.allclose(one.losses, other.losses, atol=1e-10)
    assert sorted(batch_order(2, 7)) == list(range(7)) and batch_order(2, 7) == batch_order(2, 7)


def test_a_step_reads_one_batch_and_empty_batches_are_passed_over(binary):
    few = binary.where("id < 5")
    assert minibatch_logistic_fit(few, ["id"], 40, epochs=2, l2=1.0).losses
    marked = binary.withColumn("fold", (F.col("id") % 4).cast("int"))
    with pack_blocks(marked, fold="fold", apart=True) as blocks:
        for part in range(4):
            rows = blocks.df.where(F.col("part") == part).collect()
            folds = np.concatenate([np.frombuffer(r.fold, np.int32) for r in rows])
            assert set(folds) == {part} and len(folds) == 500
            assert blocks.read(part).count() == len(rows)


def test_areas_equal_single_areas(spark, binary):
    scores = F.array(
        F.col("features")[0], F.round(F.col("features")[1], 1), F.lit(1.0), -F.col("features")[0],
        *[F.col("features")[2] * k for k in range(14)],
    )
    table = binary.select("label", scores.alias("scores"))
    found = areas_under_roc(table)
    single = [
        area_under_roc(table.select("label", F.col("scores")[i].alias("score"))) for i in range(18)
    ]
    assert len(found) == 18 and np.allclose(found, single, atol=1e-12)
    assert found[2] == 0.5 and np.isclose(found[0] + found[3], 1.0)
    with pytest.raises(ValueError, match="both classes"):
        areas_under_roc(table.where("label = 1"))
    with pytest.raises(ValueError, match="both classes"):
        areas_under_roc(table.where("label = 2"))
    uneven = table.withColumn("scores", F.when(F.rand(1) < 0.5, F.slice("scores", 1, 3)).otherwise(F.col("scores")))
    with pytest.raises(ValueError, match="length"):
        areas_under_roc(uneven)
    for broken in (F.lit(None).cast("array<double>"), F.array(F.lit(float("nan")))):
        with pytest.raises(Exception, match="null|not a number"):
            areas_under_roc(table.withColumn("scores", broken))


def test_held_out_areas_and_search(binary):
    table = with_fold(binary, ["id"], 3).cache()
    with pack_blocks(table, fold="fold") as blocks:
        fits = [Fit(graded_terms(3, 1), 0.0, f) for f in range(3)]
        fit_many(blocks, fits, "newton", 10)
        found = area_many(blocks, fits)
    for f, fit in enumerate(fits):
        z = sum(F.col("features")[i] * float(w) for i, w in enumerate(fit.theta))
        assert np.isclose(found[f], area_under_roc(table.where(F.col("fold") == f).select("label", z.alias("score"))))
    result = cross_validate_logistic(
        table, k=3, grid=param_grid((1, 2), (0.0, 1.0)), method="newton", max_iter=6, score_type="area"
    )
    assert len(result.fold_scores) == 12 and result.best[0] == 2
    assert np.allclose([s for d, v, f, s in result.fold_scores if (d, v) == (1, 0.0)], found, atol=1e-4)
