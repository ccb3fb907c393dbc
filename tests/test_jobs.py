import json
from pathlib import Path

import numpy as np
import pytest

from linfit.catalog import jobs as catalog
from linfit.catalog.jobs import leaves
from linfit.catalog.base import clicks
from linfit.catalog.scans import collisions
from linfit.plans import jobs as J
from linfit.sources.schemas import SONG_FIELDS


def test_collision_job(spark, small):
    data = collisions(spark, small)
    out = J.collision_job(
        data, degrees=(1, 2), lambdas=(0.01, 0.5), max_iter=2, learning_rate=1e-3
    )
    assert out.search.width == 7 and len(out.search.fold_scores) == 12
    row = out.holdout_score.first()
    held = row.true_positive + row.true_negative + row.false_positive + row.false_negative
    assert 90 < held < 210 and 0.0 <= row.accuracy <= 1.0


def test_song_year_job(spark):
    """91 fields per line; own and library fits agree closely at a small penalty."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(600, SONG_FIELDS - 1))
    y = 1990 + x[:, 0] * 3 - x[:, 50] + rng.normal(size=600) * 0.1
    lines = [(",".join(repr(float(v)) for v in [t, *r]),) for t, r in zip(y, x)]
    table = spark.createDataFrame(lines, "value string")
    out = J.song_year_job(table, l2=1e-6)
    assert len(out.means) == 91 and out.means[0] == pytest.approx(1990, abs=1)
    assert out.own.theta[0] == pytest.approx(3, abs=0.1)
    row = out.scores.first()
    assert row.own_rmse < 0.2 and row.native_rmse < 0.3 and row.native_train_rmse < 0.3
    instances = J.song_features(J.song_instances(table))
    first = instances.first()
    assert len(first.timbre_avg) == 12 and len(first.timbre_cov) == 78
    assert first.timbre_avg + first.timbre_cov == first.features
    bad = table.unionAll(spark.createDataFrame([("1,2",)], "value string"))
    with pytest.raises(Exception, match="expected 91 fields"):
        J.song_instances(bad).collect()


def test_click_job(spark, small, tmp_path):
    table = clicks(spark, small)
    out = J.click_job(
        table, table.drop("clicked"), str(tmp_path / "clicked"), max_iter=2,
    )
    assert 0.3 < out.accuracy.first().accuracy <= 1.0
    written = spark.read.csv(str(tmp_path / "clicked"), header=True)
    assert written.columns == ["prediction"] and written.count() == table.count()


@pytest.mark.parametrize("solver", ["own", "library"])
def test_leaf_job(spark, small, tmp_path, solver):
    table = leaves(spark, small)
    names = sorted({r.species for r in table.select("species").distinct().collect()})[::-1]
    out = J.leaf_job(
        spark, table, table.drop("species"), names, str(tmp_path / "out"),
        columns=[f"margin{i}" for i in range(1, 17)], k=2, reg_params=(0.3,), max_iter=2, solver=solver,
    )
    assert out.label_difference.count() == 0
    assert [r.value for r in out.fitted_labels.orderBy("idx").collect()] == names
    rows = [
        json.loads(line)
        for p in Path(tmp_path / "out").glob("part*")
        for line in p.read_text().splitlines()
    ]
    assert len(rows) == table.count()
    assert all(len(r["probability"]) == len(names) for r in rows)
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 for r in rows)


def test_own_and_library_searches_agree(spark, small, tmp_path):
    table = leaves(spark, small).limit(200)
    names = sorted({r.species for r in table.select("species").distinct().collect()})
    own, library = (
        J.leaf_job(
            spark, table, table.drop("species"), names, str(tmp_path / solver),
            columns=[f"margin{i}" for i in range(1, 9)], k=3, reg_params=(0.3, 0.03), max_iter=200, tol=1e-9,
            solver=solver,
        )
        for solver in ("own", "library")
    )
    assert list(own.search.means.values()) == pytest.approx(library.search.avgMetrics, abs=1e-4)
    mine = {r.id: r.probability for r in own.probabilities.collect()}
    for r in library.probabilities.collect():
        assert np.allclose(mine[r.id], r.probability.toArray(), atol=1e-3)


def test_song_year_job_keeps_no_rows(spark, monkeypatch):
    """Means, own fit and errors follow from one pass of sums, against numpy on the rows themselves."""
    rng = np.random.default_rng(3)
    table = np.round(rng.normal(size=(400, 3)) * [20, 1, 5] + [1990, 7, -3], 6)
    lines = spark.createDataFrame([(",".join(map(repr, map(float, r))),) for r in table], "value string")

    def persist(*_):
        raise AssertionError("rows were kept")

    monkeypatch.setattr(type(lines), "persist", persist)
    out = J.song_year_job(lines, l2=0.5, fields=3)
    train, test = (
        np.array([[float(v) for v in r.value.split(",")] for r in part.collect()])
        for part in J.holdout(lines, ["value"], 0.3)
    )
    mean = train.mean(axis=0)
    x, y = (train - mean)[:, 1:], (train - mean)[:, 0]
    theta = np.linalg.solve(x.T @ x + 0.5 * np.eye(2), x.T @ y)
    assert np.allclose(out.means, mean) and np.allclose(out.own.theta, theta)
    held, row = test - mean, out.scores.first()
    assert row.own_rmse == pytest.approx(np.sqrt(np.mean((held[:, 0] - held[:, 1:] @ theta) ** 2)))
    native = np.array(out.native.theta)
    assert row.native_rmse == pytest.approx(np.sqrt(np.mean((held[:, 0] - held[:, 1:] @ native) ** 2)))
    assert row.native_train_rmse == pytest.approx(np.sqrt(np.mean((y - x @ native) ** 2)))
    for bad in ("1,,3", "1,2"):
        with pytest.raises(Exception, match="null feature|expected 3 fields"):
            J.song_year_job(lines.unionAll(spark.createDataFrame([(bad,)] * 5, "value string")), fields=3)


def test_the_click_table_is_written_once(spark, small, tmp_path, monkeypatch):
    written = []

    def path(_, name):
        written.append(name)
        return str(tmp_path / name)

    monkeypatch.setattr(catalog, "scratch_path", path)
    rows = catalog.job_click_prediction(spark, small).collect()
    assert written == ["clicks", "clicked"]
    assert sum(r["rows"] for r in rows) == clicks(spark, small).count()
