import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from linfit.sources import files, schemas
from linfit.sources.scratch import scratch_path


def test_schemas():
    assert len(schemas.collision_schema()) == 29
    assert len(schemas.click_schema()) == 36 and len(schemas.click_schema(False)) == 35
    assert len(schemas.leaf_schema()) == 194 and len(schemas.leaf_schema(False)) == 193
    assert len(schemas.click_numeric_features()) == 30
    assert not schemas.leaf_schema()["id"].nullable


def test_feature_groups():
    assert len(schemas.feature_group("low")) == 21
    assert schemas.feature_group("high") == [f"feature{i}" for i in range(22, 29)]
    assert len(schemas.feature_group("all")) == 28 and "label" not in schemas.feature_group("all")
    with pytest.raises(ValueError):
        schemas.feature_group("middle")


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "a", 0.1), (0.0, None, 1e-17)], "p double, s string, k double")
    files.write_csv(df, str(tmp_path / "out"), ["p"], ["k"])
    part = next(Path(tmp_path / "out").glob("part*"))
    assert part.read_text().splitlines()[0] == "k,p"
    back = files.read_csv(spark, str(tmp_path / "out"), df.select("k", "p").schema, header=True)
    assert {tuple(r) for r in back.collect()} == {(0.1, 1.0), (1e-17, 0.0)}


def test_json_is_a_plain_array(spark, tmp_path):
    from pyspark.ml.functions import array_to_vector

    df = spark.createDataFrame([(1, [0.25, 0.75])], "id int, probability array<double>")
    for name, table in (
        ("array", df),
        ("vector", df.withColumn("probability", array_to_vector("probability"))),
    ):
        files.write_probabilities(table, str(tmp_path / name))
        lines = "".join(p.read_text() for p in Path(tmp_path / name).glob("part*"))
        assert json.loads(lines) == {"id": 1, "probability": [0.25, 0.75]}


def test_header_vocabulary(spark, tmp_path):
    path = tmp_path / "order.csv"
    path.write_text("id,z,a,m\n1,0,0,1\n")
    assert files.header_vocabulary(spark, str(path)) == ["z", "a", "m"]
    (tmp_path / "none.csv").write_text("")
    with pytest.raises(ValueError):
        files.header_vocabulary(spark, str(tmp_path / "none.csv"))


def test_preview_is_a_top_n(spark):
    df = spark.range(1000, numPartitions=7).withColumn("k", -F.col("id"))
    shown = files.preview(df, ["k"], 3)
    assert [r.id for r in shown.collect()] == [999, 998, 997]
    assert "TakeOrderedAndProject" in shown._jdf.queryExecution().executedPlan().toString()


class Session:
    """Just the two settings that decide where intermediate tables go."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_follows_the_session(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    shared = scratch_path(Session("yarn", "hdfs://shared/dir/"), "x")
    assert shared.startswith("hdfs://shared/dir/linfit-x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Session("yarn"), "x")
