import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("linfit-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def binary(spark):
    """2,000 labelled rows with a real signal in three features, and a key."""
    import numpy as np

    rng = np.random.default_rng(7)
    x = rng.normal(size=(2000, 3))
    p = 1 / (1 + np.exp(-(x @ [1.2, -0.7, 0.0] + 0.4 + 0.5 * x[:, 0] * x[:, 1])))
    y = (rng.random(2000) < p).astype(float)
    rows = [(i, float(y[i]), [float(v) for v in x[i]]) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, label double, features array<double>")
    return df.repartition(4).cache()
