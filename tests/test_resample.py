import pytest
from pyspark.sql import functions as F

from linfit.operators import resample as R


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.range(20000).withColumn("b", F.col("id") * 7)


@pytest.mark.parametrize("hash_fn", R.HASHES)
def test_folds_partition_the_rows(keyed, hash_fn):
    folds = R.with_fold(keyed, ["id", "b"], 5, hash_fn=hash_fn)
    sizes = {r.fold: r["count"] for r in folds.groupBy("fold").count().collect()}
    assert sorted(sizes) == [0, 1, 2, 3, 4] and sum(sizes.values()) == 20000
    assert all(abs(n - 4000) < 300 for n in sizes.values())
    for i, (train, test) in enumerate(R.fold_pairs(folds, 5)):
        assert test.count() == sizes[i] and train.count() == 20000 - sizes[i]
        assert train.select("id").intersect(test.select("id")).count() == 0


@pytest.mark.parametrize("hash_fn", R.HASHES)
def test_holdout_does_not_depend_on_layout(keyed, hash_fn):
    train, test = R.holdout(keyed, ["id"], 0.3, hash_fn)
    again = R.holdout(keyed.repartition(7).orderBy("b"), ["id"], 0.3, hash_fn)[1]
    assert train.count() + test.count() == 20000
    assert abs(test.count() - 6000) < 400
    assert test.exceptAll(again).count() == 0
    assert train.columns == ["id", "b"]


def test_bounds(keyed):
    for k in (1, 21):
        with pytest.raises(ValueError):
            R.with_fold(keyed, ["id"], k)
    with pytest.raises(ValueError):
        R.holdout(keyed, ["id"], 1.0)
    with pytest.raises(ValueError):
        R.key_bucket(["id"], "crc")
    with pytest.raises(ValueError):
        R.union_all([])


def test_union_keeps_duplicates(spark):
    a = spark.createDataFrame([(1,), (1,)], "x int")
    assert R.union_all([a, a, a]).count() == 6


def test_random_split_and_sample(keyed):
    parts = R.random_split(keyed)
    assert sum(p.count() for p in parts) == 20000
    assert abs(R.bernoulli_sample(keyed, 0.1).count() - 2000) < 300


def test_a_hot_key_can_be_spread_over_random_folds(spark):
    """A third of all rows share a key: by key they share a fold, without a key they do not."""
    df = spark.range(9000).withColumn("k", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")))
    hot = F.col("k") == -1
    assert R.with_fold(df, ["k"], 3).filter(hot).select("fold").distinct().count() == 1
    spread = R.with_fold(df, k=3).filter(hot).groupBy("fold").count().collect()
    assert len(spread) == 3 and all(abs(r["count"] - 1000) < 150 for r in spread)
    sizes = R.with_fold(df, k=3).groupBy("fold").count().collect()
    assert sum(r["count"] for r in sizes) == 9000
