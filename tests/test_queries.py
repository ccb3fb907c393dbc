"""Every query with SQL beside it gives the SQL's rows, whole and exact."""

import duckdb
import pytest

from __spark_entry__ import entry
from linfit.catalog import ORACLES, QUERIES
from tools.check_oracles import TABLES, same_type, table

ROWS_ONLY = {
    "bernoulli_sample",
    "cv_multinomial_logloss",
    "cv_native_auc",
    "cv_native_logloss",
    "job_click_prediction",
    "job_logistic_cv",
    "job_multiclass_probabilities",
    "job_song_year",
    "logistic_high_cardinality",
    "logistic_multinomial",
}


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return connection


def test_only_library_fits_and_samples_lack_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    mine = table(df.columns, df.collect())
    cursor = duck.execute(ORACLES[name])
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    assert mine == table([c[0] for c in cursor.description], cursor.fetchall())
    assert mine[1]
    assert all(same_type(t, kinds[c]) for c, t in df.dtypes)


@pytest.mark.parametrize("name", ["bernoulli_sample", "logistic_multinomial"])
def test_rows_only_queries(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    assert entry(spark).count() == 1
