"""Every query with SQL gives the result of that SQL on the smallest tables, whole and sliced."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
from tests.oracle import connect, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are absent")

# Ordered operators once more with slices of a few hundred rows.
SLICED = [
    "anom_all", "attenuation_slope", "cp_window", "feat_lag_by_tank", "golden_similarity", "interpolate_limit",
    "outlier_clip", "resample_median", "rolling_stats", "scale_robust_by_tank",
]


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def compare(spark, connection, name):
    mine = driver.queries()[name](spark, FOLDER).toPandas()
    assert difference(mine, connection.execute(driver.oracle_sql()[name]).df()) is None


@pytest.mark.parametrize("name", driver.oracle_sql())
def test_query(spark, connection, name):
    compare(spark, connection, name)


@pytest.mark.parametrize("name", SLICED)
def test_sliced_query(spark, connection, name):
    spark.conf.set("spark.tankwise.rowsPerSlice", "150")
    try:
        compare(spark, connection, name)
    finally:
        spark.conf.unset("spark.tankwise.rowsPerSlice")


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_json_records(spark):
    assert driver.queries()["anomaly_json"](spark, FOLDER).count() == driver.queries()["anom_all"](spark, FOLDER).count()
