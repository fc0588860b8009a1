import numpy as np
import pytest
from pyspark.sql import functions as F

from tankwise.plans.quantiles import group_quantiles, table_quantiles
from tests.frames import telemetry, to_spark

SHARES = [0.0, 0.25, 0.5, 0.7, 0.75, 1.0]


@pytest.mark.parametrize("sample", [60, 1_000_000])
def test_narrowing_equals_numpy(spark, small_slices, sample):
    """A poor sample only costs rounds. Small limits force several rounds of brackets; heavy values end a bracket at once."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(0, 1, 5000), 4)
    x[:1700] = 0.5
    y = rng.integers(0, 7, 5000).astype(float)
    rows = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    found = table_quantiles(rows, ["x", "y"], SHARES, bounded=20, sample=sample)
    np.testing.assert_allclose(found["x"], np.quantile(x, SHARES), rtol=0, atol=1e-12)
    np.testing.assert_allclose(found["y"], np.quantile(y, SHARES), rtol=0, atol=1e-12)


def test_missing_values_do_not_count(spark):
    rows = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert table_quantiles(rows, ["x"], [0.5])["x"] == [2.0]
    nothing = rows.filter("false")
    assert table_quantiles(nothing, ["x"], [0.5])["x"] == [None]


@pytest.mark.parametrize("sliced", [False, True])
def test_groups(spark, sliced, request):
    if sliced:
        request.getfixturevalue("small_slices")
    frame = telemetry(500)
    found = group_quantiles(to_spark(spark, frame), ["tank"], ["x", "y"], SHARES).collect()
    assert len(found) == 8
    for row in found:
        values = frame.loc[frame.tank == row["tank"], row["column"]].dropna()
        np.testing.assert_allclose(row["q"], values.quantile(SHARES), atol=1e-9)


def test_two_heavy_values(spark, small_slices):
    """The wanted ranks fall on both sides of the border between two values."""
    rows = spark.range(400).selectExpr("if(id % 2 = 0, 1D, 3D) AS x")
    found = table_quantiles(rows, ["x"], [0.25, 0.5, 0.75], bounded=20, sample=50)
    assert found["x"] == [1.0, 2.0, 3.0]


def test_nan_counts_as_missing(spark, small_slices):
    """The same with and without narrowing."""
    rows = spark.range(500).selectExpr("if(id % 3 = 0, double('NaN'), double(id)) AS x", "id % 2 AS g")
    kept = [float(k) for k in range(500) if k % 3]
    narrowed = table_quantiles(rows, ["x"], SHARES, bounded=20, sample=60)["x"]
    np.testing.assert_allclose(narrowed, np.quantile(kept, SHARES))
    spark.conf.set("spark.tankwise.rowsPerSlice", "100000")
    assert table_quantiles(rows, ["x"], SHARES)["x"] == pytest.approx(narrowed)
    for row in group_quantiles(rows, ["g"], ["x"], SHARES).collect():
        np.testing.assert_allclose(row["q"], np.quantile([k for k in kept if k % 2 == row["g"]], SHARES))
