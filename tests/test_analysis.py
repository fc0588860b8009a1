"""Batch analytics, similarity, features, changepoints: against pandas and numpy."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tankwise.functions.moments import rolling_stages, statistic
from tankwise.operators import align, batch, changepoints, features, similarity
from tankwise.plans.ordered import arrange
from tests.frames import by_id, telemetry, to_spark

ORDER = ("ts", "id")


@pytest.fixture(params=[False, True], ids=["whole", "sliced"])
def sliced(request):
    if request.param:
        request.getfixturevalue("small_slices")


def corrected_kurtosis(window):
    return window.kurt() if len(window) > 3 else 0.0


@pytest.mark.parametrize("length", [1, 5, 6, 12])
def test_rolling_moments(spark, sliced, length):
    frame = telemetry(300, hot_instant=False)
    frame["x"] += 1e6  # a large level must not spoil the spread
    rows = arrange(to_spark(spark, frame), ORDER)
    found = rows.framed(
        lambda w: [*rolling_stages(["x", "y"], [length], w), {f"{c}_{s}": statistic(c, length, s) for c in "xy" for s in ("mean", "std", "skew", "kurt")}],
        back=length - 1,
    )
    columns = [f"{c}_{s}" for c in "xy" for s in ("mean", "std", "skew", "kurt")]
    mine = by_id(found.result(), *columns)
    for c in "xy":
        rolling = frame[c].rolling(length, min_periods=1)
        parts = [frame[c].iloc[max(0, i - length + 1) : i + 1] for i in range(len(frame))]
        for name, expected in (
            ("mean", rolling.mean()),
            ("std", rolling.std()),
            ("skew", pd.Series([p.skew() for p in parts])),
            ("kurt", pd.Series([corrected_kurtosis(p) if p.notna().any() else np.nan for p in parts])),
        ):
            np.testing.assert_allclose(mine[f"{c}_{name}"], expected, atol=2e-6, rtol=1e-6, equal_nan=True)


def test_batch_metrics_worked(spark):
    rows = spark.createDataFrame(
        [
            ("a", 0, 10.0, 8.0, 100.0), ("a", 300, 50.0, 5.0, 101.0), ("a", 600, 50.0, 4.0, 99.0), ("a", 900, None, 1.0, 104.0),
            ("b", 0, None, None, 100.0), ("b", 60, None, 0.0, 100.5),
            ("c", 0, 5.0, 0.0, None),
        ],
        "batch_id string, s long, co2_ppm double, o2_pct double, pressure_kpa double",
    ).withColumn("timestamp_index", F.timestamp_seconds("s"))
    found = {r["batch_id"]: r for r in batch.batch_metrics(rows).collect()}
    a, b, c = found["a"], found["b"], found["c"]
    assert tuple(a)[1:] == (50.0, 5.0, 10.0, 4.0, 0.25, 4)
    assert tuple(b)[1:] == (None, None, None, 0.5, pytest.approx(1 / 60), 2)
    assert tuple(c)[1:] == (5.0, 0.0, None, None, 0.0, 1)


def test_batch_metrics_derives_batches_and_allows_absent_sensors(spark):
    rows = spark.sql("select timestamp_seconds(id * 50000) timestamp_index, double(id) co2_ppm from range(4)")
    found = batch.batch_metrics(rows).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["num_samples"], r["do_half_life_minutes"]) for r in found] == [
        ("1970-01-01", 2, None), ("1970-01-02", 2, None)]


def test_attenuation_slope(spark, sliced):
    frame = telemetry(400)
    frame["y"] = np.where(frame["tank"] == "a", 3.0, frame["y"])
    frame.loc[frame.index[frame["tank"] == "b"][:1], "y"] = np.nan
    found = {r["tank"]: r for r in batch.attenuation_slope(to_spark(spark, frame), ORDER, "tank", "y").collect()}
    assert set(found) == {"hot", "c"}
    for tank, row in found.items():
        y = frame[frame.tank == tank].sort_values(["ts", "id"])["y"].to_numpy()
        assert row["attenuation_slope"] == pytest.approx(np.polyfit(np.arange(len(y)), y, 1)[0])
        assert (row["initial_co2"], row["final_co2"]) == (y[0], y[-1])


def test_pivot_needs_a_bounded_number_of_columns(spark):
    rows = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 5.0)], "b string, k string, v double")
    made = batch.compare(rows, "b", "v", columns="k").orderBy("b").collect()
    assert [tuple(r) for r in made] == [("a", 1.0, 2.0), ("b", 5.0, None)]
    with pytest.raises(ValueError, match="distinct"):
        batch.compare(rows, "b", "v", columns="k", max_columns=1)
    assert batch.compare(rows, "b", "v", "max").filter("b = 'a'").first()["v"] == 2.0


def test_pearson(spark):
    frame = telemetry(200)
    frame["z"] = 4.0
    rows = to_spark(spark, frame.assign(w=frame["y"] * 2 + frame["id"]))
    found = {(r["a"], r["b"]): r["correlation"] for r in similarity.pearson_matrix(rows, ["y", "w", "x", "z"]).collect()}
    assert found["y", "w"] == pytest.approx(np.corrcoef(frame["y"], frame["y"] * 2 + frame["id"])[0, 1])
    assert found["y", "y"] == pytest.approx(1.0) and len(found) == 16
    assert all(v is None for (a, b), v in found.items() if "x" in (a, b) or "z" in (a, b))


def test_distances(spark):
    rows = spark.createDataFrame([("a", [0.0, 0.0]), ("b", [3.0, 4.0]), ("c", [0.0, 1.0])], "e string, v array<double>")
    found = {(r["a"], r["b"]): r["distance"] for r in similarity.distances(rows, "e", "v", blocks=3).collect()}
    assert len(found) == 9 and found["a", "b"] == found["b", "a"] == 5.0 and found["c", "c"] == 0.0


def test_golden_similarity(spark, sliced):
    frame = telemetry(300, hot_share=0.4)
    golden = np.sin(np.arange(40) / 6) + 2
    curve = spark.createDataFrame([(i * 3, float(v)) for i, v in enumerate(golden)], "step long, g double")
    found = similarity.golden_similarity(to_spark(spark, frame), curve, ORDER, "y", "tank", golden_value="g")
    for row in found.collect():
        y = frame[frame.tank == row["tank"]].sort_values(["ts", "id"])["y"].to_numpy()
        g = np.interp(np.linspace(0, 39, len(y)), np.arange(40), golden)
        expected = np.dot(y, g) / ((np.linalg.norm(y) + 1e-10) * (np.linalg.norm(g) + 1e-10))
        assert row["similarity"] == pytest.approx(expected, abs=1e-9)
    gaps = similarity.golden_similarity(to_spark(spark, frame), curve, ORDER, "x", "tank", golden_value="g")
    assert gaps.filter("similarity is not null").count() == 0
    absent = similarity.golden_similarity(to_spark(spark, frame), curve, ORDER, "nothing", "tank")
    assert {r["similarity"] for r in absent.collect()} == {0.0}


def test_curves(spark, tmp_path):
    from tankwise.sources.writers import load_curves, save_curves

    rows = spark.sql(
        "select concat('b', b) batch_id, '007' strain, 'i_p' style, timestamp_seconds(b * 86400 + s * 300) ts, double(b + s) v"
        " from (select explode(array(0, 1)) b) lateral view explode(sequence(0, 19)) as s"
    )
    curves = align.learn_curves(rows, "ts", ["v"])
    found = curves.orderBy("step").collect()
    assert [r["v"] for r in found] == [s + 0.5 for s in range(20)]
    assert [r["phase"] for r in found] == ["lag"] * 2 + ["exponential"] * 6 + ["stationary"] * 6 + ["decline"] * 6
    save_curves(curves, str(tmp_path / "curves"))
    loaded = load_curves(spark, str(tmp_path / "curves"))
    assert align.lookup_curve(loaded, "007", "i_p").count() == 20 and align.lookup_curve(loaded, "7", "i_p").count() == 0
    replaced = align.add_curve(loaded, curves.limit(1))
    assert replaced.count() == 1


def test_all_features_count_and_values(spark, sliced):
    frame = telemetry(120, hot_instant=False).rename(columns={"x": "co2_lpm", "y": "do_ppm"})
    rows = to_spark(spark, frame).withColumns(
        {"temp_c": F.lit(20.0), "pressure_bar": F.lit(1.5), "valve_state": F.col("id") % 2, "agitator_rpm": F.col("id") * 10.0,
         "OG": F.lit(1.05), "target_attenuation": F.lit(75.0), "phase": F.lit("lag")})
    made = features.all_features(rows, ORDER)
    assert len(made.columns) - len(rows.columns) == 76
    assert len(features.all_features(rows, ORDER, time="ts").columns) - len(rows.columns) == 84
    found = by_id(made, "co2_lpm_lag_3", "valve_state_change", "agitator_rpm_normalized", "do_ppm_rolling_std_24", "phase_encoded")
    np.testing.assert_allclose(found["co2_lpm_lag_3"], frame["co2_lpm"].shift(3), equal_nan=True)
    np.testing.assert_allclose(found["do_ppm_rolling_std_24"], frame["do_ppm"].rolling(24, min_periods=1).std(), atol=1e-9, equal_nan=True)
    assert found["valve_state_change"].iloc[1:4].tolist() == [1, -1, 1]
    assert found["agitator_rpm_normalized"].iloc[-1] == pytest.approx(1.0) and set(found["phase_encoded"]) == {0}


def test_absent_columns_are_skipped(spark):
    rows = spark.createDataFrame([(1, 2.0)], "id long, a double")
    assert features.polynomial(rows, ["a", "b"]).columns == ["id", "a", "a_poly_2"]
    assert features.interactions(rows, [("a", "b")]).columns == rows.columns
    assert features.temporal(rows).columns == features.encoded_phase(rows).columns == rows.columns
    assert features.all_features(rows, ["id"]).columns == rows.columns


def test_weeks_start_on_monday(spark):
    row = features.temporal(spark.sql("select timestamp'2024-01-01 06:00:00' timestamp_index")).first()
    assert (row["day_of_week"], row["hour"], row["month"]) == (0, 6, 1)
    assert row["hour_sin"] == pytest.approx(math.sin(2 * math.pi * 6 / 24))


def plain_changepoints(x, method, threshold):
    n, found = len(x), []
    if method == "cusum":
        total = np.cumsum(x - x.mean())
        found = [i for i in range(1, n) if abs(total[i]) > threshold * x.std()]
    elif method == "window":
        w = min(50, n // 10)
        found = [i for i in range(w, n - w) if abs(x[i : i + w].mean() - x[i - w : i].mean()) > threshold * x.std()] if w else []
    else:
        d = np.diff(x)
        found = [i + 1 for i in range(n - 1) if abs(d[i]) > threshold * d.std()]
    return found


@pytest.mark.parametrize("method", ["cusum", "window", "pelt"])
@pytest.mark.parametrize("rows", [9, 240])
def test_changepoints(spark, sliced, method, rows):
    frame = telemetry(rows, hot_instant=False) if rows > 100 else telemetry(200).head(rows)
    frame["y"] = frame["y"].fillna(0) + np.where(frame["id"] > rows // 2, 2.0, 0.0)
    data = to_spark(spark, frame)
    x = frame.sort_values(["ts", "id"])["y"].to_numpy()
    found = changepoints.detect(data, ORDER, "y", method, 1.2).orderBy("idx").collect()
    assert [r["idx"] for r in found] == plain_changepoints(x, method, 1.2)
    assert [r["value"] for r in found] == [x[r["idx"]] for r in found]
    marked = changepoints.boundaries(data, ORDER, "y", method, 1.2).collect()
    assert all(r["num_changepoints"] == len(found) for r in marked)


def test_changepoints_need_a_whole_series(spark):
    frame = telemetry(100)
    assert changepoints.detect(to_spark(spark, frame), ORDER, "x").count() == 0
    with pytest.raises(ValueError, match="nothing"):
        changepoints.detect(to_spark(spark, frame), ORDER, "nothing")
