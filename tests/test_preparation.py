"""Gap filling, outliers, scaling, resampling, phases: against pandas and worked examples."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tankwise import jobs
from tankwise.operators import align, missing, outliers, resample, schema_map
from tankwise.operators.scaling import Scaler
from tests.frames import by_id, telemetry, to_spark

ORDER = ("ts", "id")


def same(mine, expected):
    np.testing.assert_allclose(mine.to_numpy(float), expected.to_numpy(float), atol=1e-9, equal_nan=True)


@pytest.fixture(params=[False, True], ids=["whole", "sliced"])
def sliced(request):
    if request.param:
        request.getfixturevalue("small_slices")


@pytest.mark.parametrize("limit", [1, 3, None])
def test_interpolate_and_fill(spark, sliced, limit):
    frame = telemetry()
    rows = to_spark(spark, frame)
    x = frame.sort_values(["ts", "id"])["x"]
    for operator, expected in (
        (missing.interpolate, x.interpolate(method="linear", limit=limit)),
        (missing.forward_fill, x.ffill(limit=limit)),
    ):
        same(by_id(operator(rows, ORDER, ["x"], limit=limit), "x")["x"], expected.sort_index())
    same(by_id(missing.backward_fill(rows, ORDER, ["x"]), "x")["x"], x.bfill().sort_index())


@pytest.mark.parametrize("method", ["interpolate", "forward_fill", "both"])
def test_missing_handler(spark, sliced, method):
    frame = telemetry(seed=11)
    frame["name"] = np.where(frame["id"] % 7 == 0, "n" + frame["id"].astype(str), None)
    rows = to_spark(spark, frame)
    pdf = frame.sort_values(["ts", "id"])[["x", "name"]]
    x, name = pdf["x"], pdf["name"]
    if method in ("interpolate", "both"):
        x = x.interpolate(method="linear", limit=3)
    if method in ("forward_fill", "both"):
        x, name = x.ffill(limit=3), name.ffill(limit=3)
    x, name = x.bfill(), name.bfill()
    model = missing.MissingHandler(ORDER, method, 3, columns=["x", "name"]).fit(rows)
    found = by_id(model.transform(rows), "x", "name")
    same(found["x"], x.sort_index())
    assert found["name"].where(found["name"].notna(), None).tolist() == [
        v if isinstance(v, str) else None for v in name.sort_index()
    ]
    report = model.report()["missing_statistics"]
    assert report["total_missing"]["x"] == frame["x"].isna().sum()
    assert "y" not in report["columns_with_missing"]


def test_keyed_fill_stays_within_the_key(spark, sliced):
    frame = telemetry(seed=5)
    found = by_id(missing.fill_gaps(to_spark(spark, frame), ORDER, ["tank"], ["x"], "forward_fill", 2), "x")
    expected = frame.sort_values(["ts", "id"]).groupby("tank")["x"].transform(lambda s: s.ffill(limit=2).bfill())
    same(found["x"], expected.sort_index())


def test_worked_gaps(spark):
    rows = spark.createDataFrame(list(enumerate([1.0, 2.0, None, 4.0, 5.0, None, 7.0])), "id long, value double")
    filled = missing.MissingHandler(["id"], columns=["value"]).fit(rows).transform(rows)
    assert [r["value"] for r in filled.orderBy("id").collect()] == [1, 2, 3, 4, 5, 6, 7]


OUTLIER = [1, 2, 3, 4, 5, 100, 6, 7, 8, 9]


@pytest.fixture
def outlier_rows(spark):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(OUTLIER)], "id long, value double")


def test_outliers_worked(outlier_rows):
    handle = {a: outliers.OutlierHandler("both", action=a, columns=["value"]).fit(outlier_rows) for a in ("clip", "remove", "mark")}
    assert handle["clip"].active["value"] == (-3.5, 14.5)
    assert handle["clip"].transform(outlier_rows).agg(F.max("value")).first()[0] == 14.5
    assert handle["remove"].transform(outlier_rows).count() == 9
    assert handle["mark"].transform(outlier_rows).agg(F.sum("value_outlier")).first()[0] == 1
    assert set(handle["clip"].report()["bounds"]) == {"value_iqr", "value_zscore"}


def test_outliers_keep_missing_and_skip_constant(spark):
    rows = spark.createDataFrame([(None, 1.0), (2.0, 1.0), (900.0, 1.0)], "a double, b double")
    clipped = outliers.clip(rows, {"a": (0.0, 5.0)}).collect()
    assert [r["a"] for r in clipped] == [None, 2.0, 5.0]
    assert "b" not in outliers.zscore_bounds(rows, ["a", "b"])
    assert outliers.remove(rows, {"a": (0.0, 5.0)}).count() == 2


def test_sequential_counts(spark):
    rows = spark.createDataFrame([(9.0, 9.0), (9.0, 1.0), (1.0, 9.0)], "a double, b double")
    bounds = {"a": (0.0, 5.0), "b": (0.0, 5.0)}
    counts = {s: [r["outliers"] for r in outliers.outlier_counts(rows, bounds, s).collect()] for s in (False, True)}
    assert counts == {False: [2, 2], True: [2, 1]}


def test_scaling_worked(spark):
    rows = spark.createDataFrame(
        [("A", 10.0), ("A", 20.0), ("B", 100.0), ("B", 200.0), ("C", 5.0), (None, 7.0)], "tank_id string, value double"
    )
    model = Scaler("standard", "tank_id", ["value"]).fit(rows.filter("tank_id in ('A', 'B')"))
    found = {(r[0], round(r[1], 6)) for r in model.transform(rows).collect()}
    assert found == {("A", -0.707107), ("A", 0.707107), ("B", -0.707107), ("B", 0.707107), ("C", 5.0), (None, 7.0)}
    assert model.report()["groups_processed"] == 2
    lonely = Scaler("standard", "tank_id", ["value"]).fit(rows).transform(rows)
    assert lonely.filter("tank_id = 'C'").first()["value"] is None


@pytest.mark.parametrize("method", ["standard", "minmax", "robust"])
@pytest.mark.parametrize("by", [None, "tank"])
def test_scaling(spark, sliced, method, by):
    frame = telemetry()
    rows = to_spark(spark, frame)
    found = by_id(Scaler(method, by, ["x"]).fit(rows).transform(rows), "x")["x"]

    def scale(s):
        if method == "standard":
            return (s - s.mean()) / (s.std() + 1e-10)
        if method == "minmax":
            return (s - s.min()) / (s.max() - s.min() + 1e-10)
        return (s - s.median()) / (s.quantile(0.75) - s.quantile(0.25) + 1e-10)

    same(found, frame.groupby("tank")["x"].transform(scale) if by else scale(frame["x"]))


def test_scaler_without_its_group_column_is_global(spark):
    rows = spark.createDataFrame([(1.0,), (3.0,)], "value double")
    model = Scaler("minmax", "tank_id").fit(rows)
    assert [round(r[0], 6) for r in model.transform(rows).collect()] == [0.0, 1.0]


@pytest.mark.parametrize("method", ["mean", "median", "interpolate"])
@pytest.mark.parametrize("minutes", [5, 7])
@pytest.mark.parametrize("by", [(), ("tank",)])
def test_resample(spark, sliced, method, minutes, by):
    frame = telemetry(150, hot_instant=False)
    found = resample.resample(to_spark(spark, frame), "ts", minutes, method, by, ["x", "y"]).toPandas()
    found = found.sort_values([*by, "ts"]).reset_index(drop=True)

    def grid(pdf):
        made = pdf.set_index("ts")[["x", "y"]].resample(f"{minutes}min")
        made = made.median() if method == "median" else made.mean()
        return (made.interpolate() if method == "interpolate" else made).reset_index()

    if by:
        expected = pd.concat([grid(g).assign(tank=k) for k, g in frame.groupby("tank")], ignore_index=True)
    else:
        expected = grid(frame)
    expected = expected.sort_values([*by, "ts"]).reset_index(drop=True)
    assert found["ts"].tolist() == expected["ts"].tolist()
    same(found[["x", "y"]], expected[["x", "y"]])


def test_modal_interval_prefers_the_smallest(spark):
    rows = spark.sql("select timestamp_seconds(id) ts from values (0), (60), (120), (420), (720) t(id)")
    found = resample.modal_interval(rows, ["ts"]).first()
    assert (found["interval_seconds"], found["occurrences"]) == (60.0, 2)


def test_phase_rules(spark):
    values = [(None, "s"), (-1.0, "s"), (50.0, "s"), (400.0, "s"), (800.0, "s"), (950.0, "s"), (600.0, "t"), (None, "t")]
    rows = spark.createDataFrame(values, "v double, strain string").withColumn("style", F.lit("i"))
    profiles = spark.createDataFrame([("s", "i", 1000.0)], "strain string, style string, max_co2 double")
    found = [r["phase"] for r in align.Aligner("v", profiles).fit(rows).transform(rows).collect()]
    assert found == ["decline", "lag", "lag", "exponential", "stationary", "decline", "exponential", "decline"]
    labelled = rows.withColumn("phase", F.lit("kept"))
    assert align.align(labelled, profiles, "v").filter("phase <> 'kept'").count() == 0
    with pytest.raises(ValueError, match="co2_ppm"):
        align.align(rows, profiles, "co2_ppm")


def test_global_profile_without_keys(spark):
    rows = spark.createDataFrame([(10.0,), (100.0,)], "v double")
    model = align.Aligner("v").fit(rows)
    assert model.profiles.first()["strain"] == "default"
    assert [r["phase"] for r in model.transform(rows).collect()] == ["exponential", "decline"]


LEGACY = "timestamp_index timestamp, co2_ppm double, o2_pct double, pressure_kpa double, process_temp_c double"


def test_schema_round_trip(spark):
    times = pd.date_range("2024-01-01", periods=10, freq="5min")
    rows = spark.createDataFrame(
        [(t.to_pydatetime(), 100.0 * i, 20.0, 95.0 + i, 18.0) for i, t in enumerate(times)], LEGACY
    )
    mapped = schema_map.to_canonical(rows)
    assert {"timestamp", "co2_lpm", "do_ppm", "temp_c", "pressure_bar", "valve_state", "agitator_rpm", "pitch_time", "OG", "target_attenuation"} <= set(mapped.columns)
    first = mapped.orderBy("timestamp").collect()
    assert [r["valve_state"] for r in first] == [0] * 6 + [1] * 4
    assert first[3]["OG"] == pytest.approx(1.04) and first[3]["agitator_rpm"] == 1000.0
    back = schema_map.to_legacy(mapped).select(rows.columns)
    assert sorted(back.toPandas().round(9).itertuples(index=False)) == sorted(rows.toPandas().itertuples(index=False))


def test_minimal_legacy(spark):
    times = pd.date_range("2024-01-01", periods=5, freq="5min")
    rows = spark.createDataFrame([(t.to_pydatetime(), 100.0 * (i + 1)) for i, t in enumerate(times)], "timestamp_index timestamp, co2_ppm double")
    mapped = schema_map.with_identity(schema_map.to_canonical(rows)).first()
    assert mapped["valve_state"] == 1 and mapped["OG"] == pytest.approx(1.05)
    assert mapped["tank_id"] == mapped["batch_id"] == "2024-01-01"
    assert (mapped["strain"], mapped["style"]) == ("default_strain", "default_style")


def test_fit_transform_equals_fit_then_transform(spark):
    frame = telemetry(200, hot_instant=False).rename(columns={"tank": "tank_id"})
    rows = to_spark(spark, frame).withColumns({"strain": F.lit("s"), "style": F.lit("i")})
    chain = jobs.preprocessing(ORDER, ["x", "y"], minutes=10)
    model, once = jobs.fit_transform(chain, rows)
    twice = chain.fit(rows).transform(rows)
    columns = ["tank_id", "ts", "x", "y", "phase"]
    a, b = (d.select(columns).toPandas().sort_values(["tank_id", "ts"]).reset_index(drop=True) for d in (once, twice))
    pd.testing.assert_frame_equal(a, b)
    assert [r["preprocessor"] for r in jobs.reports(model)] == ["MissingHandler", "OutlierHandler", "Resampler", "Aligner", "Normalizer"]
