"""Anomalies, validation and reports."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tankwise import jobs
from tankwise.operators import report, validate
from tankwise.operators.anomaly import AnomalyDetector, pressure_anomalies
from tankwise.sources.readers import nan_to_null, parse_payloads, read_csv, read_csv_inferred, read_records
from tankwise.sources.writers import record_json, write_json
from tests.frames import telemetry, to_spark

ORDER = ("timestamp", "id")


@pytest.fixture(params=[False, True], ids=["whole", "sliced"])
def sliced(request):
    if request.param:
        request.getfixturevalue("small_slices")


def series(spark, name: str, values):
    rows = [(i, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"id long, {name} double").withColumn("timestamp", F.timestamp_seconds(F.col("id") * 300))


def types(df):
    return [r["anomaly_type"] for r in df.orderBy("id").collect()]


def test_constant_series_is_not_stuck(spark, sliced):
    rows = series(spark, "co2_lpm", [100] * 60)
    assert AnomalyDetector(ORDER).union(rows, ["stuck_fermentation"]).count() == 0


def test_doubling_co2_is_over_vigorous(spark):
    found = AnomalyDetector(ORDER).union(series(spark, "co2_lpm", [100 * 2**i for i in range(10)]), ["over_vigorous_co2"])
    assert [r["id"] for r in found.orderBy("id").collect()] == [6, 7, 8, 9]
    assert set(types(found)) == {"over_vigorous_co2"} and found.first()["severity"] == "high"


def test_slow_pressure_ramp_is_fine(spark):
    rows = series(spark, "pressure_bar", np.arange(1.0, 2.0, 0.1))
    assert AnomalyDetector(ORDER).union(rows, ["rapid_pressure_rise"]).count() == 0
    assert types(pressure_anomalies(series(spark, "pressure_bar", [0.7, 0.8, 2.0, 2.1]))) == ["low_pressure", "high_pressure"]


def plain_union(frame: pd.DataFrame) -> set:
    d = frame.sort_values(["timestamp", "id"])
    rate, change, rise = d["co2_lpm"].diff(), d["do_ppm"].diff(), d["pressure_bar"].diff()
    size = change.abs()
    masks = {
        "stuck_fermentation": (rate.rolling(12, min_periods=1).mean() < 0.01) & (d["co2_lpm"] < d["co2_lpm"].quantile(0.7)),
        "oxidation_risk": change > size.mean() + 0.5 * size.std(),
        "high_pressure": d["pressure_bar"] > 2.0,
        "low_pressure": d["pressure_bar"] < 0.8,
        "abnormal_co2_activity": rate.abs() > rate.mean() + 3 * rate.std(),
        "over_vigorous_co2": rate / 5 > 500,
        "rapid_pressure_rise": rise / 5 > 0.1,
    }
    return {(name, i) for name, mask in masks.items() for i in d["id"][mask]}


@pytest.fixture
def sensors(spark):
    frame = telemetry(400).rename(columns={"ts": "timestamp", "x": "co2_lpm", "y": "do_ppm"})
    frame["co2_lpm"] = frame["co2_lpm"] * 40
    frame["pressure_bar"] = 1.4 + frame["do_ppm"] / 2
    return frame, to_spark(spark, frame)


def test_union_and_first_per_time(sensors, sliced):
    frame, rows = sensors
    detector = AnomalyDetector(ORDER)
    found = detector.union(rows).toPandas()
    assert set(zip(found["anomaly_type"], found["id"])) == plain_union(frame)
    best = detector.all(rows).toPandas()
    assert best["timestamp"].is_unique and set(best["timestamp"]) == set(found["timestamp"])
    ranks = {t: i for i, t in enumerate(["stuck_fermentation", "oxidation_risk", "high_pressure", "low_pressure", "abnormal_co2_activity", "over_vigorous_co2", "rapid_pressure_rise"])}
    first = found.assign(rank=found["anomaly_type"].map(ranks)).sort_values(["rank", "timestamp", "id"]).drop_duplicates("timestamp")
    assert set(zip(best["timestamp"], best["anomaly_type"], best["id"])) == set(zip(first["timestamp"], first["anomaly_type"], first["id"]))
    counts = {r["anomaly_type"]: r["anomalies"] for r in detector.counts(rows).collect()}
    assert counts == found["anomaly_type"].value_counts().to_dict()
    timeline = [r["timestamp"] for r in detector.timeline(rows).collect()]
    assert timeline == sorted(timeline) and len(timeline) == len(best)


def test_keyed_detection(sensors, sliced):
    frame, rows = sensors
    found = AnomalyDetector(ORDER, ("tank",)).union(rows, ["rapid_pressure_rise"]).toPandas()
    d = frame.sort_values(["timestamp", "id"])
    expected = d["id"][d.groupby("tank")["pressure_bar"].diff() / 5 > 0.1]
    assert set(found["id"]) == set(expected)


def test_golden_pattern_replaces_jumps(spark, sensors):
    _, rows = sensors
    rows = rows.withColumn("co2_lpm", F.coalesce("co2_lpm", F.lit(0.0)))
    opposite = spark.createDataFrame([(i, -1.0) for i in range(30)], "step long, co2_lpm double")
    found = AnomalyDetector(ORDER).union(rows, golden=opposite, batch="tank")
    kinds = {r[0]: r[1] for r in found.groupBy("anomaly_type").count().collect()}
    assert kinds["abnormal_co2_pattern"] == 400 and "abnormal_co2_activity" not in kinds
    assert found.filter("anomaly_type = 'abnormal_co2_pattern' and similarity_score < 0").count() == 400


def test_absent_sensors_find_nothing(spark):
    rows = spark.sql("select timestamp_seconds(id) timestamp, id from range(5)")
    detector = AnomalyDetector(ORDER)
    assert detector.union(rows).count() == detector.all(rows).count() == 0


def test_validation_rules(spark):
    rows = spark.sql(
        "select * from values (0, 1.0, 2, 'x'), (0, 9.0, 1, 'x'), (60, null, null, 'y'), (120, -1.0, 0, null)"
        " t(s, v, valve_state, name)"
    ).withColumn("t", F.timestamp_seconds("s"))
    rules = [
        validate.Schema("v"), validate.Schema("v", nullable=True), validate.Schema("v", "double", True), validate.Schema("w"),
        validate.Range("v", 0, 5), validate.Range("w", 0), validate.ValveState(), validate.AgitatorRange(),
        validate.DuplicateTimes("t"), validate.DuplicateTimes("absent"), validate.MissingShare(0.1), validate.OutlierShare("w"),
        validate.Range("t", 0, 1),
    ]
    found = [tuple(r) for r in validate.validate(rows, rules).collect()]
    by_name = {name: (passed, n, text) for name, passed, n, text in found}
    assert found[0] == ("schema_v", False, 1, "Column v has 1 null values")
    assert found[1][:2] == ("schema_v", True) and found[2][1] is False and "wrong dtype" in found[2][3]
    assert by_name["schema_w"] == (False, 1, "Column w missing")
    assert ("range_v", False, 2, "1 values below minimum 0; 1 values above maximum 5") in found
    assert by_name["valve_state_validation"] == (False, 2, "2 invalid valve_state values (must be 0 or 1)")
    assert by_name["agitator_rpm_validation"] == (True, 0, None) and by_name["outlier_w"][0]
    assert ("duplicate_timestamps", False, 1, "1 duplicate timestamps found") in found
    assert ("duplicate_timestamps", True, 0, None) in found
    assert by_name["missing_detection"][2] == "Columns with >10.0% missing: ['v', 'valve_state', 'name']"
    assert by_name["range_t"][0] is False and by_name["range_t"][2].startswith("Error executing rule")
    total = validate.overall(validate.validate(rows, rules, run_id="r1")).first()
    assert total["passed"] is False and total["errors"] == sum(not r[1] for r in found)


def test_duplicates_within_groups(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("a", 1), (None, 1), (None, 1), ("a", None), ("a", None)], "k string, t long")
    assert validate.duplicate_times(rows, "t", "k").first()[0] == 1
    assert validate.duplicate_times(rows, "t").first()[0] == 1


def test_sensor_summary_of_text(spark):
    row = validate.sensor_summary(spark.createDataFrame([("a",), (None,)], "do_ppm string")).first()
    assert row["mean"] is None and row["missing_count"] == 1


def test_recommendations(spark):
    metrics = spark.createDataFrame(
        [("a", 900.0, 10.0), ("b", 5000.0, 300.0), ("c", 0.0, 5.0), ("d", None, None)], "batch_id string, peak_co2_ppm double, duration_hours double"
    )
    found = spark.createDataFrame([("a", "stuck_fermentation"), ("a", "low_pressure"), ("b", "oxidation_risk")], "batch_id string, anomaly_type string")
    texts = {r["batch_id"]: r["recommendations"] for r in report.recommendations(metrics, found).collect()}
    assert texts["a"] == [report.STUCK_TEXT, report.PRESSURE_TEXT, report.LOW_PEAK_TEXT]
    assert texts["b"] == [report.OXIDATION_TEXT, report.LONG_TEXT]
    assert texts["c"] == texts["d"] == [report.NORMAL_TEXT]


def test_reports_and_json_sink(spark, sensors, tmp_path):
    _, rows = sensors
    found = AnomalyDetector(ORDER).all(rows)
    reports = report.batch_reports(rows, found, ORDER, "tank", "co2_lpm", "do_ppm", "pressure_bar", limit=3)
    write_json(reports, str(tmp_path / "reports"))
    lines = [json.loads(line) for p in (tmp_path / "reports").glob("*.json") for line in p.read_text().splitlines()]
    assert len(lines) == 3
    for line in lines:
        assert set(line) == {"tank", "generated_at", "summary", "metrics", "anomalies", "recommendations"}
        assert sum(line["anomalies"]["types"].values()) == line["anomalies"]["count"]
        assert line["summary"]["start_time"].startswith("2024-03-01T")


def test_record_json(spark):
    rows = spark.sql("select 1 n, cast(null as double) v, timestamp'2024-01-01 00:00:00' t")
    assert json.loads(record_json(rows).first()[0]) == {"n": 1.0, "v": None, "t": "2024-01-01T00:00:00.000000"}


def test_csv_and_nan(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        "timestamp_index,co2_ppm,o2_pct,pressure_kpa,process_temp_c,ambient_temp_c\n2024-01-01 00:00:00,1.5,NaN,,x,20\n"
    )
    row = read_csv(spark, str(tmp_path / "in.csv")).first()
    assert row["co2_ppm"] == 1.5 and row["o2_pct"] is None and row["pressure_kpa"] is None and row["process_temp_c"] is None
    assert read_csv_inferred(spark, str(tmp_path / "in.csv")).first()["ambient_temp_c"] == 20
    assert nan_to_null(spark.sql("select double('NaN') v")).first()[0] is None


PAYLOAD = {"sensor_data": [
    {"timestamp_index": "2024-01-01T00:00:00", "co2_ppm": 100.0, "pressure_kpa": 70.0, "o2_pct": 20.0, "batch_id": "b1"},
    {"timestamp": "2024-01-01T00:05:00", "co2_lpm": 4000.0, "pressure_bar": 2.2, "note": "extra", "batch_id": "b1"},
]}


def test_records_and_detection_job(spark, tmp_path):
    frame = spark.createDataFrame([(json.dumps(PAYLOAD),)], "payload string")
    records = parse_payloads(frame, "payload")
    found = jobs.detect(records, ("timestamp",))
    assert {(r["anomaly_type"], r["co2_lpm"]) for r in found.collect()} == {("low_pressure", 100.0), ("high_pressure", 4000.0)}
    assert json.loads(jobs.detect(records, ("timestamp",), as_json=True).first()[0])["severity"] in ("medium", "high")
    (tmp_path / "r.json").write_text("\n".join(json.dumps(r) for r in PAYLOAD["sensor_data"]))
    assert read_records(spark, str(tmp_path / "r.json")).count() == 2
    summary = jobs.batch_summary(read_records(spark, str(tmp_path / "r.json"))).first()
    assert summary["peak_co2_ppm"] == 100.0 and summary["num_samples"] == 2
