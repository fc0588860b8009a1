"""A stream gives what the batch gives."""

import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tankwise.operators.anomaly import AnomalyDetector, pressure_anomalies
from tankwise.operators.resample import resample
from tankwise.streaming.alerts import pressure_alerts, rate_alerts, resampled
from tankwise.operators.anomaly import Thresholds
from tankwise.streaming.stateful import _Detection, _Grid, alerts, read_thresholds, resampled_grid, write_thresholds
from tests.frames import telemetry, to_spark


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Telemetry in time order, as a folder of files that a stream reads one by one."""
    frame = telemetry(400, hot_instant=False).rename(columns={"ts": "timestamp", "x": "co2_lpm", "y": "pressure_bar"})
    frame["co2_lpm"] = frame["co2_lpm"] * 60
    rows = to_spark(spark, frame)
    folder = str(tmp_path_factory.mktemp("stream") / "rows")
    for part in range(4):
        chosen = rows.filter((F.col("id") >= part * 100) & (F.col("id") < (part + 1) * 100))
        chosen.coalesce(1).write.mode("append").parquet(folder)
    return folder, rows.schema


def source(spark, files):
    folder, schema = files
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder), spark.read.parquet(folder)


def finished(stream, name, tmp_path, mode="append"):
    query = (
        stream.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.table(name)


def test_pressure_alerts(spark, files, tmp_path):
    stream, rows = source(spark, files)
    found = finished(pressure_alerts(stream), "pressure", tmp_path)
    expected = pressure_anomalies(rows)
    assert found.exceptAll(expected).count() == 0 and found.count() == expected.count() > 0


def test_resampled(spark, files, tmp_path):
    stream, rows = source(spark, files)
    found = finished(resampled(stream, "timestamp", ["co2_lpm"], ["tank"], 5), "means", tmp_path)
    expected = {
        (r["tank"], r["timestamp"]): r["co2_lpm"]
        for r in resample(rows, "timestamp", 5, "mean", ["tank"], ["co2_lpm"]).collect()
    }
    mine = {(r["tank"], r["timestamp"]): r["co2_lpm"] for r in found.collect()}
    assert len(mine) > 50
    for key, value in mine.items():
        assert value == pytest.approx(expected[key]) if value is not None else expected[key] is None


def shuffled(spark, tmp_path, rows, minutes=60, parts=6, seed=3):
    """A stream of ``rows`` in several files, each row up to ``minutes`` late and out of order within its
    file, some rows split from others of their time; a last file is far ahead and closes what is open."""
    rng = np.random.default_rng(seed)
    frame = rows.toPandas()
    arrival = frame["timestamp"] + pd.to_timedelta(rng.uniform(0, minutes * 0.9, len(frame)), unit="m")
    part = np.minimum((arrival.rank(method="first") - 1) * parts // len(frame), parts - 1).astype(int)
    folder = tmp_path / "shuffled"
    for k in range(parts):
        some = frame[part == k].sample(frac=1, random_state=seed)
        to_rows(spark, some, rows.schema).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.05)
    last = frame.tail(1).assign(tank="closing", timestamp=frame["timestamp"].max() + pd.Timedelta(days=2))
    to_rows(spark, last, rows.schema).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(folder)), folder


def to_rows(spark, frame, schema):
    made = [tuple(None if pd.isna(v) else v for v in row) for row in frame.astype(object).itertuples(index=False)]
    return spark.createDataFrame([tuple(v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in r) for r in made], schema)


@pytest.fixture(scope="module")
def rows(spark, files):
    found = spark.read.parquet(files[0])
    return found.withColumn("do_ppm", F.col("id") % 7 + F.when(F.col("id") % 11 == 0, 5.0).otherwise(0.0))


def test_rate_alerts_for_any_order(spark, rows, tmp_path):
    stream, _ = shuffled(spark, tmp_path, rows)
    found = finished(rate_alerts(stream, "tank", "timestamp", "id", "60 minutes"), "rates", tmp_path)
    batch = AnomalyDetector(("timestamp", "id"), ("tank",)).union(rows, ["over_vigorous_co2", "rapid_pressure_rise"])
    expected = {(r["id"], r["anomaly_type"]) for r in batch.collect()}
    mine = [(r["id"], r["anomaly_type"]) for r in found.collect()]
    assert set(mine) == expected and len(mine) == len(expected) and len({k for _, k in mine}) == 2


def test_all_detectors_equal_the_batch(spark, rows, tmp_path):
    detector = AnomalyDetector(("timestamp", "id"), ("tank",))
    limits = detector.fit(rows)
    path = str(tmp_path / "limits")
    write_thresholds(spark, limits, path)
    assert read_thresholds(spark, path) == limits
    stream, _ = shuffled(spark, tmp_path, rows, seed=9)
    found = finished(alerts(stream, "tank", "timestamp", "id", read_thresholds(spark, path), lateness="60 minutes"), "all_types", tmp_path)
    batch = detector.union(rows, thresholds=limits)
    expected = {(r["id"], r["anomaly_type"], r["severity"], r["timestamp"], r["co2_rolling_mean"]) for r in batch.collect()}
    mine = [
        (r["id"], r["anomaly_type"], r["severity"], r["timestamp"], r["co2_rolling_mean"] if r["anomaly_type"] == "stuck_fermentation" else None)
        for r in found.filter("tank <> 'closing'").collect()
    ]
    assert len(mine) == len(expected) and len({m[1] for m in mine}) >= 5
    assert {m[:4] for m in mine} == {m[:4] for m in expected}
    means = {m[0]: m[4] for m in expected if m[1] == "stuck_fermentation"}
    assert all(m[4] == pytest.approx(means[m[0]]) for m in mine if m[1] == "stuck_fermentation")


def test_late_and_repeated_rows(spark, rows, tmp_path):
    """Rows behind the watermark are dropped, rows given twice are two rows as in the batch."""
    stream, folder = shuffled(spark, tmp_path, rows.unionByName(rows.filter("id % 50 = 1")))
    time.sleep(0.05)
    rows.limit(5).coalesce(1).write.mode("append").parquet(str(folder))  # after the closing row
    found = finished(rate_alerts(stream, "tank", "timestamp", "id", "60 minutes"), "late", tmp_path)
    twice = rows.unionByName(rows.filter("id % 50 = 1"))
    batch = AnomalyDetector(("timestamp", "id"), ("tank",)).union(twice, ["over_vigorous_co2", "rapid_pressure_rise"])
    assert found.count() == batch.count()


def test_restart_from_the_checkpoint(spark, rows, tmp_path):
    folder, point = str(tmp_path / "grown"), str(tmp_path / "point")
    out = str(tmp_path / "out")
    half = rows.filter("id < 200"), rows.filter("id >= 200")
    for part in half:
        part.coalesce(1).write.mode("append").parquet(folder)
        stream = rate_alerts(spark.readStream.schema(rows.schema).parquet(folder), "tank", "timestamp", "id", "5 minutes")
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", point).trigger(availableNow=True).start().awaitTermination()
    batch = AnomalyDetector(("timestamp", "id"), ("tank",)).union(rows, ["over_vigorous_co2", "rapid_pressure_rise"])
    newest = rows.agg(F.max("timestamp")).first()[0] - pd.Timedelta(minutes=7)
    expected = {(r["id"], r["anomaly_type"]) for r in batch.collect() if r["timestamp"] < newest}
    mine = [(r["id"], r["anomaly_type"]) for r in spark.read.parquet(out).collect()]
    assert expected <= set(mine) and len(mine) == len(set(mine)) and min(i for i, _ in mine) < 200 < max(i for i, _ in mine)


def test_state_is_given_up(spark, tmp_path):
    """A key that was silent for longer than asked for begins anew."""
    folder = str(tmp_path / "silent")
    schema = "id long, tank string, timestamp timestamp, co2_lpm double, pressure_bar double"
    start = pd.Timestamp("2024-03-01")
    for k, (tank, hours) in enumerate([("a", 0), ("b", 60), ("b", 62), ("a", 70), ("b", 200)]):
        row = (k, tank, (start + pd.Timedelta(hours=hours)).to_pydatetime(), 9_000.0 * k, 1.0)
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    for days, ids in ((1, {2}), (30, {2, 3})):
        found = finished(alerts(stream, "tank", "timestamp", "id", types=["over_vigorous_co2"], forget_days=days), f"silent{days}", tmp_path)
        assert {r["id"] for r in found.collect()} - {4} == ids


@pytest.mark.parametrize("method", ["mean", "interpolate"])
def test_grid_equals_the_batch(spark, rows, tmp_path, method):
    gappy = rows.filter("NOT (id BETWEEN 120 AND 160)").withColumn("co2_lpm", F.when(F.col("id") % 4 > 0, F.col("co2_lpm")))
    stream, _ = shuffled(spark, tmp_path, gappy)
    grid = resampled_grid(stream, "timestamp", ["co2_lpm", "do_ppm"], ["tank"], 5, method, "60 minutes")
    found = finished(grid, f"grid_{method}", tmp_path).filter("tank <> 'closing'").collect()
    expected = {(r["tank"], r["timestamp"]): r for r in resample(gappy, "timestamp", 5, method, ["tank"], ["co2_lpm", "do_ppm"]).collect()}
    mine = {(r["tank"], r["timestamp"]): r for r in found}
    assert len(mine) == len(found) and set(mine) <= set(expected)
    # Only buckets behind the last reading of a column may still wait.
    last = {t: min(max(r["timestamp"] for r in expected.values() if r["tank"] == t) for _ in "x") for t in {k[0] for k in expected}}
    waiting = [k for k in expected if k not in mine]
    assert len(waiting) <= (0 if method == "mean" else 60) and last
    for key, row in mine.items():
        for c in ("co2_lpm", "do_ppm"):
            want = expected[key][c]
            assert row[c] == pytest.approx(want) if row[c] is not None else want is None, (key, c, want)
    assert any(r["co2_lpm"] is None for r in found) or method == "interpolate"


def test_interpolation_gives_up(spark, tmp_path):
    """A column without readings holds its buckets back for ``patience`` buckets only."""
    folder = str(tmp_path / "readings")
    schema = "tank string, timestamp timestamp, x double, y double"
    start = pd.Timestamp("2024-03-01")
    made = [("a", (start + pd.Timedelta(minutes=5 * k)).to_pydatetime(), float(k), 1.0 if k in (1, 3) else None) for k in range(30)]
    spark.createDataFrame(made, schema).coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema(schema).parquet(folder)
    found = finished(resampled_grid(stream, "timestamp", ["x", "y"], ["tank"], 5, "interpolate", "0 minutes", patience=6), "patient", tmp_path)
    got = sorted((r["timestamp"], r["x"], r["y"]) for r in found.collect())
    assert [g[1] for g in got] == [float(k) for k in range(len(got))] and 20 < len(got) < 30
    assert [g[2] for g in got[:6]] == [None, 1.0, 1.0, 1.0, None, None]


def test_settings_are_checked(spark, rows, tmp_path):
    with pytest.raises(ValueError, match="divide a day"):
        resampled_grid(rows, "timestamp", ["co2_lpm"], ["tank"], 7)
    name = "spark.sql.streaming.stateStore.providerClass"
    usual = spark.conf.get(name)
    spark.conf.unset(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        with pytest.raises(ValueError, match="providerClass"):
            alerts(rows, "tank", "timestamp", "id")
    finally:
        spark.conf.set(name, usual)


class Counting:
    """State of one key that counts the calls to it."""

    def __init__(self):
        self.calls, self.timers, self.held = 0, set(), {}

    def __getattr__(self, name):
        if not name.startswith("get"):
            raise AttributeError(name)
        return lambda state, *_: CountingState(self, state, "List" in name, "Map" in name)

    def _counted(self, timer, do):
        self.calls += 1
        do(timer)

    def registerTimer(self, timer):
        self._counted(timer, self.timers.add)

    def deleteTimer(self, timer):
        self._counted(timer, self.timers.discard)

    def listTimers(self):
        self.calls += 1
        return iter(sorted(self.timers))


class CountingState:
    def __init__(self, handle, name, listed, mapped):
        self.handle, self.name, self.listed, self.mapped = handle, name, listed, mapped

    def __getattr__(self, name):
        held, at = self.handle.held, self.name
        empty = [] if self.listed else {} if self.mapped else None

        def call(*args):
            self.handle.calls += 1
            now = held.get(at, empty)
            if name == "get":
                return iter(list(now)) if self.listed else now
            if name == "exists":
                return at in held
            if name == "clear":
                held.pop(at, None)
            elif name == "appendValue":
                held[at] = [*now, args[0]]
            elif name == "appendList":
                held[at] = [*now, *args[0]]
            elif name == "containsKey":
                return args[0] in now
            elif name == "getValue":
                return now[args[0]]
            elif name == "updateValue":
                held[at] = now | {args[0]: args[1]}
            elif name == "removeKey":
                held[at] = {k: v for k, v in now.items() if k != args[0]}
            else:
                held[at] = args[0]  # update, put

        return call


class Passed:
    def __init__(self, watermark, timer=0):
        self.watermark, self.timer = watermark, timer

    def getCurrentWatermarkInMs(self):
        return self.watermark

    def getExpiryTimeInMs(self):
        return self.timer


def driven(processor, batches):
    """Rows that come out of one key, and calls of its state, for batches of rows with the watermark behind."""
    handle, out = Counting(), []
    processor.init(handle)
    for rows, watermark in batches:
        out += processor.handleInputRows(("a",), iter(rows), Passed(0))
        for timer in sorted(t for t in handle.timers if t <= watermark):
            out += processor.handleExpiredTimer(("a",), Passed(watermark), Passed(watermark, timer))
            handle.timers.discard(timer)
    return out, handle.calls


def test_calls_of_the_state_do_not_grow_with_the_rows():
    """A key with a row a minute reads and writes its state once per batch, not once per row and minute."""
    made = [{"_micros": k * 60_000_000, "id": k, "_co2": 9_000.0 * (k % 2), "_oxygen": 1.0, "_pressure": 1.0} for k in range(2_400)]
    detection = _Detection("tank", "id", Thresholds(), ("over_vigorous_co2",), 7 * 86_400_000, "bigint")
    found, calls = driven(detection, [(made[:1_500], 1_000 * 60_000), (made[1_500:][::-1], 2_400 * 60_000)])
    assert sorted(r["id"] for r in found) == list(range(1, 2_400, 2)) and calls < 50
    hours = [{"_bucket": k // 6 * 600_000 + 86_400_000 * (k // 1_200), "_v0": float(k % 6)} for k in range(2_400)]
    grid, calls = driven(_Grid(600_000, ["tank"], ["x"], None), [(hours[:1_500], 10**7), (hours[1_500:], 10**10)])
    assert [r["x"] for r in grid] == [2.5] * 400 and calls < 50
    grid, calls = driven(_Grid(600_000, ["tank"], ["x"], 288), [(hours[:1_500], 10**7), (hours[1_500:], 10**10)])
    # The two runs of 200 buckets are 144 buckets apart and filled on the line between.
    assert [r["x"] for r in grid] == [2.5] * (400 + 144) and calls < 50


def test_silence_counts_from_the_last_batch():
    """Rows of one watermark are compared with each other; a row behind a silent week begins anew."""
    day = 86_400_000_000
    row = lambda k, at: {"_micros": at, "id": k, "_co2": 9_000.0 * k, "_oxygen": None, "_pressure": None}
    for days, ids in ((1, [1]), (30, [1, 2])):
        detection = _Detection("tank", "id", Thresholds(), ("over_vigorous_co2",), days * 86_400_000, "bigint")
        found, _ = driven(detection, [([row(0, 0), row(1, 10 * day)], 11 * 86_400_000), ([row(2, 15 * day)], 20 * 86_400_000)])
        assert [r["id"] for r in found] == ids
