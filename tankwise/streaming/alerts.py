"""Alerts and resampling on telemetry streams."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tankwise.operators.anomaly import pressure_anomalies
from tankwise.streaming.stateful import alerts

RATE_TYPES = ("over_vigorous_co2", "rapid_pressure_rise")


def pressure_alerts(stream: DataFrame, pressure: str = "pressure_bar") -> DataFrame:
    """High and low pressure, row by row, without state."""
    return pressure_anomalies(stream, pressure)


def resampled(
    stream: DataFrame,
    time: str,
    columns: Iterable[str],
    by: Iterable[str] = (),
    minutes: int = 5,
    lateness: str = "10 minutes",
) -> DataFrame:
    """Mean per bucket, emitted once the watermark has passed it. Empty buckets are not emitted."""
    by = list(by)
    window = F.window(time, f"{minutes} minutes")
    return (
        stream.withWatermark(time, lateness)
        .groupBy(window, *by)
        .agg(*(F.avg(c).alias(c) for c in columns))
        .select(*by, F.col("window.start").alias(time), *columns)
    )


def rate_alerts(
    stream: DataFrame,
    key: str,
    time: str,
    tiebreak: str,
    lateness: str = "10 minutes",
    co2: str = "co2_lpm",
    pressure: str = "pressure_bar",
) -> DataFrame:
    """Over-vigorous CO2 and rapid pressure rise, from the previous row of the same key; rows may arrive in
    any order but at most ``lateness`` behind the newest (see :func:`alerts`)."""
    found = alerts(stream, key, time, tiebreak, None, RATE_TYPES, lateness, co2=co2, pressure=pressure)
    return found.select(
        key, time, tiebreak, "co2_rate_per_min", "pressure_rate_per_min", "anomaly_type", "severity"
    )
