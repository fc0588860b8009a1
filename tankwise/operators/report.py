"""Batch reports: summary, metrics, anomaly breakdown and recommendations, one row per batch."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tankwise.functions.times import hours_between
from tankwise.operators.batch import batch_metrics
from tankwise.plans.params import settle

# Recommendation texts in their order, and the limits behind them.
STUCK_TEXT = "Stuck fermentation detected. Consider checking yeast viability and temperature."
PRESSURE_TEXT = "Pressure anomalies detected. Monitor tank pressure closely and check safety valves."
OXIDATION_TEXT = "Oxidation risk detected. Check tank seals and DO levels."
LOW_PEAK_TEXT = "Low peak CO2 detected. Consider reviewing fermentation parameters."
LONG_TEXT = "Extended fermentation duration. Review process efficiency."
NORMAL_TEXT = "Batch appears normal. Continue monitoring."
LOW_PEAK_BELOW = 1000
LONG_ABOVE_HOURS = 200


def batch_summary(df: DataFrame, time: str, batch: str = "batch_id") -> DataFrame:
    """Samples, first and last time, and duration per batch."""
    return df.groupBy(batch).agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.min(time).alias("start_time"),
        F.max(time).alias("end_time"),
        hours_between(F.min(time), F.max(time)).alias("duration_hours"),
    )


def anomaly_breakdown(anomalies: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Anomalies per batch, type and severity in long form."""
    return anomalies.groupBy(batch, "anomaly_type", "severity").agg(F.count(F.lit(1)).alias("anomalies"))


def anomaly_section(anomalies: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Total, and maps of type and severity to their counts. The maps are built from counts, whose
    number is bounded by the number of types."""
    counted = anomaly_breakdown(anomalies, batch)

    def as_map(column: str) -> DataFrame:
        parts = counted.groupBy(batch, column).agg(F.sum("anomalies").alias("_n"))
        entries = F.array_sort(F.collect_list(F.struct(column, "_n")))
        return parts.groupBy(batch).agg(F.map_from_entries(entries).alias("_map"), F.sum("_n").alias("_count"))

    types = as_map("anomaly_type").withColumnsRenamed({"_map": "types", "_count": "count"})
    severities = as_map("severity").withColumnRenamed("_map", "severity_breakdown").drop("_count")
    return types.join(severities, batch).select(batch, "count", "types", "severity_breakdown")


def recommendations(
    metrics: DataFrame, anomalies: DataFrame, batch: str = "batch_id"
) -> DataFrame:
    """Ordered recommendations per batch, from its metrics and the types of its anomalies."""
    kind = F.col("anomaly_type")
    seen = anomalies.groupBy(batch).agg(
        F.bool_or(kind == "stuck_fermentation").alias("_stuck"),
        F.bool_or(F.lower(kind).contains("pressure")).alias("_pressure"),
        F.bool_or(kind == "oxidation_risk").alias("_oxidation"),
    )
    peak, hours = F.col("peak_co2_ppm"), F.col("duration_hours")
    texts = F.array_compact(
        F.array(
            F.when(F.col("_stuck"), STUCK_TEXT),
            F.when(F.col("_pressure"), PRESSURE_TEXT),
            F.when(F.col("_oxidation"), OXIDATION_TEXT),
            F.when((peak != 0) & (peak < LOW_PEAK_BELOW), LOW_PEAK_TEXT),
            F.when(hours > LONG_ABOVE_HOURS, LONG_TEXT),
        )
    )
    texts = F.when(F.size(texts) == 0, F.array(F.lit(NORMAL_TEXT))).otherwise(texts)
    return metrics.join(seen, batch, "left").select(batch, texts.alias("recommendations"))


def batch_reports(
    df: DataFrame,
    anomalies: DataFrame,
    order: Iterable[str],
    batch: str = "batch_id",
    co2: str = "co2_ppm",
    do: str = "o2_pct",
    pressure: str = "pressure_kpa",
    forecasts: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Nested report per batch. ``limit`` keeps the first batches by name, for a preview."""
    order = list(order)
    metrics, _ = settle(batch_metrics(df, order, batch, co2, do, pressure))
    sections = anomaly_section(anomalies, batch)
    nothing = F.create_map().cast("map<string,bigint>")
    report = (
        batch_summary(df, order[0], batch)
        .select(batch, F.struct("total_samples", "start_time", "end_time", "duration_hours").alias("summary"))
        .join(
            metrics.select(batch, F.struct(*(c for c in metrics.columns if c != batch)).alias("metrics")), batch, "left"
        )
        .join(
            sections.select(batch, F.struct("count", "types", "severity_breakdown").alias("_found")), batch, "left"
        )
        .join(recommendations(metrics, anomalies, batch), batch, "left")
    )
    if forecasts is not None:
        forecast = F.struct(*(c for c in forecasts.columns if c != batch)).alias("phase_forecast")
        report = report.join(forecasts.select(batch, forecast), batch, "left")
    report = report.select(
        batch,
        F.current_timestamp().alias("generated_at"),
        "summary",
        "metrics",
        F.struct(
            F.coalesce(F.col("_found.count"), F.lit(0)).alias("count"),
            F.coalesce(F.col("_found.types"), nothing).alias("types"),
            F.coalesce(F.col("_found.severity_breakdown"), nothing).alias("severity_breakdown"),
        ).alias("anomalies"),
        "recommendations",
        *(["phase_forecast"] if forecasts is not None else []),
    )
    return report.orderBy(batch).limit(limit) if limit else report
