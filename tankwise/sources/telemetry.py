"""Telemetry view over the ``events`` table, in the legacy column layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tankwise.sources.readers import table

ORDER = ("timestamp_index", "event_id")


def telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """Sensor rows derived from events."""
    return telemetry_of(table(spark, folder, "events"))


def telemetry_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows as a stream over the table's files."""
    folder = folder.rstrip("/")
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    # A stream reads folders or patterns; the pattern fits a table that is one file too.
    rows = spark.readStream.schema(schema).parquet(f"{folder}/event[s].parquet")
    return telemetry_of(rows.withColumn("ts", F.col("ts").cast("timestamp")))


def telemetry_of(events: DataFrame) -> DataFrame:
    """Sensor rows of events, a table's or a stream's; gaps in ``co2_ppm`` follow a rule on the number."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("double")
    number = F.col("event_id")
    gap = ((number % 17 == 0) & (number != 0)) | (number % 200).between(40, 45)
    return events.select(
        "event_id",
        F.col("ts").alias("timestamp_index"),
        F.col("user_id").cast("string").alias("tank_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("batch_id"),
        F.when(~gap, F.col("value") * 10).alias("co2_ppm"),
        (k * 0.21).alias("o2_pct"),
        (F.lit(70.0) + k * 1.5).alias("pressure_kpa"),
        (F.lit(10.0) + (number % 300) / 10.0).alias("process_temp_c"),
        F.col("event_type").alias("strain"),
        F.when(F.col("user_id") % 2 == 0, "ipa").otherwise("pilsner").alias("style"),
    )
