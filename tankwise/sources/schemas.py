"""Column catalogues of telemetry and batch metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TELEMETRY = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("tank_id", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("strain", T.StringType()),
        T.StructField("style", T.StringType()),
        T.StructField("co2_lpm", T.DoubleType()),
        T.StructField("do_ppm", T.DoubleType()),
        T.StructField("temp_c", T.DoubleType()),
        T.StructField("pressure_bar", T.DoubleType()),
        T.StructField("valve_state", T.IntegerType()),
        T.StructField("agitator_rpm", T.DoubleType()),
    ]
)

BATCH_METADATA = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("pitch_time", T.TimestampType()),
        T.StructField("OG", T.DoubleType()),
        T.StructField("target_attenuation", T.DoubleType()),
    ]
)

LEGACY_TELEMETRY = T.StructType(
    [
        T.StructField("timestamp_index", T.TimestampType()),
        T.StructField("co2_ppm", T.DoubleType()),
        T.StructField("o2_pct", T.DoubleType()),
        T.StructField("pressure_kpa", T.DoubleType()),
        T.StructField("process_temp_c", T.DoubleType()),
        T.StructField("ambient_temp_c", T.DoubleType()),
    ]
)

# A record of a request may use either naming; every field but the time may be missing.
RECORD = T.StructType(
    [
        *TELEMETRY.fields,
        *LEGACY_TELEMETRY.fields,
        *(field for field in BATCH_METADATA.fields if field.name != "batch_id"),
    ]
)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Names of the numeric columns, in schema order."""
    return [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, T.NumericType) and field.name not in exclude
    ]
