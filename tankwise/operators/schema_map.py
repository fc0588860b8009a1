"""Mapping between the legacy and the canonical telemetry layout."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tankwise.plans.params import attach, settle

# Legacy column -> canonical column.
LEGACY_TO_CANONICAL = {
    "timestamp_index": "timestamp",
    "co2_ppm": "co2_lpm",
    "o2_pct": "do_ppm",
    "process_temp_c": "temp_c",
    "pressure_kpa": "pressure_bar",
}

# Units and the defaults of absent columns.
KPA_PER_BAR = 100.0
OPEN_VALVE_ABOVE_BAR = 1.0
DEFAULT_RPM = 1000.0
RPM_PER_DEGREE = 20.0
MAX_SYNTHETIC_RPM = 2000.0
BASE_GRAVITY = 1.040
CO2_PER_GRAVITY = 10_000
DEFAULT_GRAVITY = 1.050
DEFAULT_ATTENUATION = 75.0


def to_canonical(
    df: DataFrame,
    order: Iterable[str] = ("timestamp_index",),
    rpm_from_temperature: bool = False,
    pitch_per_batch: bool = False,
) -> DataFrame:
    """Rename legacy columns, convert pressure to bar and add the columns that are absent.

    ``order`` (in input names) tells which row comes first, for the original gravity."""
    order = [LEGACY_TO_CANONICAL.get(name, name) for name in order]
    present = {old: new for old, new in LEGACY_TO_CANONICAL.items() if old in df.columns}
    df = df.withColumnsRenamed(present)
    if "pressure_bar" in present.values():
        df = df.withColumn("pressure_bar", F.col("pressure_bar") / KPA_PER_BAR)
    have = set(df.columns)

    added: dict[str, Column] = {}
    if "valve_state" not in have:
        is_open = (F.col("pressure_bar") > OPEN_VALVE_ABOVE_BAR) if "pressure_bar" in have else F.lit(True)
        added["valve_state"] = F.when(is_open, 1).otherwise(0)
    if "agitator_rpm" not in have:
        if rpm_from_temperature and "temp_c" in have:
            rpm = F.least(F.greatest(F.col("temp_c") * RPM_PER_DEGREE, F.lit(0.0)), F.lit(MAX_SYNTHETIC_RPM))
            added["agitator_rpm"] = F.when(F.col("temp_c").isNotNull(), rpm)
        else:
            added["agitator_rpm"] = F.lit(DEFAULT_RPM)
    if "target_attenuation" not in have:
        added["target_attenuation"] = F.lit(DEFAULT_ATTENUATION)
    source = df
    if "OG" not in have:
        if "co2_lpm" in have:
            added["OG"] = F.lit(BASE_GRAVITY) + first_value(source, "co2_lpm", order) / CO2_PER_GRAVITY
        else:
            added["OG"] = F.lit(DEFAULT_GRAVITY)
    if "pitch_time" not in have and not (pitch_per_batch and "batch_id" in have):
        if "timestamp" in have:
            added["pitch_time"] = source.agg(F.min("timestamp")).scalar()
        else:
            added["pitch_time"] = F.current_timestamp()
    df = df.withColumns(added)
    if "pitch_time" not in df.columns:
        starts, small = settle(source.groupBy("batch_id").agg(F.min("timestamp").alias("pitch_time")))
        df = attach(df, starts, ["batch_id"], small)
    return df


def first_value(df: DataFrame, column: str, order: Iterable[str]) -> Column:
    """Value of ``column`` in the first row of ``order``, as a one-row subquery."""
    order = [name for name in order if name in df.columns]
    if not order:
        raise ValueError("an order column is needed to tell the first row")
    return df.agg(F.min_by(F.col(column), F.struct(*order))).scalar()


def to_legacy(df: DataFrame) -> DataFrame:
    """Rename canonical columns back and convert pressure to kPa."""
    if "pressure_bar" in df.columns:
        df = df.withColumn("pressure_bar", F.col("pressure_bar") * KPA_PER_BAR)
    back = {new: old for old, new in LEGACY_TO_CANONICAL.items() if new in df.columns}
    return df.withColumnsRenamed(back)


def coalesce_aliases(df: DataFrame) -> DataFrame:
    """Fill each canonical column, row by row, from its legacy column, which is then dropped."""
    filled: dict[str, Column] = {}
    for old, new in LEGACY_TO_CANONICAL.items():
        if old not in df.columns:
            continue
        legacy = F.col(old) / KPA_PER_BAR if new == "pressure_bar" else F.col(old)
        filled[new] = F.coalesce(F.col(new), legacy) if new in df.columns else legacy
    return df.withColumns(filled).drop(*(old for old in LEGACY_TO_CANONICAL if old in df.columns))


def with_identity(df: DataFrame, time: str = "timestamp") -> DataFrame:
    """Add ``batch_id`` (the calendar day), ``tank_id``, ``strain`` and ``style`` where absent."""
    if "batch_id" not in df.columns and time in df.columns:
        df = df.withColumn("batch_id", F.date_format(time, "yyyy-MM-dd"))
    fallback = F.col("batch_id") if "batch_id" in df.columns else F.lit("tank_1")
    defaults = {"tank_id": fallback, "strain": F.lit("default_strain"), "style": F.lit("default_style")}
    return df.withColumns({name: value for name, value in defaults.items() if name not in df.columns})
