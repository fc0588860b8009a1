"""Registry of named queries and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tankwise.plans.ordered import ROWS_PER_SLICE_CONF
from tankwise.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, digits: int = 6):
    """Register a query. Doubles are rounded and times become microseconds, in both engines, so
    that results compare exactly."""

    def keep(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(build(prepare(spark), folder), digits)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return keep


def comparable(df: DataFrame, digits: int) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        text = f"`{field.name}`"
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            text = f"round({text}, {digits}) + 0D AS {text}"
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            text = f"unix_micros(CAST({text} AS TIMESTAMP)) AS {text}"
        columns.append(text)
    return df.selectExpr(*columns)


def rounded(expression: str, alias: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0 AS {alias}"


def all_rounded(columns: Iterable[str], digits: int = 6) -> str:
    return ", ".join(rounded(c, c, digits) for c in columns)


TELEMETRY = """t AS (
  SELECT event_id, ts AS timestamp_index, CAST(user_id AS VARCHAR) AS tank_id,
         strftime(ts, '%Y-%m-%d') AS batch_id,
         CASE WHEN (event_id % 17 = 0 AND event_id <> 0) OR event_id % 200 BETWEEN 40 AND 45 THEN NULL ELSE value * 10 END AS co2_ppm,
         k * CAST(0.21 AS DOUBLE) AS o2_pct,
         CAST(70 AS DOUBLE) + k * CAST(1.5 AS DOUBLE) AS pressure_kpa,
         CAST(10 AS DOUBLE) + CAST(event_id % 300 AS DOUBLE) / 10 AS process_temp_c,
         event_type AS strain,
         CASE WHEN user_id % 2 = 0 THEN 'ipa' ELSE 'pilsner' END AS style
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k FROM events))"""

CANONICAL = (
    TELEMETRY
    + """, c AS (
  SELECT event_id, timestamp_index AS timestamp, tank_id, batch_id, strain, style,
         co2_ppm AS co2_lpm, o2_pct AS do_ppm, process_temp_c AS temp_c,
         pressure_kpa / CAST(100 AS DOUBLE) AS pressure_bar,
         CASE WHEN pressure_kpa / CAST(100 AS DOUBLE) > 1 THEN 1 ELSE 0 END AS valve_state,
         least(greatest(process_temp_c * 20, 0), 2000) AS agitator_rpm,
         CAST(75 AS DOUBLE) AS target_attenuation,
         CAST(1.04 AS DOUBLE) + (SELECT co2_ppm FROM t ORDER BY timestamp_index, event_id LIMIT 1) / 10000 AS "OG",
         (SELECT min(timestamp_index) FROM t) AS pitch_time
  FROM t)"""
)


def register_sliced(name: str, rows: int) -> None:
    """The same query under ``<name>_sliced``, with slices of ``rows`` rows, so that tables that one task
    could order take the way of large ones."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        usual = spark.conf.get(ROWS_PER_SLICE_CONF, None)
        spark.conf.set(ROWS_PER_SLICE_CONF, str(rows))
        try:
            return QUERIES[name](spark, folder)
        finally:
            if usual is None:
                spark.conf.unset(ROWS_PER_SLICE_CONF)
            else:
                spark.conf.set(ROWS_PER_SLICE_CONF, usual)

    QUERIES[f"{name}_sliced"] = run
    if name in ORACLES:
        ORACLES[f"{name}_sliced"] = ORACLES[name]
