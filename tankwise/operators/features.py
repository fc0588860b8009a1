"""Model features: powers, products, lags, rolling moments, calendar, equipment, attenuation."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tankwise.functions.moments import STATISTICS, rolling_stages, statistic
from tankwise.functions.phases import phase_code
from tankwise.operators.schema_map import first_value
from tankwise.plans.ordered import Ordered, arrange

EPSILON = 1e-10  # fixed value: added to denominators
SAMPLE_MINUTES = 5  # fixed value: lags in minutes become rows of this length
LAG_MINUTES = (5, 15, 60)
WINDOWS = (6, 12, 24)


def polynomial(df: DataFrame, columns: Iterable[str], degree: int = 2) -> DataFrame:
    return df.withColumns(_powers([c for c in columns if c in df.columns], degree))


def _powers(columns: list[str], degree: int) -> dict[str, Column]:
    return {f"{c}_poly_{d}": F.pow(c, F.lit(float(d))) for c in columns for d in range(2, degree + 1)}


def interactions(df: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    return df.withColumns(_products([p for p in pairs if set(p) <= set(df.columns)]))


def _products(pairs: list[tuple[str, str]]) -> dict[str, Column]:
    return {f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in pairs}


def _lag_steps(minutes: Iterable[int]) -> list[int]:
    return [m // SAMPLE_MINUTES for m in minutes if m // SAMPLE_MINUTES > 0]


def _lags(columns: list[str], steps: list[int], w: WindowSpec) -> dict[str, Column]:
    return {f"{c}_lag_{s}": F.lag(c, s).over(w) for c in columns for s in steps}


def _rolling(columns: list[str], windows: Iterable[int]) -> dict[str, Column]:
    return {
        f"{c}_rolling_{name}_{size}": statistic(c, size, name)
        for c in columns
        for size in windows
        for name in STATISTICS
    }


def _arranged(df: DataFrame | Ordered, order: Iterable[str], keys: Iterable[str]) -> Ordered:
    return df if isinstance(df, Ordered) else arrange(df, order, keys)


def lags(
    df: DataFrame | Ordered,
    order: Iterable[str],
    columns: Iterable[str],
    keys: Iterable[str] = (),
    minutes: Iterable[int] = LAG_MINUTES,
) -> DataFrame:
    """Earlier values; the name carries the number of rows."""
    arranged, steps = _arranged(df, order, keys), _lag_steps(minutes)
    present = [c for c in columns if c in arranged.rows.columns]
    return arranged.framed(lambda w: _lags(present, steps, w), back=max(steps, default=0)).result()


def rolling(
    df: DataFrame | Ordered,
    order: Iterable[str],
    columns: Iterable[str],
    keys: Iterable[str] = (),
    windows: Iterable[int] = WINDOWS,
) -> DataFrame:
    """Mean, deviation, skewness and kurtosis over trailing frames of several lengths."""
    arranged, windows = _arranged(df, order, keys), list(windows)
    present = [c for c in columns if c in arranged.rows.columns]

    def staged(w: WindowSpec) -> list[Mapping[str, Column]]:
        return [*rolling_stages(present, windows, w), _rolling(present, windows)]

    return arranged.framed(staged, back=max(windows) - 1).result()


def encoded_phase(df: DataFrame) -> DataFrame:
    return df.withColumn("phase_encoded", phase_code(F.col("phase"), -1)) if "phase" in df.columns else df


def temporal(df: DataFrame, time: str = "timestamp_index") -> DataFrame:
    """Calendar parts (weeks start on Monday = 0) and their position on a circle."""
    return df.withColumns(_calendar(time)) if time in df.columns else df


def _calendar(time: str) -> dict[str, Column]:
    hour, weekday = F.hour(time), F.weekday(time)
    turn = 2 * math.pi
    return {
        "hour": hour,
        "day_of_week": weekday,
        "day_of_month": F.dayofmonth(time),
        "month": F.month(time),
        "hour_sin": F.sin(turn * hour / 24),
        "hour_cos": F.cos(turn * hour / 24),
        "day_sin": F.sin(turn * weekday / 7),
        "day_cos": F.cos(turn * weekday / 7),
    }


def _equipment(df: DataFrame) -> dict[str, Column]:
    """Features of one row; the changes need the previous row and are window columns."""
    added = {}
    if "valve_state" in df.columns:
        added["valve_state_binary"] = F.when(F.col("valve_state") > 0, 1).otherwise(0)
    if "agitator_rpm" in df.columns:
        highest = df.agg(F.max("agitator_rpm")).scalar()
        added["agitator_rpm_normalized"] = F.col("agitator_rpm") / (highest + EPSILON)
    return added


def _changes(columns: Iterable[str], w: WindowSpec) -> dict[str, Column]:
    return {f"{c}_change": F.col(c) - F.lag(c).over(w) for c in columns}


def equipment(df: DataFrame, order: Iterable[str], keys: Iterable[str] = ()) -> DataFrame:
    """Valve and agitator features."""
    present = [c for c in ("valve_state", "agitator_rpm") if c in df.columns]
    own = _equipment(df)
    return arrange(df, order, keys).framed(lambda w: _changes(present, w), back=1).result().withColumns(own)


def _attenuation(df: DataFrame, co2: str, order: list[str]) -> dict[str, Column]:
    if "OG" not in df.columns or co2 not in df.columns:
        return {}
    first = first_value(df, co2, order)
    estimate = (F.col(co2) - first) / (first + EPSILON) * 100
    added = {"estimated_attenuation": estimate}
    if "target_attenuation" in df.columns:
        added["attenuation_deviation"] = estimate - F.col("target_attenuation")
    return added


def attenuation(df: DataFrame, order: Iterable[str], co2: str = "co2_lpm") -> DataFrame:
    """Estimated attenuation relative to the first row, and its deviation from the target."""
    return df.withColumns(_attenuation(df, co2, list(order)))


def all_features(
    df: DataFrame,
    order: Iterable[str],
    keys: Iterable[str] = (),
    co2: str = "co2_lpm",
    temperature: str = "temp_c",
    pressure: str = "pressure_bar",
    do: str = "do_ppm",
    time: str | None = None,
) -> DataFrame:
    """Every feature the columns allow: one window stage for all lags and frames, one projection."""
    order, keys = list(order), list(keys)
    have = set(df.columns)

    def present(*names: str) -> list[str]:
        return [n for n in names if n in have]

    changing = present("valve_state", "agitator_rpm")
    lagged = present(co2, do, temperature, "valve_state", "agitator_rpm")
    rolled = present(co2, do, "valve_state", "agitator_rpm")
    steps = _lag_steps(LAG_MINUTES)

    def windowed(w: WindowSpec) -> list[Mapping[str, Column]]:
        window_columns = _changes(changing, w) | _lags(lagged, steps, w)
        return [window_columns, *rolling_stages(rolled, WINDOWS, w), _rolling(rolled, WINDOWS)]

    pairs = [(co2, temperature), (co2, pressure), ("valve_state", co2), ("agitator_rpm", co2)]
    own = _calendar(time) if time in have else {}
    own |= _equipment(df) | _attenuation(df, co2, order)
    own |= _powers(present(co2, temperature), 2)
    own |= _products([p for p in pairs if set(p) <= have])
    if "phase" in have:
        own["phase_encoded"] = phase_code(F.col("phase"), -1)
    reach = max([*steps, *(size - 1 for size in WINDOWS)])
    return arrange(df, order, keys).framed(windowed, back=reach).result().withColumns(own)
