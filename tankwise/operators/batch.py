"""Batch metrics, rolling statistics, comparisons and attenuation slopes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tankwise.functions.moments import rolling_stages, statistic
from tankwise.functions.times import hours_between, minutes_between
from tankwise.plans.ordered import POSITION, Ordered, arrange
from tankwise.plans.params import attach, settle

EPSILON = 1e-10  # fixed value: added to denominators
DEFAULT_SENSORS = ("co2_ppm", "o2_pct", "process_temp_c", "pressure_kpa")


def with_batches(df: DataFrame, batch: str, time: str) -> DataFrame:
    """Rows without a batch column belong to the batch of their calendar day."""
    return df if batch in df.columns else df.withColumn(batch, F.date_format(time, "yyyy-MM-dd"))


def batch_metrics(
    df: DataFrame,
    order: Iterable[str] = ("timestamp_index",),
    batch: str = "batch_id",
    co2: str = "co2_ppm",
    do: str = "o2_pct",
    pressure: str = "pressure_kpa",
) -> DataFrame:
    """Peak and its time, oxygen half-life, pressure growth, duration and size of every batch.

    Column-pruned passes of partial hash aggregation; rows are never shuffled or sorted. The first pass finds
    peak and ends per batch, the second the values in the rows at the ends, the third the earliest times that
    depend on both. Rows without a time count as samples only. Metrics of absent sensors are NULL."""
    order = list(order)
    time = order[0]
    df = with_batches(df, batch, time)
    absent = {c: F.lit(None).cast("double") for c in (co2, do, pressure) if c not in df.columns}
    slim = df.withColumns(absent).select(*dict.fromkeys([batch, *order, co2, do, pressure]))
    ends, small = settle(
        slim.groupBy(batch).agg(
            F.max(co2).alias("_peak"),
            F.min(time).alias("_start"),
            F.max(time).alias("_end"),
            F.count(F.lit(1)).alias("num_samples"),
        )
    )
    edges = _edge_values(attach(slim, ends, [batch], small, how="inner"), order, batch, do, pressure)
    firsts, small = settle(attach(edges, ends, [batch], small, how="inner"))
    known = attach(slim.select(batch, time, co2, do), firsts, [batch], small, how="inner")
    carried = ("_peak", "_start", "_end", "_first_pressure", "_last_pressure", "num_samples")
    metrics = known.groupBy(batch).agg(
        F.min(F.when(F.col(co2) == F.col("_peak"), F.col(time))).alias("_peak_at"),
        F.min(F.when((F.col("_first_do") > 0) & (F.col(do) <= F.col("_first_do") / 2), F.col(time))).alias("_half_at"),
        *(F.max(c).alias(c) for c in carried),
    )
    return metrics.select(
        batch,
        F.col("_peak").alias("peak_co2_ppm"),
        minutes_between(F.col("_start"), F.col("_peak_at")).alias("time_to_peak_minutes"),
        minutes_between(F.col("_start"), F.col("_half_at")).alias("do_half_life_minutes"),
        (F.col("_last_pressure") - F.col("_first_pressure")).alias("pressure_growth_kpa"),
        hours_between(F.col("_start"), F.col("_end")).alias("duration_hours"),
        "num_samples",
    )


def _edge_values(known: DataFrame, order: list[str], batch: str, do: str, pressure: str) -> DataFrame:
    """Oxygen and pressure in the first row of every batch, and pressure in the last one.

    Among the rows of the first and last instant a single number decides by itself; several columns, or
    others than numbers, are put into one number by a row number over these few rows."""
    time, ties = order[0], order[1:]
    rows = known.filter((F.col(time) == F.col("_start")) | (F.col(time) == F.col("_end")))
    if not ties:
        tie = F.lit(0)
    elif len(ties) == 1 and isinstance(known.schema[ties[0]].dataType, T.NumericType):
        tie = F.col(ties[0])
    else:
        rows = rows.withColumn("_tie", F.row_number().over(Window.partitionBy(batch, time).orderBy(*ties)))
        tie = F.col("_tie")
    rows = rows.withColumn("_tie", tie)
    first, last = F.col(time) == F.col("_start"), F.col(time) == F.col("_end")

    def at(edge, pick, value: str):
        return pick(F.when(edge, F.col(value)), F.when(edge, F.col("_tie")))

    return rows.groupBy(batch).agg(
        at(first, F.min_by, do).alias("_first_do"),
        at(first, F.min_by, pressure).alias("_first_pressure"),
        at(last, F.max_by, pressure).alias("_last_pressure"),
    )


def rolling_statistics(
    df: DataFrame | Ordered,
    order: Iterable[str],
    keys: Iterable[str] = (),
    columns: Iterable[str] = DEFAULT_SENSORS,
    window: int = 12,
) -> DataFrame:
    """Mean, deviation, excess kurtosis and coefficient of variation over the last ``window`` rows."""
    arranged = df if isinstance(df, Ordered) else arrange(df, order, keys)
    present = [c for c in columns if c in arranged.rows.columns]

    def statistics(w):
        results = {
            f"{c}_rolling_{label}": statistic(c, window, name)
            for c in present
            for name, label in (("mean", "mean"), ("std", "std"), ("kurt", "kurtosis"))
        }
        return [*rolling_stages(present, [window], w), results]

    rolled = arranged.framed(statistics, back=window - 1).result()
    return rolled.withColumns(
        {f"{c}_rolling_cv": F.col(f"{c}_rolling_std") / (F.col(f"{c}_rolling_mean") + EPSILON) for c in present}
    )


_AGGREGATES = {
    "mean": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "std": F.stddev_samp,
    "var": F.var_samp,
}


def compare(
    df: DataFrame,
    index: str = "batch_id",
    values: str = "peak_co2_ppm",
    aggregate: str = "mean",
    columns: str | None = None,
    column_values: Iterable[str] | None = None,
    max_columns: int = 1_000,
) -> DataFrame:
    """One aggregate per ``index``, or a pivot over ``columns``.

    Without ``column_values`` the distinct values are looked up; more than ``max_columns`` is an
    error, because each would become an output column."""
    measure = _AGGREGATES[aggregate](values)
    if columns is None:
        return df.groupBy(index).agg(measure.alias(values))
    if column_values is None:
        found = df.select(columns).where(F.col(columns).isNotNull()).distinct().limit(max_columns + 1).collect()
        if len(found) > max_columns:
            raise ValueError(f"{columns} has more than {max_columns} distinct values")
        column_values = sorted(row[0] for row in found)
    return df.groupBy(index).pivot(columns, list(column_values)).agg(measure)


def attenuation_slope(
    df: DataFrame,
    order: Iterable[str] = ("timestamp_index",),
    batch: str = "batch_id",
    co2: str = "co2_ppm",
) -> DataFrame:
    """Least-squares slope of CO2 on the row number, with first and last value.

    Batches with fewer than two rows, a missing value or no variation are left out."""
    order = list(order)
    slim = with_batches(df, batch, order[0]).select(*dict.fromkeys([batch, *order, co2]))
    numbered = arrange(slim, order, [batch]).scan().result()
    value, at = F.col(co2), F.col(POSITION)
    return (
        numbered.groupBy(batch)
        .agg(
            F.regr_slope(value, at).alias("attenuation_slope"),
            F.min_by(value, at).alias("initial_co2"),
            F.max_by(value, at).alias("final_co2"),
            F.count(F.lit(1)).alias("_rows"),
            F.count(value).alias("_values"),
            (F.max(value) > F.min(value)).alias("_varies"),
        )
        .filter((F.col("_rows") >= 2) & (F.col("_rows") == F.col("_values")) & F.col("_varies"))
        .drop("_rows", "_values", "_varies")
    )
