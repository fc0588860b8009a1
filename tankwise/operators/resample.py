"""Regular time grid: mean, median or interpolated values per bucket, with empty buckets kept."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tankwise.operators.missing import interpolate
from tankwise.plans.ordered import arrange
from tankwise.plans.params import attach, settle
from tankwise.plans.quantiles import group_quantiles
from tankwise.sources.schemas import numeric_columns

_DAY = 86_400_000_000
_RUN = 1_000
METHODS = ("mean", "median", "interpolate")


def modal_interval(df: DataFrame, order: Iterable[str], keys: Iterable[str] = ()) -> DataFrame:
    """Most frequent step between consecutive rows in seconds; the smallest one on a tie."""
    order = list(order)
    time = F.unix_micros(order[0])
    steps = arrange(df.select(*dict.fromkeys([*keys, *order])), order, keys).framed(
        lambda w: {"_step": time - F.lag(time).over(w)}, back=1
    )
    return (
        steps.rows.filter(F.col("_step").isNotNull())
        .groupBy("_step")
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .orderBy(F.desc("occurrences"), F.asc("_step"))
        .limit(1)
        .select((F.col("_step") / F.lit(1e6)).alias("interval_seconds"), "occurrences")
    )


def bucket_start(time: str, step: int, origin: Column | None = None) -> Column:
    """Start of the left-closed bucket of ``step`` microseconds that holds ``time``."""
    micros = F.unix_micros(time)
    start = F.lit(0) if origin is None else F.unix_micros(origin)
    return F.timestamp_micros(start + F.floor((micros - start) / F.lit(step)).cast("long") * F.lit(step))


def resample(
    df: DataFrame,
    time: str,
    minutes: float = 5,
    method: str = "mean",
    by: Iterable[str] = (),
    columns: Iterable[str] | None = None,
    carry: Iterable[str] = (),
    carry_order: Iterable[str] | None = None,
) -> DataFrame:
    """One row per bucket between the first and the last, for the table or for each group.

    Buckets count from midnight of the first day. ``carry`` columns (not numeric) take their first
    valid value in a bucket by ``carry_order``; empty buckets stay empty."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method}")
    by, carry = list(by), list(carry)
    columns = list(columns or numeric_columns(df, exclude=tuple(by)))
    step = round(minutes * 60_000_000)
    # In a day-dividing grid, counting from midnight and from the epoch is the same.
    origin, keyed = None, df
    if _DAY % step:
        firsts = df.groupBy(*by).agg(F.date_trunc("day", F.min(time)).alias("_origin"))
        if by:
            firsts, small = settle(firsts)
            keyed, origin = attach(df, firsts, by, small, how="inner"), F.col("_origin")
        else:
            origin = firsts.scalar()
    keyed = keyed.filter(F.col(time).isNotNull()).withColumn("_bucket", bucket_start(time, step, origin))

    aggregates = [] if method == "median" else [F.avg(c).alias(c) for c in columns]
    order_by = ", ".join(f"`{name}`" for name in (carry_order or [time]))
    aggregates += [
        F.expr(f"min_by(`{c}`, struct({order_by})) FILTER (WHERE `{c}` IS NOT NULL)").alias(c) for c in carry
    ]
    filled = keyed.groupBy(*by, "_bucket").agg(*(aggregates or [F.count(F.lit(1)).alias("_rows")]))
    if method == "median":
        filled = filled.drop("_rows").join(_medians(keyed, [*by, "_bucket"], columns), [*by, "_bucket"], "left")

    ends = keyed.groupBy(*by).agg(F.min("_bucket").alias("_from"), F.max("_bucket").alias("_to"))
    grid = _grid(ends, by, step)
    result = grid.join(filled, [*by, "_bucket"], "left").withColumnRenamed("_bucket", time)
    if method == "interpolate":
        result = interpolate(result, [time], columns, keys=by, limit=None)
    return result.select(*by, time, *columns, *carry)


def _grid(ends: DataFrame, by: list[str], step: int) -> DataFrame:
    """All bucket starts between the ends: first runs of buckets, which are spread over the tasks,
    then the buckets of each run, so that neither one row nor one task holds a long grid."""
    partitions = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run, each = (F.expr(f"interval {n} microseconds") for n in (step * _RUN, step))
    runs = ends.select(*by, "_to", F.explode(F.sequence("_from", "_to", run)).alias("_run"))
    last = F.least(F.col("_run") + F.expr(f"interval {step * (_RUN - 1)} microseconds"), F.col("_to"))
    return runs.repartition(partitions).select(*by, F.explode(F.sequence("_run", last, each)).alias("_bucket"))


def _medians(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    long = group_quantiles(df, by, columns, [0.5])
    picks = [F.max(F.when(F.col("column") == c, F.col("q")[0])).alias(c) for c in columns]
    return long.groupBy(*by).agg(*picks)


class Resampler(Estimator):
    """Fits the modal sampling interval; the model resamples."""

    def __init__(
        self,
        time: str,
        minutes: float = 5,
        method: str = "mean",
        by: Iterable[str] = (),
        columns: Iterable[str] | None = None,
        carry: Iterable[str] = (),
        order: Iterable[str] | None = None,
    ):
        super().__init__()
        self.time, self.minutes, self.method = time, minutes, method
        self.by, self.carry = list(by), list(carry)
        self.columns = list(columns) if columns else None
        self.order = list(order) if order else [time]

    def _fit(self, dataset: DataFrame) -> "ResampleModel":
        found = modal_interval(dataset, self.order).first()
        return ResampleModel(self, found["interval_seconds"] if found else None)


class ResampleModel(Model):
    def __init__(self, settings: Resampler, original_seconds: float | None):
        super().__init__()
        self.settings, self.original_seconds = settings, original_seconds

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = self.settings
        return resample(dataset, s.time, s.minutes, s.method, s.by, s.columns, s.carry, s.order)

    def report(self) -> dict:
        return {
            "preprocessor": "Resampler",
            "target_frequency": f"{self.settings.minutes:g}min",
            "method": self.settings.method,
            "original_frequency": None if self.original_seconds is None else f"{self.original_seconds}s",
            "is_fitted": True,
        }
