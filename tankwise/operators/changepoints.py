"""Changepoints by running sum, two-window mean shift or derivative."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tankwise.operators.pelt import segments
from tankwise.plans.ordered import POSITION, Ordered, arrange
from tankwise.session import stage

WIDEST_WINDOW = 50  # fixed value: half-window, unless a tenth of the series is shorter


def detect(
    df: DataFrame,
    order: Iterable[str],
    column: str,
    method: str = "cusum",
    threshold: float = 3.0,
) -> DataFrame:
    """Rows that are changepoints, as ``(idx, <order columns>, value)``.

    ``method`` is ``cusum`` or ``window``; any other name means the derivative. Deviations are
    population deviations over the whole series, and a series with a missing value has none."""
    order = list(order)
    if column not in df.columns:
        raise ValueError(f"column {column} is not in the input")
    series = df.select(*dict.fromkeys([*order, column])).withColumn("_x", F.col(column).cast("double"))
    totals = series.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("_x").alias("present"),
        F.avg("_x").alias("mean"),
        F.stddev_pop("_x").alias("std"),
    ).first()
    if totals["n"] == 0 or totals["n"] != totals["present"]:
        found = series.filter(F.lit(False)).withColumn(POSITION, F.lit(0).cast("long"))
    else:
        arranged = arrange(series, order)
        if method == "cusum":
            found = _cusum(arranged, totals["mean"], threshold * totals["std"])
        elif method == "window":
            found = _window(arranged, totals["n"], threshold * totals["std"])
        else:
            found = _derivative(arranged, threshold)
    return found.select(F.col(POSITION).alias("idx"), *order, F.col(column).alias("value"))


def _cusum(arranged: Ordered, mean: float, limit: float) -> DataFrame:
    summed = arranged.scan(sums={"_drift": F.col("_x") - F.lit(mean)}).result()
    return summed.filter((F.col(POSITION) >= 1) & (F.abs("_drift") > limit))


def _window(arranged: Ordered, n: int, limit: float) -> DataFrame:
    half = min(WIDEST_WINDOW, n // 10)
    numbered = arranged.scan()
    if half == 0:
        return numbered.result().filter(F.lit(False))

    def shift(w) -> dict[str, Column]:
        before = F.avg("_x").over(w.rowsBetween(-half, -1))
        after = F.avg("_x").over(w.rowsBetween(0, half - 1))
        return {"_shift": after - before}

    shifted = numbered.framed(shift, back=half, ahead=half - 1).result()
    inside = (F.col(POSITION) >= half) & (F.col(POSITION) < n - half)
    return shifted.filter(inside & (F.abs("_shift") > limit))


def _derivative(arranged: Ordered, threshold: float) -> DataFrame:
    stepped = arranged.framed(lambda w: {"_step": F.col("_x") - F.lag("_x").over(w)}, back=1)
    spread = stepped.rows.agg(F.stddev_pop("_step")).first()[0]
    if spread is None:
        return stepped.scan().result().filter(F.lit(False))
    return stepped.scan().result().filter(F.abs("_step") > threshold * spread)


def partitioned(df: DataFrame, order: Iterable[str], column: str, keys: Iterable[str], penalty: float) -> DataFrame:
    """Changepoints of every key's series by optimal partitioning, as ``(keys, idx, <order columns>)``."""
    order, keys = list(order), list(keys)
    found = segments(df, order, column, keys, penalty).filter(F.col("idx") > 0)
    return found.select(*dict.fromkeys([*keys, "idx", *order]))


def boundaries(df: DataFrame, order: Iterable[str], column: str, method: str = "cusum", threshold: float = 3.0) -> DataFrame:
    """Changepoints with the number of all changepoints beside each."""
    found = stage(detect(df, order, column, method, threshold))  # counted and returned
    return found.withColumn("num_changepoints", found.agg(F.count(F.lit(1))).scalar())
