"""Statistics that grow with the data: mergeable states per key, stored by day.

A state holds the number of values, their mean, the sums of the second, third and fourth powers of the
deviations from it, and the extremes. States of parts are merged without the rows, so a fit over all days
reads the rows of the newest day only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tankwise.operators.scaling import _center, _spread

PARTS = ("n", "mean", "m2", "m3", "m4", "low", "high")


def states(df: DataFrame, keys: Iterable[str], columns: Iterable[str]) -> DataFrame:
    """One state per key and column: ``keys, column, n, mean, m2, m3, m4, low, high``. NULL and NaN count as
    missing; a column without values has no state."""
    keys, columns = list(keys), list(columns)
    aggregates = []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        value = F.when(~F.isnan(value), value)
        found = {"n": F.count, "mean": F.avg, "v": F.var_pop, "s": F.skewness, "k": F.kurtosis, "low": F.min, "high": F.max}
        aggregates += [function(value).alias(f"{name}{i}") for name, function in found.items()]
    cells = []
    for i, c in enumerate(columns):
        n, m2 = F.col(f"n{i}"), F.col(f"v{i}") * F.col(f"n{i}")
        flat = F.coalesce(m2 == 0, F.lit(True))
        m3 = F.when(flat, 0.0).otherwise(F.col(f"s{i}") * m2 * F.sqrt(m2) / F.sqrt(n))
        m4 = F.when(flat, 0.0).otherwise((F.col(f"k{i}") + 3) * m2 * m2 / n)
        parts = (n, F.col(f"mean{i}"), m2, m3, m4, F.col(f"low{i}"), F.col(f"high{i}"))
        cells.append(F.struct(F.lit(c).alias("column"), *(p.alias(name) for p, name in zip(parts, PARTS))))
    return df.groupBy(*keys).agg(*aggregates).select(*keys, F.inline(F.array(*cells))).filter("n > 0")


def append(df: DataFrame, path: str, keys: Iterable[str], columns: Iterable[str], day: str) -> None:
    """Add the states of one day's rows to the table at ``path``; the same day given again is replaced."""
    found = states(df, keys, columns).withColumn("day", F.lit(day))
    writer = found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day")
    writer.parquet(path)


def merged(parts: DataFrame, keys: Iterable[str]) -> DataFrame:
    """States over all parts, one per key and column."""
    keys = [*keys, "column"]
    over = Window.partitionBy(*keys)
    centre = F.sum(F.col("n") * F.col("mean")).over(over) / F.sum("n").over(over)
    moved = parts.withColumn("_centre", centre).withColumn("_d", F.col("mean") - F.col("_centre"))
    n, d, m2, m3, m4 = (F.col(c) for c in ("n", "_d", "m2", "m3", "m4"))
    return moved.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.max("_centre").alias("mean"),
        F.sum(m2 + n * d * d).alias("m2"),
        F.sum(m3 + 3 * d * m2 + n * d * d * d).alias("m3"),
        F.sum(m4 + 4 * d * m3 + 6 * d * d * m2 + n * d * d * d * d).alias("m4"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )


def read(spark: SparkSession, path: str, keys: Iterable[str]) -> DataFrame:
    """Merged states of all days at ``path``: one small row per key, column and day is read."""
    return merged(spark.read.parquet(path), keys)


def summary(found: DataFrame) -> DataFrame:
    """Sample deviation, and population skewness and excess kurtosis (0 for a constant), of merged states."""
    n, m2 = F.col("n"), F.col("m2")
    return found.withColumns(
        {
            "std": F.when(n > 1, F.sqrt(m2 / (n - 1))),
            "skew": F.when(m2 > 0, F.sqrt(n.cast("double")) * F.col("m3") / (m2 * F.sqrt(m2))).otherwise(0.0),
            "kurt": F.when(m2 > 0, n * F.col("m4") / (m2 * m2) - 3).otherwise(0.0),
        }
    )


def scaling_from_states(found: DataFrame, keys: list[str], columns: Iterable[str], method: str = "standard") -> DataFrame:
    """Parameters of standard or min-max scaling from merged states, as a fit over the rows gives them."""
    if method not in ("standard", "minmax"):
        raise ValueError("states hold what standard and minmax scaling need")
    told = summary(found)
    if method == "standard":
        told = told.withColumns({"_c": F.col("mean"), "_s": F.col("std")})
    else:
        told = told.withColumns({"_c": F.col("low"), "_s": F.col("high") - F.col("low")})
    picks = []
    for c in columns:
        own = F.col("column") == c
        picks += [F.max(F.when(own, F.col("_c"))).alias(_center(c)), F.max(F.when(own, F.col("_s"))).alias(_spread(c))]
    return told.groupBy(*keys).agg(*picks)


def zscore_bounds_from_states(found: DataFrame, deviations: float = 3.0) -> DataFrame:
    """Limits ``mean ± deviations · std`` per key and column."""
    told = summary(found)
    return told.withColumns(
        {"lower": F.col("mean") - deviations * F.col("std"), "upper": F.col("mean") + deviations * F.col("std")}
    )
