"""Outlier bounds by quartiles or standard scores; clip, remove or mark."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tankwise.plans.quantiles import table_quantiles
from tankwise.sources.schemas import numeric_columns

Bounds = dict[str, tuple[float | None, float | None]]


def iqr_bounds(df: DataFrame, columns: Iterable[str]) -> Bounds:
    """One and a half quartile ranges around the quartiles."""
    bounds: Bounds = {}
    for column, (low, high) in table_quantiles(df, list(columns), [0.25, 0.75]).items():
        reach = None if low is None else 1.5 * (high - low)
        bounds[column] = (None, None) if reach is None else (low - reach, high + reach)
    return bounds


def zscore_bounds(df: DataFrame, columns: Iterable[str], threshold: float = 3.0) -> Bounds:
    """``threshold`` sample deviations around the mean; columns without spread have no bounds."""
    columns = list(columns)
    stats = df.agg(
        *(F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)),
        *(F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(columns)),
    ).first()
    return {
        c: (stats[f"m{i}"] - threshold * stats[f"s{i}"], stats[f"m{i}"] + threshold * stats[f"s{i}"])
        for i, c in enumerate(columns)
        if stats[f"s{i}"] is not None and stats[f"s{i}"] > 0
    }


def bounds_table(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Bounds in long form."""
    rows = [(c, low, high) for c, (low, high) in bounds.items()]
    return df.sparkSession.createDataFrame(rows, "column string, lower double, upper double")


def outside(column: str, bounds: tuple[float | None, float | None]) -> Column:
    """True for a value beyond its bounds; a missing value is inside."""
    low, high = bounds
    if low is None:
        return F.lit(False)
    return F.coalesce((F.col(column) < low) | (F.col(column) > high), F.lit(False))


def clip(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    clipped = {}
    for c, (low, high) in bounds.items():
        if low is not None:
            within = F.least(F.greatest(F.col(c).cast("double"), F.lit(low)), F.lit(high))
            clipped[c] = F.when(F.col(c).isNotNull(), within)
    return df.withColumns(clipped)


def remove(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    for c, pair in bounds.items():
        df = df.filter(~outside(c, pair))
    return df


def mark(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({f"{c}_outlier": outside(c, pair).cast("int") for c, pair in bounds.items()})


def outlier_counts(
    df: DataFrame, bounds: Mapping[str, tuple[float, float]], sequential: bool = False
) -> DataFrame:
    """Outliers per column. ``sequential`` counts a row at its first offending column only, as when
    each column removes its rows before the next one is looked at."""
    counted, kept = [], F.lit(True)
    for c, pair in bounds.items():
        found = outside(c, pair)
        counted.append(F.count_if(found & kept if sequential else found).alias(f"_{len(counted)}"))
        kept = kept & ~found
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("outliers")) for i, c in enumerate(bounds)
    ]
    return df.agg(*counted).select(F.inline(F.array(*cells)))


class OutlierHandler(Estimator):
    """Fits bounds. ``both`` reports standard-score bounds too, but treats values by quartiles."""

    def __init__(
        self,
        method: str = "iqr",
        threshold: float = 3.0,
        action: str = "clip",
        columns: Iterable[str] | None = None,
    ):
        super().__init__()
        if method not in ("iqr", "zscore", "both"):
            raise ValueError(f"unknown method {method}")
        if action not in ("clip", "remove", "mark"):
            raise ValueError(f"unknown action {action}")
        self.method, self.threshold, self.action = method, threshold, action
        self.columns = list(columns) if columns else None

    def _fit(self, dataset: DataFrame) -> "OutlierModel":
        columns = self.columns or numeric_columns(dataset)
        bounds: dict[str, Bounds] = {}
        if self.method in ("iqr", "both"):
            bounds["iqr"] = iqr_bounds(dataset, columns)
        if self.method in ("zscore", "both"):
            bounds["zscore"] = zscore_bounds(dataset, columns, self.threshold)
        return OutlierModel(self.method, self.threshold, self.action, bounds)


class OutlierModel(Model):
    def __init__(self, method: str, threshold: float, action: str, bounds: dict[str, Bounds]):
        super().__init__()
        self.method, self.threshold, self.action, self.bounds = method, threshold, action, bounds

    @property
    def active(self) -> Bounds:
        return self.bounds["zscore" if self.method == "zscore" else "iqr"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        apply = {"clip": clip, "remove": remove, "mark": mark}[self.action]
        return apply(dataset, {c: b for c, b in self.active.items() if c in dataset.columns})

    def counts(self, dataset: DataFrame) -> DataFrame:
        return outlier_counts(dataset, self.active, sequential=self.action == "remove")

    def report(self) -> dict:
        return {
            "preprocessor": "OutlierHandler",
            "method": self.method,
            "threshold": self.threshold,
            "action": self.action,
            "bounds": {f"{c}_{kind}": str(pair) for kind, b in self.bounds.items() for c, pair in b.items()},
            "is_fitted": True,
        }
