"""Standard, min-max and robust scaling, for the whole table or per group."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tankwise.plans.params import attach, settle
from tankwise.plans.quantiles import group_quantiles, table_quantiles
from tankwise.sources.schemas import numeric_columns

EPSILON = 1e-10  # fixed value: added to every denominator
METHODS = ("standard", "minmax", "robust")


def _center(c: str) -> str:
    return f"_center_{c}"


def _spread(c: str) -> str:
    return f"_spread_{c}"


def scaling_params(df: DataFrame, columns: list[str], method: str, by: str | None = None) -> DataFrame:
    """Center and spread of every column: one row, or one row per group."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method}")
    if method == "robust" and by:
        quartiles = group_quantiles(df, [by], columns, [0.25, 0.5, 0.75])
        picks = []
        for c in columns:
            q = F.max(F.when(F.col("column") == c, F.col("q")))
            picks += [q[1].alias(_center(c)), (q[2] - q[0]).alias(_spread(c))]
        return quartiles.groupBy(by).agg(*picks)
    if method == "robust":
        fitted = table_quantiles(df, columns, [0.25, 0.5, 0.75])
        row, names = [], []
        for c in columns:
            low, mid, high = fitted[c]
            row += [mid, None if mid is None else high - low]
            names += [f"`{_center(c)}` double", f"`{_spread(c)}` double"]
        return df.sparkSession.createDataFrame([tuple(row)], ", ".join(names))
    picks = []
    for c in columns:
        value = F.col(c).cast("double")
        if method == "standard":
            center, spread = F.avg(value), F.stddev_samp(value)
        else:
            center, spread = F.min(value), F.max(value) - F.min(value)
        picks += [center.alias(_center(c)), spread.alias(_spread(c))]
    return (df.groupBy(by) if by else df.groupBy()).agg(*picks)


class Scaler(Estimator):
    """Fits scaling parameters; with ``group_by``, one set per group.

    A ``group_by`` column that is absent means whole-table scaling."""

    def __init__(
        self, method: str = "standard", group_by: str | None = None, columns: Iterable[str] | None = None
    ):
        super().__init__()
        if method not in METHODS:
            raise ValueError(f"unknown method {method}")
        self.method, self.group_by = method, group_by
        self.columns = list(columns) if columns else None

    def _fit(self, dataset: DataFrame) -> "ScalerModel":
        by = self.group_by if self.group_by in dataset.columns else None
        columns = self.columns or numeric_columns(dataset, exclude=(by,) if by else ())
        params, small = settle(scaling_params(dataset, columns, self.method, by))
        return ScalerModel(self.method, by, columns, params, small)


class ScalerModel(Model):
    """Applies ``(x - center) / (spread + EPSILON)``; rows of unseen groups stay as they are."""

    def __init__(self, method: str, by: str | None, columns: list[str], params: DataFrame, small: bool):
        super().__init__()
        self.method, self.by, self.columns, self.fitted, self.small = method, by, columns, params, small

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = [c for c in self.columns if c in dataset.columns]
        if self.by is None:
            fitted = self.fitted.first()
            return dataset.withColumns(
                {
                    c: _scaled(c, F.lit(fitted[_center(c)]).cast("double"), F.lit(fitted[_spread(c)]).cast("double"))
                    for c in columns
                }
            )
        if self.by not in dataset.columns:
            return dataset
        known = self.fitted.withColumn("_known", F.lit(True))
        joined = attach(dataset, known, [self.by], self.small)
        scaled = {
            c: F.when(F.col("_known"), _scaled(c, F.col(_center(c)), F.col(_spread(c)))).otherwise(
                F.col(c).cast("double")
            )
            for c in columns
        }
        return joined.withColumns(scaled).select(*dataset.columns)

    def report(self) -> dict:
        return {
            "preprocessor": "Normalizer",
            "method": self.method,
            "group_by": self.by,
            "groups_processed": self.fitted.count() if self.by else 0,
            "is_fitted": True,
        }


def _scaled(c: str, center: Column, spread: Column) -> Column:
    return (F.col(c).cast("double") - center) / (spread + EPSILON)
