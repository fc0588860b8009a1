"""Missing values: profile, limited interpolation, forward and backward fill."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tankwise.plans.ordered import POSITION, Ordered, arrange
from tankwise.sources.schemas import numeric_columns


def missing_profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Per column: number and percentage of missing values (one aggregate for all columns)."""
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)),
    )
    cells = F.array(
        *(F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("missing")) for i, c in enumerate(columns))
    )
    return counts.select("_rows", F.inline(cells)).select(
        "column",
        "missing",
        F.try_divide(F.col("missing") * 100.0, F.col("_rows")).alias("missing_pct"),
    )


def _scanned(
    df: DataFrame | Ordered, order: Iterable[str], keys: Iterable[str], columns: list[str], earlier: bool = True, later: bool = True
) -> Ordered:
    arranged = df if isinstance(df, Ordered) else arrange(df, order, keys)
    return arranged.scan(earlier=columns if earlier else (), later=columns if later else ())


def _distance(column: str) -> Column:
    """Rows since the last valid value."""
    return F.col(POSITION) - F.col(f"_prev_{column}.at")


def _on_line(column: str, distance: Column) -> Column:
    """Value ``distance`` rows after the last valid one, on the line to the next valid one.

    Without a next value the last one is kept."""
    before, after = F.col(f"_prev_{column}"), F.col(f"_next_{column}")
    start = before["value"].cast("double")
    slope = (after["value"].cast("double") - start) / (after["at"] - before["at"]).cast("double")
    return F.when(after.isNull(), start).otherwise(start + slope * distance)


def _filled(column: str, numeric: bool, method: str, limit: int | None) -> Column:
    """The value of ``column`` after interpolation, forward fill and backward fill.

    The three steps are closed forms of the distance to the nearest valid values: interpolation
    covers the first ``limit`` rows of a gap, forward fill repeats its last value for ``limit`` more,
    backward fill takes the next valid value for the rest."""
    value = F.col(column)
    candidates = [value]
    far, before = _distance(column), F.col(f"_prev_{column}")
    interpolates = numeric and method in ("interpolate", "both")
    if interpolates:
        value = value.cast("double")
        candidates = [value]
        within = F.lit(True) if limit is None else far <= limit
        candidates.append(F.when(value.isNull() & before.isNotNull() & within, _on_line(column, far)))
    if method in ("forward_fill", "both") and limit is not None:
        if interpolates:
            candidates.append(F.when(far <= 2 * limit, _on_line(column, F.lit(limit))))
        else:
            candidates.append(F.when(far <= limit, before["value"]))
    elif method in ("forward_fill", "both"):
        candidates.append(before["value"])
    candidates.append(F.col(f"_next_{column}.value"))
    return F.coalesce(*candidates)


def _project(arranged: Ordered, replaced: dict[str, Column], columns: list[str]) -> DataFrame:
    helpers = [f"_{side}_{c}" for c in columns for side in ("prev", "next")]
    return arranged.with_rows(arranged.rows.withColumns(replaced).drop(POSITION, *helpers)).result()


def interpolate(
    df: DataFrame | Ordered,
    order: Iterable[str],
    columns: Iterable[str],
    keys: Iterable[str] = (),
    limit: int | None = 3,
) -> DataFrame:
    """Linear in the row number. Fills the first ``limit`` missing values of each gap after a valid
    value; a trailing gap repeats the last value; leading gaps stay."""
    columns = list(columns)
    arranged = _scanned(df, order, keys, columns)
    replaced = {}
    for c in columns:
        far, value = _distance(c), F.col(c).cast("double")
        within = F.lit(True) if limit is None else far <= limit
        fill = F.when(F.col(f"_prev_{c}").isNotNull() & within, _on_line(c, far))
        replaced[c] = F.when(value.isNull(), fill).otherwise(value)
    return _project(arranged, replaced, columns)


def forward_fill(
    df: DataFrame | Ordered,
    order: Iterable[str],
    columns: Iterable[str],
    keys: Iterable[str] = (),
    limit: int | None = 3,
) -> DataFrame:
    """Repeat the last valid value for at most ``limit`` rows."""
    columns = list(columns)
    arranged = _scanned(df, order, keys, columns, later=False)
    replaced = {}
    for c in columns:
        within = F.lit(True) if limit is None else _distance(c) <= limit
        replaced[c] = F.coalesce(F.col(c), F.when(within, F.col(f"_prev_{c}.value")))
    return _project(arranged, replaced, columns)


def backward_fill(
    df: DataFrame | Ordered, order: Iterable[str], columns: Iterable[str], keys: Iterable[str] = ()
) -> DataFrame:
    """Take the next valid value, however far."""
    columns = list(columns)
    arranged = _scanned(df, order, keys, columns, earlier=False)
    return _project(arranged, {c: F.col(f"_next_{c}.value") for c in columns}, columns)


def fill_gaps(
    df: DataFrame | Ordered,
    order: Iterable[str],
    keys: Iterable[str] = (),
    columns: Iterable[str] | None = None,
    method: str = "interpolate",
    limit: int = 3,
) -> DataFrame:
    """All steps of ``method`` in one pass: ``interpolate``, ``forward_fill`` or ``both``, each
    followed by an unlimited backward fill."""
    if method not in ("interpolate", "forward_fill", "both"):
        raise ValueError(f"unknown method {method}")
    order, keys = list(order), list(keys)
    frame = df.rows if isinstance(df, Ordered) else df
    columns = list(columns or [c for c in frame.columns if c not in order and c not in keys])
    numeric = set(numeric_columns(frame))
    arranged = _scanned(df, order, keys, columns)
    replaced = {c: _filled(c, c in numeric, method, limit) for c in columns}
    return _project(arranged, replaced, columns)


class MissingHandler(Estimator):
    """Fits the missing-value profile; the model fills gaps in row order."""

    def __init__(
        self,
        order: Iterable[str],
        method: str = "interpolate",
        limit: int = 3,
        keys: Iterable[str] = (),
        columns: Iterable[str] | None = None,
    ):
        super().__init__()
        self.order, self.keys = list(order), list(keys)
        self.method, self.limit = method, limit
        self.columns = list(columns) if columns else None

    def _fit(self, dataset: DataFrame) -> "MissingModel":
        return MissingModel(self, missing_profile(dataset).collect())


class MissingModel(Model):
    def __init__(self, settings: MissingHandler, profile: list[T.Row]):
        super().__init__()
        self.settings, self.profile = settings, profile

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = self.settings
        return fill_gaps(dataset, s.order, s.keys, s.columns, s.method, s.limit)

    def report(self) -> dict:
        return {
            "preprocessor": "MissingHandler",
            "method": self.settings.method,
            "missing_statistics": {
                "total_missing": {r["column"]: r["missing"] for r in self.profile},
                "missing_percentage": {r["column"]: r["missing_pct"] for r in self.profile},
                "columns_with_missing": [r["column"] for r in self.profile if r["missing"]],
            },
            "is_fitted": True,
        }
