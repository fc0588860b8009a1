"""Batch jobs: preprocessing, scoring, detection and batch summaries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.sql import DataFrame

from tankwise.operators.align import Aligner
from tankwise.operators.anomaly import AnomalyDetector
from tankwise.operators.batch import batch_metrics
from tankwise.operators.features import all_features
from tankwise.operators.missing import MissingHandler
from tankwise.operators.models import PhaseModel
from tankwise.operators.outliers import OutlierHandler
from tankwise.operators.resample import Resampler
from tankwise.operators.scaling import Scaler
from tankwise.operators.schema_map import coalesce_aliases, to_canonical, with_identity
from tankwise.session import stage
from tankwise.sources.writers import record_json

SENSORS = ("co2_lpm", "do_ppm", "temp_c", "pressure_bar")


class Staged(Transformer):
    """Writes its input to the shared folder, so that later fits do not repeat the steps before."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return stage(dataset)


def preprocessing(
    order: Iterable[str],
    columns: Iterable[str] = SENSORS,
    by: str = "tank_id",
    labels: Iterable[str] = ("strain", "style"),
    profiles: DataFrame | None = None,
    minutes: float = 5,
    staged: bool = True,
    gaps_by: Iterable[str] | None = None,
) -> Pipeline:
    """Missing values, outliers, 5-minute grid, scaling per tank, phase labels.

    Gap filling, grid and scaling are per tank. With ``gaps_by=()`` gaps are filled in the row order of the
    whole table, so from other tanks' readings too."""
    order, columns, labels = list(order), list(columns), list(labels)
    gaps_by = [by] if gaps_by is None else list(gaps_by)
    cut = [Staged()] if staged else []
    return Pipeline(
        stages=[
            MissingHandler(order, "both", 3, gaps_by, columns),
            *cut,
            OutlierHandler("iqr", action="clip", columns=columns),
            Resampler(order[0], minutes, "mean", [by], columns, labels, order),
            *cut,
            Aligner(columns[0], profiles),
            Scaler("standard", by, columns),
        ]
    )


def fit_transform(chain: Pipeline, df: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """Fitted chain and transformed rows in one go: the rows each fit has seen are passed on, not
    computed a second time."""
    fitted = []
    for step in chain.getStages():
        model = step.fit(df) if isinstance(step, Estimator) else step
        df = model.transform(df)
        fitted.append(model)
    return PipelineModel(fitted), df


def reports(fitted: PipelineModel) -> list[dict]:
    """Reports of all steps that have one."""
    return [step.report() for step in fitted.stages if hasattr(step, "report")]


def canonical_rows(records: DataFrame, order: Iterable[str]) -> DataFrame:
    """Records in either naming as canonical rows with batch and tank."""
    return with_identity(to_canonical(coalesce_aliases(records), order))


def score(records: DataFrame, model: PhaseModel, order: Iterable[str], keys: Iterable[str] = ("tank_id",)) -> DataFrame:
    """Phase forecast of every batch; lags and frames do not run across ``keys``."""
    rows = canonical_rows(records, order)
    order = [o if o in rows.columns else "timestamp" for o in order]
    return model.forecast(all_features(rows, order, [k for k in keys if k in rows.columns]), order)


def detect(records: DataFrame, order: Iterable[str], keys: Iterable[str] = (), as_json: bool = False) -> DataFrame:
    """Anomalies of all records, as rows or as one JSON string per row."""
    rows = canonical_rows(records, order)
    order = tuple(o if o in rows.columns else "timestamp" for o in order)
    found = AnomalyDetector(order, tuple(keys)).all(rows)
    return record_json(found, "anomaly") if as_json else found


def batch_summary(records: DataFrame, order: Iterable[str] = ("timestamp_index",), **columns: str) -> DataFrame:
    """Metrics of every batch."""
    return batch_metrics(records, order, **columns)
