"""Seeded random telemetry for tests."""

from __future__ import annotations

import numpy as np
import pandas as pd

EPOCH = pd.Timestamp("2024-03-01")


def telemetry(rows: int = 600, seed: int = 7, hot_share: float = 0.5, hot_instant: bool = True) -> pd.DataFrame:
    """Rows of four tanks, one of which holds ``hot_share`` of them; gaps of several lengths in ``x``;
    with ``hot_instant``, a third of all rows carry the same time."""
    rng = np.random.default_rng(seed)
    seconds = np.sort(rng.integers(0, rows * 60, rows))
    if hot_instant:
        seconds[rows // 3 : 2 * rows // 3] = seconds[rows // 3]
    tank = np.where(rng.random(rows) < hot_share, "hot", rng.choice(["a", "b", "c"], rows))
    x = np.round(rng.normal(100, 30, rows), 3)
    x[rng.random(rows) < 0.15] = np.nan
    for start in rng.integers(0, rows - 12, 6):
        x[start : start + 9] = np.nan
    x[:3] = np.nan
    y = np.round(rng.normal(0, 1, rows), 3)
    y[rows // 2 : rows // 2 + 40] = 1.25
    frame = pd.DataFrame(
        {"ts": EPOCH + pd.to_timedelta(seconds, unit="s"), "id": np.arange(rows), "tank": tank, "x": x, "y": y}
    )
    return frame


def to_spark(spark, frame: pd.DataFrame, shuffled: bool = True):
    if shuffled:
        frame = frame.sample(frac=1, random_state=1)
    rows = [tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False)]
    kinds = {"M": "timestamp", "i": "long", "f": "double", "O": "string", "b": "boolean"}
    schema = ", ".join(f"`{c}` {kinds[frame[c].dtype.kind]}" for c in frame.columns)
    rows = [
        tuple(
            v.to_pydatetime() if isinstance(v, pd.Timestamp) else v.item() if hasattr(v, "item") else v for v in row
        )
        for row in rows
    ]
    return spark.createDataFrame(rows, schema).repartition(3)


def by_id(df, *columns: str) -> pd.DataFrame:
    return df.select("id", *columns).toPandas().sort_values("id").reset_index(drop=True)
