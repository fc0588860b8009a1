"""Runs catalogue queries and their SQL side by side.

``python -m tests.oracle <folder> [name ...]`` prints one line per query."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def tidy(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    for c in frame.columns:
        frame[c] = frame[c].map(lambda v: v.tolist() if hasattr(v, "tolist") else v)
        frame[c] = frame[c].map(lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v)
    keys = frame.map(repr)
    order = keys.sort_values(list(keys.columns)).index
    return frame.loc[order].reset_index(drop=True)


def difference(mine: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} / {sorted(theirs.columns)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    a, b = tidy(mine), tidy(theirs)
    if a.equals(b):
        return None
    unequal = ~((a == b) | (a.isna() & b.isna()))
    worst = {c: int(unequal[c].sum()) for c in a.columns if unequal[c].any()}
    first = unequal.any(axis=1).idxmax()
    return f"cells {worst}\n  {a.loc[first].to_dict()}\n  {b.loc[first].to_dict()}"


def main(folder: str, names: list[str]) -> int:
    from tankwise.catalog import ORACLES, QUERIES
    from tankwise.session import build_session

    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(folder), 0
    for name in names or QUERIES:
        started = time.time()
        try:
            mine = QUERIES[name](spark, folder).toPandas()
            spent = time.time() - started
            found = None
            if name in ORACLES:
                found = difference(mine, connection.execute(ORACLES[name]).df())
            verdict = found or ("ok" if name in ORACLES else "rows only")
        except Exception as error:
            spent, found = time.time() - started, True
            verdict = f"ERROR {str(error)[:600]}"
            mine = []
        failed += bool(found)
        print(f"{name:22s} {spent:6.2f}s {len(mine):7d} {verdict}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
