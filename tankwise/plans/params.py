"""Joining fitted parameters to rows: broadcast only after the size was checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tankwise.session import stage, staged_bytes

SMALL_ROWS = 10_000
#: Bytes on disk up to which a written table is broadcast.
SMALL_BYTES = 8 << 20
_VARIABLE = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)


def settle(params: DataFrame, limit: int = SMALL_ROWS) -> tuple[DataFrame, bool]:
    """Compute a parameter table once. Returns the table and whether it is proven small.

    Rows of plain values pass through the driver, at most ``limit`` of them; a larger table is written to
    the shared folder. A table with nested or binary values, whose rows may be of any size, is written in any
    case, and is small if its files are."""
    if any(isinstance(f.dataType, _VARIABLE) for f in params.schema.fields):
        written = stage(params)
        return written, staged_bytes(written) <= SMALL_BYTES
    rows = params.limit(limit + 1).collect()
    if len(rows) <= limit:
        return params.sparkSession.createDataFrame(rows, params.schema), True
    return stage(params), False


def attach(df: DataFrame, params: DataFrame, on: list[str], small: bool, how: str = "left") -> DataFrame:
    """Join parameters to rows: broadcast when proven small, else a shuffle join that adaptive
    execution splits where a key is skewed."""
    return df.join(F.broadcast(params) if small else params, on, how)
