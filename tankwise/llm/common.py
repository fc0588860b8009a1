"""Small helpers of the corpus operators."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the operator's own names; whatever else the input has, also under
    those names, is left behind."""
    return df.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Column names that the frame doesn't have (names are compared without case)."""
    taken = {name.lower() for name in df.columns}
    names = []
    for stem in stems:
        name, n = f"_{stem}", 0
        while name in taken:
            n += 1
            name = f"_{stem}{n}"
        taken.add(name)
        names.append(name)
    return names


def text_digest(text: str) -> Column:
    """SHA-256 of a text column; a null text counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256))


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1_000) -> Iterator[None]:
    """Jobs run within send at most so many rows at a time to Python, for rows that hold long texts or
    sets. The session's own setting comes back at the end."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, usual)
