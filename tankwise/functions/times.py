"""Time arithmetic in exact microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(6e7)


def hours_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(3.6e9)
