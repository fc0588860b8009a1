"""Phase labels from strain and style profiles; golden curves learned from past batches."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tankwise.functions.phases import CURVE_CUTS, PHASES, phase_by_level, phase_by_ratio
from tankwise.functions.times import minutes_between
from tankwise.plans.params import attach, settle

PROFILE_KEYS = ("strain", "style")


def learn_profiles(df: DataFrame, target: str, keys: Iterable[str] = PROFILE_KEYS) -> DataFrame:
    """Mean and maximum of ``target`` per profile key, or for the whole table when a key is absent."""
    keys = list(keys)
    stats = [F.avg(target).alias("mean_co2"), F.max(target).alias("max_co2")]
    if all(key in df.columns for key in keys):
        return df.groupBy(*keys).agg(*stats)
    return df.agg(*stats).select(*(F.lit("default").alias(key) for key in keys), "mean_co2", "max_co2")


def align(
    df: DataFrame, profiles: DataFrame, target: str, keys: Iterable[str] = PROFILE_KEYS, small: bool | None = None
) -> DataFrame:
    """Add ``phase``: by the share of the profile's maximum where a profile is known, else by level.

    Rows that already carry ``phase`` are left alone."""
    keys = list(keys)
    if "phase" in df.columns:
        return df
    if target not in df.columns:
        raise ValueError(f"column {target} is not in the input")
    if small is None:
        profiles, small = settle(profiles)
    known = profiles.select(*keys, F.col("max_co2").alias("_peak"), F.lit(True).alias("_known"))
    labelled = F.when(F.col("_known"), phase_by_ratio(F.col(target), F.col("_peak"))).otherwise(
        phase_by_level(F.col(target))
    )
    columns = df.columns
    if not all(key in columns for key in keys):
        df = df.withColumns({key: F.lit("default") for key in keys if key not in columns})
    return attach(df, known, keys, small).withColumn("phase", labelled).select(*columns, "phase")


class Aligner(Estimator):
    """Uses given profiles (``strain, style, max_co2``) or learns them from the data."""

    def __init__(self, target: str, profiles: DataFrame | None = None, keys: Iterable[str] = PROFILE_KEYS):
        super().__init__()
        self.target, self.profiles, self.keys = target, profiles, list(keys)

    def _fit(self, dataset: DataFrame) -> "AlignerModel":
        profiles = self.profiles
        if profiles is None:
            profiles = learn_profiles(dataset, self.target, self.keys)
        return AlignerModel(self.target, self.keys, *settle(profiles))


class AlignerModel(Model):
    def __init__(self, target: str, keys: list[str], profiles: DataFrame, small: bool):
        super().__init__()
        self.target, self.keys, self.profiles, self.small = target, keys, profiles, small

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return align(dataset, self.profiles, self.target, self.keys, self.small)

    def report(self) -> dict:
        return {"preprocessor": "Aligner", "profiles_loaded": self.profiles.count(), "is_fitted": True}


def learn_curves(
    df: DataFrame,
    time: str,
    columns: Iterable[str],
    batch: Iterable[str] = ("batch_id",),
    keys: Iterable[str] = PROFILE_KEYS,
    minutes: int = 5,
) -> DataFrame:
    """Average course of past batches per profile key and step since the batch began.

    The phase of a step follows its share of the curve's steps."""
    columns, batch, keys = list(columns), list(batch), list(keys)
    starts, small = settle(df.groupBy(*batch).agg(F.min(time).alias("_start")))
    stepped = attach(df, starts, batch, small, how="inner").withColumn(
        "step", F.floor(minutes_between(F.col("_start"), F.col(time)) / minutes)
    )
    curve = stepped.groupBy(*keys, "step").agg(*(F.avg(c).alias(c) for c in columns))
    # A curve has at most one row per step of the longest batch.
    length = F.max("step").over(Window.partitionBy(*keys)) + 1
    ends = [F.floor(length * cut) for cut in CURVE_CUTS]
    phase = F.when(F.col("step") < ends[0], PHASES[0])
    for end, name in zip(ends[1:], PHASES[1:]):
        phase = phase.when(F.col("step") < end, name)
    return curve.withColumn("phase", phase.otherwise(PHASES[-1])).withColumn("time_minutes", F.col("step") * minutes)


def lookup_curve(curves: DataFrame, strain: str, style: str) -> DataFrame:
    """The curve of one strain and style; no rows when there is none."""
    return curves.filter((F.col("strain") == strain) & (F.col("style") == style))


def add_curve(curves: DataFrame, curve: DataFrame) -> DataFrame:
    """``curves`` with ``curve`` in place of any older one for the same strain and style."""
    renewed = curve.select(*PROFILE_KEYS).distinct()
    return curves.join(renewed, list(PROFILE_KEYS), "left_anti").unionByName(curve, allowMissingColumns=True)
