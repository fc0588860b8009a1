"""Phase names, cut points and labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phase names in time order, their codes, and the cut points between them.
PHASES = ("lag", "exponential", "stationary", "decline")
PHASE_CODES = {"lag": 0, "exponential": 1, "stationary": 2, "decline": 3, "unknown": -1}
RATIO_CUTS = (0.1, 0.5, 0.9)
LEVEL_CUTS = (500.0, 1000.0, 1500.0)
CURVE_CUTS = (0.1, 0.4, 0.7)


def below_cuts(value: Column, cuts: tuple[float, ...]) -> Column:
    """Phase by the first cut point above ``value``; a missing value falls through to the last phase."""
    label = F.when(value < cuts[0], PHASES[0])
    for cut, name in zip(cuts[1:], PHASES[1:]):
        label = label.when(value < cut, name)
    return label.otherwise(PHASES[-1])


def phase_by_ratio(value: Column, peak: Column) -> Column:
    """Phase by the share of the profile's peak. The peak counts only for positive values."""
    scale = F.when(value > 0, F.coalesce(peak, value)).otherwise(F.lit(1.0))
    return F.when(scale <= 0, "unknown").otherwise(below_cuts(value / scale, RATIO_CUTS))


def phase_by_level(value: Column) -> Column:
    return below_cuts(value, LEVEL_CUTS)


def phase_cut(value: Column) -> Column:
    """Training label: right-closed bins above zero; NULL outside."""
    label = F.when(value <= 0, F.lit(None).cast("string"))
    for cut, name in zip(LEVEL_CUTS, PHASES):
        label = label.when(value <= cut, name)
    return label.when(value > LEVEL_CUTS[-1], PHASES[-1])


def phase_code(phase: Column, missing: int) -> Column:
    """Number of a phase name; anything else becomes ``missing``."""
    code = F.lit(None).cast("int")
    for name, number in PHASE_CODES.items():
        code = F.when(phase == name, F.lit(number)).otherwise(code)
    return F.coalesce(code, F.lit(missing))


def label_code(phase: Column) -> Column:
    """Training code: only the four phases count, everything else is 0."""
    return F.when(phase.isin(*PHASES), phase_code(phase, 0)).otherwise(F.lit(0))
