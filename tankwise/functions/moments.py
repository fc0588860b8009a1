"""Mean, deviation, bias-corrected skewness and excess kurtosis over trailing row frames.

A frame's central moments are merged from those of two shorter, adjacent frames: the one that ends at
the row and an earlier one reached by ``lag``. Doubling the length step by step needs about
``log2(length)`` lags per column, whatever the length, where a window aggregate would visit every
row of every frame. Merging is as stable as the merging of partial aggregates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

STATISTICS = ("mean", "std", "skew", "kurt")

PARTS = ("n", "mean", "m2", "m3", "m4")

# Two adjacent frames a (recent) and b (earlier) together. Each term is a column of its own, so that
# it is computed once per row.
MERGE = {
    "share": "{nb} / greatest({na} + {nb}, 1D)",
    "left": "1D - {share}",
    "gap": "{meanb} - {meana}",
    "both": "{gap} * {gap} * {na} * {share}",
    "n": "{na} + {nb}",
    "mean": "{meana} + {gap} * {share}",
    "m2": "{m2a} + {m2b} + {both}",
    "m3": "{m3a} + {m3b} + {gap} * ({both} * ({left} - {share})"
    " + 3D * ({left} * {m2b} - {share} * {m2a}))",
    "m4": "{m4a} + {m4b} + {gap} * ({gap} * ({both} * ({left} * {left} - {left} * {share}"
    " + {share} * {share}) + 6D * ({left} * {left} * {m2b} + {share} * {share} * {m2a}))"
    " + 4D * ({left} * {m3b} - {share} * {m3a}))",
}


def _name(part: str, length: int, column: str) -> str:
    return f"_{part}_{length}_{column}"


def _steps(lengths: Iterable[int]) -> list[tuple[int, int, int]]:
    """(length, recent part, earlier part) for every frame length to build, shortest first."""
    steps: dict[int, tuple[int, int, int]] = {}

    def build(length: int) -> None:
        if length <= 1 or length in steps:
            return
        recent, earlier = (length // 2, length // 2) if length % 2 == 0 else (length - 1, 1)
        build(recent)
        steps[length] = (length, recent, earlier)

    for length in lengths:
        build(length)
    return [steps[length] for length in sorted(steps)]


def _merge(column: str, length: int, recent: int, earlier: int, w: WindowSpec) -> dict[str, Column]:
    """Terms and moments of one length from those of two shorter ones."""

    names = {f"{part}a": f"`{_name(part, recent, column)}`" for part in PARTS}
    names |= {f"{part}b": f"`{_name('b' + part, length, column)}`" for part in PARTS}
    names |= {term: f"`{_name(term, length, column)}`" for term in MERGE}
    lagged = {
        _name("b" + part, length, column): F.lag(_name(part, earlier, column), recent, 0.0).over(w) for part in PARTS
    }
    return lagged | {_name(term, length, column): F.expr(formula.format(**names)) for term, formula in MERGE.items()}


def rolling_stages(columns: list[str], lengths: Iterable[int], w: WindowSpec) -> list[dict[str, Column]]:
    """Window stages that leave the moments of every column and length, under helper names.

    A frame of one row starts the chain; a missing value is a row without a value."""
    lengths = list(lengths)
    first: dict[str, Column] = {}
    for c in columns:
        first[_name("n", 1, c)] = F.expr(f"if(`{c}` IS NULL, 0D, 1D)")
        first[_name("mean", 1, c)] = F.expr(f"coalesce(CAST(`{c}` AS DOUBLE), 0D)")
        first |= {_name(part, 1, c): F.lit(0.0) for part in ("m2", "m3", "m4")}
    stages = [first]
    for step in _steps(lengths):
        merged: dict[str, Column] = {}
        for c in columns:
            merged |= _merge(c, *step, w)
        stages.append(merged)
    stages.append({_rows(length): F.count(F.lit(1)).over(w.rowsBetween(1 - length, 0)) for length in lengths})
    return stages


def _rows(length: int) -> str:
    return f"_rows_{length}"


# Bias-corrected statistics from the moments of a frame with n values in {rows} rows.
FORMULAS = {
    "mean": "if({n} > 0, {mean}, NULL)",
    "std": "if({n} > 1, sqrt({m2} / ({n} - 1)), NULL)",
    "skew": "CASE WHEN {n} < 3 THEN NULL WHEN {m2} = 0 THEN 0D"
    " ELSE sqrt({n} * ({n} - 1)) / ({n} - 2) * sqrt({n}) * {m3} / ({m2} * sqrt({m2})) END",
    "kurt": "CASE WHEN {n} = 0 THEN NULL WHEN {rows} <= 3 THEN 0D WHEN {n} < 4 THEN NULL WHEN {m2} = 0 THEN 0D"
    " ELSE ({n} - 1) / (({n} - 2) * ({n} - 3)) * (({n} + 1) * ({n} * {m4} / ({m2} * {m2}) - 3) + 6) END",
}


def statistic(column: str, length: int, name: str) -> Column:
    """One of ``STATISTICS`` from the moments.

    The deviation is NULL below two values, skewness below three, kurtosis below four - except that
    kurtosis is 0 while the frame has at most three rows. A constant frame has skewness and kurtosis 0."""
    parts = {part: f"`{_name(part, length, column)}`" for part in PARTS}
    return F.expr(FORMULAS[name].format(rows=f"`{_rows(length)}`", **parts))
