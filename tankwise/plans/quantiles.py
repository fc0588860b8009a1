"""Exact quantiles (linear interpolation) with bounded memory per task."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tankwise.plans.ordered import arrange, group_size, rows_per_slice

_ACCURACY = 10_000
_BOUNDED = 100_000
_SAMPLE = 1_000_000
_SEED = 23
#: Every round at least halves what is open, but for bad luck with a sample.
_ROUNDS = 200


def table_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    shares: Sequence[float],
    bounded: int | None = None,
    sample: int = _SAMPLE,
) -> dict[str, list[float | None]]:
    """Quantiles of whole columns, as driver values.

    NULL and NaN count as missing. Small tables use one ``percentile`` aggregate. Larger ones are narrowed: the quantiles of a sample
    bracket the two order statistics around every quantile, exact counts prove or correct the bracket, and the next round looks only inside it, until what is left fits ``bounded`` values. A
    round is two scans with small map-side states and no shuffle of rows; all columns and quantiles
    share it."""
    direct = rows_per_slice(df)
    bounded = bounded or min(_BOUNDED, direct)
    plain = {column: _known(column) for column in columns}
    counts = df.agg(*(F.count(plain[c]).alias(f"n{i}") for i, c in enumerate(columns))).first()
    sizes = {column: counts[f"n{i}"] for i, column in enumerate(columns)}
    if max(sizes.values(), default=0) <= direct:
        exact = df.agg(
            *(F.percentile(plain[c], F.array(*map(F.lit, shares))).alias(f"q{i}") for i, c in enumerate(columns))
        ).first()
        return {c: list(exact[f"q{i}"] or [None] * len(shares)) for i, c in enumerate(columns)}

    found: dict[tuple[str, int], float] = {}
    open_ranks = set()
    for column in columns:
        for share in shares:
            if sizes[column]:
                rank = share * (sizes[column] - 1)
                open_ranks |= {(column, math.floor(rank)), (column, math.ceil(rank))}
    _select(df, plain, sizes, open_ranks, found, bounded, sample)

    result: dict[str, list[float | None]] = {}
    for column in columns:
        result[column] = []
        for share in shares:
            if not sizes[column]:
                result[column].append(None)
                continue
            rank = share * (sizes[column] - 1)
            low, high = found[column, math.floor(rank)], found[column, math.ceil(rank)]
            result[column].append(low + (high - low) * (rank - math.floor(rank)))
    return result


def _known(column: str) -> Column:
    """The values of a column as doubles; NaN counts as missing."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _select(
    df: DataFrame,
    plain: dict[str, Column],
    sizes: dict[str, int],
    wanted: set[tuple[str, int]],
    found: dict[tuple[str, int], float],
    bounded: int,
    sample: int,
) -> None:
    """Fill ``found`` with the order statistics ``wanted`` as (column, 0-based rank).

    Every round also tests a pivot near the wanted rank, which is either the answer or leaves the
    span; so a round always makes progress, however many equal values there are."""
    inf = math.inf
    # (column, rank) -> (low, high, values below low, values within [low, high])
    spans = {task: (-inf, inf, 0, sizes[task[0]]) for task in wanted}
    unsampled: set[tuple[str, int]] = set()
    for _ in range(_ROUNDS):
        if not spans:
            return
        tasks = list(spans)
        aggregates = []
        for i, (column, rank) in enumerate(tasks):
            low, high, below, inside = spans[column, rank]
            value = F.when(plain[column].between(low, high), plain[column])
            if inside <= bounded:
                aggregates.append(F.array_sort(F.collect_list(value))[rank - below].alias(f"t{i}"))
                continue
            share, slack = (rank - below) / inside, 2 / _ACCURACY
            if inside > sample and (column, rank) not in unsampled:
                value = F.when(F.col("_draw") < sample / inside, value)
                slack += 2 / math.sqrt(sample)
            shares = [max(0.0, share - slack), share, min(1.0, share + slack)]
            aggregates.append(F.percentile_approx(value, shares, _ACCURACY).alias(f"t{i}"))
        seen = df.withColumn("_draw", F.rand(_SEED)).agg(*aggregates).first()
        guesses = {}
        for i, task in enumerate(tasks):
            if spans[task][3] <= bounded:
                found[task] = seen[f"t{i}"]
                del spans[task]
            elif seen[f"t{i}"] is None:  # nothing was drawn
                unsampled.add(task)
            else:
                guesses[task] = tuple(seen[f"t{i}"])
        if not guesses:
            continue
        checks = []
        for i, (task, (low, pivot, high)) in enumerate(guesses.items()):
            value = plain[task[0]]
            checks += [
                F.struct(
                    F.count_if(value < low),
                    F.count_if(value < pivot),
                    F.count_if(value <= pivot),
                    F.count_if(value <= high),
                ).alias(f"c{i}")
            ]
        seen = df.agg(*checks).first()
        for i, (task, (low, pivot, high)) in enumerate(guesses.items()):
            rank, (old_low, old_high, old_below, old_inside) = task[1], spans[task]
            to_low, to_pivot, past_pivot, past_high = seen[f"c{i}"]
            if to_pivot <= rank < past_pivot:
                found[task] = pivot
                del spans[task]
            elif rank < to_low:
                spans[task] = (old_low, math.nextafter(low, -inf), old_below, to_low - old_below)
            elif rank < to_pivot:
                spans[task] = (low, math.nextafter(pivot, -inf), to_low, to_pivot - to_low)
            elif rank < past_high:
                spans[task] = (math.nextafter(pivot, inf), high, past_pivot, past_high - past_pivot)
            else:
                spans[task] = (math.nextafter(high, inf), old_high, past_high, old_below + old_inside - past_high)
    if spans:
        raise RuntimeError(f"quantiles not found in {_ROUNDS} rounds; did the input change meanwhile?")


def group_quantiles(
    df: DataFrame, by: Iterable[str], columns: Sequence[str], shares: Sequence[float]
) -> DataFrame:
    """Quantiles per group in long form: ``by``, ``column``, ``q`` (array in the order of ``shares``).

    The sizes of the groups are measured first. Where none has more rows than one task may order, one
    aggregate holds the values of a group. Otherwise rows are reduced to (group, column, value, count),
    which spreads a large group over all tasks, and ranks come from a running count per group that is cut
    into slices where needed."""
    by = list(by)
    if group_size(df, tuple(by))[0] <= rows_per_slice(df):
        wanted = F.array(*map(F.lit, shares))
        found = df.groupBy(*by).agg(*(F.percentile(_known(c), wanted).alias(f"_q{i}") for i, c in enumerate(columns)))
        cells = [F.struct(F.lit(c).alias("column"), F.col(f"_q{i}").alias("q")) for i, c in enumerate(columns)]
        return found.select(*by, F.inline(F.array(*cells))).filter(F.col("q").isNotNull())
    long = df.select(
        *by,
        F.explode(
            F.array(
                *(F.struct(F.lit(c).alias("column"), _known(c).alias("value")) for c in columns)
            )
        ).alias("_cell"),
    ).select(*by, "_cell.column", "_cell.value")
    counted = long.filter(F.col("value").isNotNull()).groupBy(*by, "column", "value").agg(
        F.count(F.lit(1)).alias("_times")
    )
    ranked = (
        arrange(counted, ["value"], [*by, "column"])
        .scan(sums={"_upto": F.col("_times")}, totals=["_upto"])
        .result()
    )
    picks = []
    for i, share in enumerate(shares):
        rank = F.lit(float(share)) * (F.col("_upto_total") - 1)
        picks += [
            F.min(F.when(F.col("_upto") > F.floor(rank), F.col("value"))).alias(f"_low{i}"),
            F.min(F.when(F.col("_upto") > F.ceil(rank), F.col("value"))).alias(f"_high{i}"),
        ]
    edges = ranked.groupBy(*by, "column").agg(F.max("_upto_total").alias("_n"), *picks)
    values = []
    for i, share in enumerate(shares):
        rank = F.lit(float(share)) * (F.col("_n") - 1)
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        values.append(low + (high - low) * (rank - F.floor(rank)))
    return edges.select(*by, "column", F.array(*values).alias("q"))
