"""Row-order operators that never put one whole group into one task.

Telemetry operators such as lag, rolling frames, gap filling and running sums depend on the order of
rows within a key, or over the whole table when there is no key. A plain ``Window`` puts each key
into one task, which fails once a tank (or the un-keyed table) holds a large share of the rows.

:func:`arrange` measures the largest group. Below ``rows_per_slice`` it keeps the plain window. Above
it, rows are dealt to *slices* by one range partitioning over (keys, order): a slice holds about
``rows_per_slice`` rows, a large key has many slices, small keys share one, and rows of one instant are
split like any others. Where slices are much smaller than what a task can sort, a range has many, so that
tasks and files grow with the table and not with the number of slices. Any orderable type will do, for keys
and order alike. The slices are written to
the shared folder once, sorted, with a number per row that grows along (keys, order), so every branch of
a plan sees the same slices. Two building blocks then give exactly the results of the plain window:

* :meth:`Ordered.framed` for bounded frames. Every slice gets copies of the few rows of its key that come
  just before and after it, windows run per (key, slice), and the copies are dropped. There are at most
  as many copies as slices times the reach of the frame.
* :meth:`Ordered.scan` for unbounded state (positions, running sums, last or next valid value). Slices of
  keys that have several are summarised in one row each, the summaries are scanned per key, and what a
  slice inherits from its neighbours enters it as a seed row before and after its own rows.

What one task holds is a slice with its copies, and one summary row for each slice of a key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tankwise.plans.params import settle
from tankwise.session import stage

ROWS_PER_SLICE_CONF = "spark.tankwise.rowsPerSlice"
ROWS_PER_SLICE = 250_000
#: Of a number given by ``monotonically_increasing_id``, the bits that count rows within a partition.
_ROW_BITS = 33

SLICE = "_slice"
POSITION = "_position"
_ROW, _RANK, _SIDE, _COPY = "_slice_row", "_rank", "_side", "_copy"


def rows_per_slice(df: DataFrame) -> int:
    """Rows one task may order, from the session (default 250,000)."""
    return int(df.sparkSession.conf.get(ROWS_PER_SLICE_CONF, str(ROWS_PER_SLICE)))


@dataclass(frozen=True)
class Ordered:
    """Rows with a declared order within ``keys``; ``split`` tells whether slices are in use, and ``cuts``
    has, for keys in several slices, the first and last row number in each."""

    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    split: bool
    cuts: DataFrame | None = None

    @property
    def _partition(self) -> list[str]:
        return [*self.keys, SLICE] if self.split else list(self.keys)

    def with_rows(self, rows: DataFrame) -> "Ordered":
        """The same arrangement over a frame that kept its rows and its order and key columns."""
        return replace(self, rows=rows)

    def framed(
        self,
        columns: Callable[[WindowSpec], Mapping[str, Column] | list[Mapping[str, Column]]],
        back: int,
        ahead: int = 0,
    ) -> "Ordered":
        """Add window columns whose frames reach ``back`` rows back and ``ahead`` rows forward.

        ``columns`` may return a list of mappings, each of which may use the columns of the ones
        before; ``back`` and ``ahead`` then cover the sum of their frames. Names starting with an
        underscore are dropped at the end when there are several mappings."""
        if not self.split:
            window = Window.partitionBy(*self.keys).orderBy(*self.order)
            return self.with_rows(_in_stages(self.rows, columns(window)))

        # Equal rows may lie in two slices: their numbers keep a copy on its side of the slice's own rows.
        inner = Window.partitionBy(*self._partition).orderBy(*self.order, _ROW)
        own = self.rows.withColumn(_COPY, F.lit(False))
        both = own.unionByName(self._copies(back, ahead))
        return self.with_rows(_in_stages(both, columns(inner)).filter(~F.col(_COPY)).drop(_COPY))

    def _copies(self, back: int, ahead: int) -> DataFrame:
        """The rows of a slice's key within reach before and after it, as rows of that slice.

        Since no slice of a key is empty, at most ``back`` slices before and ``ahead`` after it matter."""
        sides = Window.partitionBy(*self.keys).orderBy(SLICE)
        size = F.col("_last") - F.col("_first") + 1
        upto = F.sum(size).over(sides.rowsBetween(Window.unboundedPreceding, 0))
        cuts = self.cuts.withColumn("_end", upto).withColumn("_start", F.col("_end") - size)
        entry = F.struct(SLICE, "_first", "_last", "_start", "_end")
        start, end = F.col("_start"), F.col("_end")
        near = []
        if back > 0:
            found = F.collect_list(entry).over(sides.rowsBetween(-back, -1))
            found = F.filter(found, lambda x: x["_end"] > start - back)
            low = lambda x: F.greatest(x["_first"], x["_first"] + (start - back - x["_start"]))
            near.append(F.transform(found, lambda x: F.struct(x[SLICE].alias("from"), low(x).alias("low"), x["_last"].alias("high"))))
        if ahead > 0:
            found = F.collect_list(entry).over(sides.rowsBetween(1, ahead))
            found = F.filter(found, lambda x: x["_start"] < end + ahead)
            high = lambda x: F.least(x["_last"], x["_first"] + (end + ahead - 1 - x["_start"]))
            near.append(F.transform(found, lambda x: F.struct(x[SLICE].alias("from"), x["_first"].alias("low"), high(x).alias("high"))))
        if not near:
            return self.rows.filter(F.lit(False)).withColumn(_COPY, F.lit(True))
        cuts = cuts.withColumns({f"_near{i}": found for i, found in enumerate(near)})
        wanted = cuts.select(
            F.col(SLICE).alias("_to"), F.explode(F.concat(*(f"_near{i}" for i in range(len(near))))).alias("_near")
        ).select("_to", F.col("_near.from").alias(SLICE), F.col("_near.low").alias("_low"), F.col("_near.high").alias("_high"))
        copies = self.rows.join(wanted, SLICE).filter(F.col(_ROW).between(F.col("_low"), F.col("_high")))
        return copies.withColumn(SLICE, F.col("_to")).drop("_to", "_low", "_high").withColumn(_COPY, F.lit(True))

    def scan(
        self,
        sums: Mapping[str, Column] | None = None,
        totals: Iterable[str] = (),
        earlier: Iterable[str] = (),
        later: Iterable[str] = (),
    ) -> "Ordered":
        """Add unbounded running state.

        ``_position`` is the 0-based row number within the key. Every name in ``sums`` becomes a
        running sum up to and including the row; names also listed in ``totals`` get the sum over the
        key as ``<name>_total``. A column ``c`` in ``earlier`` gets ``_prev_c``, one in ``later`` gets
        ``_next_c``: ``struct(value, at)`` of the nearest non-null value at or before / at or after
        the row."""
        sums, totals = dict(sums or {}), list(totals)
        earlier, later = list(earlier), list(later)
        rows = self.rows.withColumns({_addend(name): term for name, term in sums.items()})
        by = list(self._partition)
        if self.split:
            rows = self._seeded(rows, list(sums), totals, earlier, later)
            in_order = Window.partitionBy(*by).orderBy(_SIDE, *self.order, _ROW)
            seeded = F.first(POSITION).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
            # A slice without a seed has all rows of its key.
            position = F.coalesce(seeded - 1, F.lit(0)) + F.row_number().over(in_order) - 1
        else:
            in_order = Window.partitionBy(*by).orderBy(*self.order)
            position = F.row_number().over(in_order) - 1
        upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # Backwards from the end: a frame that grows row by row, unlike one that shrinks.
        onward = (
            Window.partitionBy(*by)
            .orderBy(F.desc(POSITION))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        whole = Window.partitionBy(*by)

        rows = rows.withColumn(POSITION, position.cast("long"))
        added: dict[str, Column] = {name: F.sum(_addend(name)).over(upto) for name in sums}
        for name in totals:
            if self.split:
                own_total = F.sum(_addend(name)).over(whole)
                added[f"{name}_total"] = F.coalesce(F.max(f"{name}_total").over(whole), own_total)
            else:
                added[f"{name}_total"] = F.sum(_addend(name)).over(whole)
        for column in dict.fromkeys(earlier + later):
            here = F.when(
                F.col(column).isNotNull(), F.struct(F.col(column).alias("value"), F.col(POSITION).alias("at"))
            )
            if self.split:
                here = F.coalesce(F.col(_carried(column)), here)
            if column in earlier:
                added[f"_prev_{column}"] = F.last(here, ignorenulls=True).over(upto)
            if column in later:
                added[f"_next_{column}"] = F.last(here, ignorenulls=True).over(onward)
        rows = rows.withColumns(added)
        drop = [_addend(name) for name in sums]
        if self.split:
            rows = rows.filter(F.col(_SIDE) == 0)
            drop += [_SIDE, *(_carried(column) for column in earlier + later)]
        return self.with_rows(rows.drop(*drop))

    def _seeded(
        self, rows: DataFrame, sums: list[str], totals: list[str], earlier: list[str], later: list[str]
    ) -> DataFrame:
        """``rows`` plus, per slice of a key with several, a seed row on each side that carries its
        neighbours' state."""
        by = self._partition
        sides = [("max_by", f"_last_{c}", c) for c in earlier] + [("min_by", f"_first_{c}", c) for c in later]
        within = Window.partitionBy(*by).orderBy(*self.order, _ROW)
        slim = rows.select(
            *dict.fromkeys([*by, *self.order, _ROW, *earlier, *later, *(_addend(name) for name in sums)])
        ).withColumn(_RANK, F.row_number().over(within).cast("long") - 1)
        summary = slim.groupBy(*by).agg(
            F.count(F.lit(1)).alias("_rows"),
            *(F.sum(_addend(name)).alias(_addend(name)) for name in sums),
            *(
                F.expr(
                    f"{pick}(struct(`{column}` AS value, {_RANK} AS at), {_RANK})"
                    f" FILTER (WHERE `{column}` IS NOT NULL)"
                ).alias(side)
                for pick, side, column in sides
            ),
        )
        slices = Window.partitionBy(*self.keys).orderBy(SLICE)
        before = slices.rowsBetween(Window.unboundedPreceding, -1)
        after = Window.partitionBy(*self.keys).orderBy(F.desc(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
        key_wide = Window.partitionBy(*self.keys)
        summary = summary.withColumn("_slices", F.count(F.lit(1)).over(key_wide)).filter("_slices > 1")
        summary = summary.withColumn(
            POSITION, F.coalesce(F.sum("_rows").over(before), F.lit(0)).cast("long")
        )
        for _, side, _ in sides:
            moved = F.struct(
                F.col(f"{side}.value").alias("value"), (F.col(f"{side}.at") + F.col(POSITION)).alias("at")
            )
            summary = summary.withColumn(side, F.when(F.col(side).isNotNull(), moved))
        keep = [F.col(name) for name in by]
        head = summary.select(
            *keep,
            POSITION,
            F.lit(-1).alias(_SIDE),
            *(F.sum(_addend(name)).over(before).alias(_addend(name)) for name in sums),
            *(F.sum(_addend(name)).over(key_wide).alias(f"{name}_total") for name in totals),
            *(
                F.last(f"_last_{column}", ignorenulls=True).over(before).alias(_carried(column))
                for column in earlier
            ),
        )
        parts = [rows.withColumn(_SIDE, F.lit(0)), head]
        if later:
            parts.append(
                summary.select(
                    *keep,
                    F.lit(1).alias(_SIDE),
                    *(
                        F.last(f"_first_{column}", ignorenulls=True).over(after).alias(_carried(column))
                        for column in later
                    ),
                )
            )
        seeded = parts[0]
        for part in parts[1:]:
            seeded = seeded.unionByName(part, allowMissingColumns=True)
        return seeded

    def result(self) -> DataFrame:
        """The rows without slice and row numbers."""
        return self.rows.drop(SLICE, _ROW)


def arrange(
    df: DataFrame, order: Iterable[str], keys: Iterable[str] = (), limit: int | None = None
) -> Ordered:
    """Declare the row order of ``df`` and cut slices when a group exceeds ``limit`` rows.

    ``order`` must be a total order within ``keys``; all its columns, and the keys, may be of any type
    that has an order."""
    order, keys = tuple(order), tuple(keys)
    missing = [name for name in (*order, *keys) if name not in df.columns]
    if missing:
        raise ValueError(f"columns not in the input: {', '.join(missing)}")
    limit = limit or rows_per_slice(df)
    largest, total = group_size(df, keys)
    if largest <= limit:
        return Ordered(df, keys, order, split=False)
    rows = _cut(df, order, keys, total, limit)
    sizes = rows.groupBy(*keys, SLICE).agg(F.min(_ROW).alias("_first"), F.max(_ROW).alias("_last"))
    slices = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    cuts = stage(sizes.withColumn("_slices", slices).filter("_slices > 1").drop("_slices"))
    return Ordered(rows, keys, order, split=True, cuts=cuts)


def group_size(df: DataFrame, keys: tuple[str, ...]) -> tuple[int, int]:
    """Rows of the largest group, and of the table."""
    if not keys:
        total = df.count()
        return total, total
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    found = sizes.agg(F.max("size").alias("largest"), F.sum("size").alias("total")).first()
    return found["largest"] or 0, found["total"] or 0


def _cut(df: DataFrame, order: tuple[str, ...], keys: tuple[str, ...], total: int, limit: int) -> DataFrame:
    """``df`` in ranges of (keys, order), written once, with slice and row numbers.

    There are as many ranges as slices, but no more than two a core where these hold about ``ROWS_PER_SLICE``
    rows each or fewer. Rows are then numbered across the ranges, and every ``limit`` of them are a slice."""
    by = list(dict.fromkeys([*keys, *order]))
    slices = max(2, -(-total // limit))
    ranges = min(slices, max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-total // ROWS_PER_SLICE)))
    dealt = df.repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    numbered = dealt.withColumn(_ROW, F.monotonically_increasing_id())
    rows = stage(numbered.withColumn(SLICE, F.shiftright(_ROW, _ROW_BITS)))
    if ranges == slices:
        return rows
    # One row per range.
    sizes = rows.groupBy(SLICE).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1))
    starts, few = settle(sizes.select(F.col(SLICE).alias("_range"), F.coalesce(before, F.lit(0)).alias("_start")))
    joined = rows.join(F.broadcast(starts) if few else starts, F.col(SLICE) == F.col("_range"))
    within = F.col(_ROW).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    across = joined.withColumn(_ROW, F.col("_start") + within)
    return across.withColumn(SLICE, F.floor(F.col(_ROW) / F.lit(limit))).drop("_range", "_start")


def _in_stages(df: DataFrame, columns: Mapping[str, Column] | list[Mapping[str, Column]]) -> DataFrame:
    if not isinstance(columns, list):
        return df.withColumns(dict(columns))
    for stage in columns:
        df = df.select("*", *(column.alias(name) for name, column in stage.items()))
    return df.drop(*(name for stage in columns for name in stage if name.startswith("_")))


def _addend(name: str) -> str:
    return f"_add_{name}"


def _carried(name: str) -> str:
    return f"_carry_{name}"
