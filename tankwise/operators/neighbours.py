"""Exact nearest rows by Euclidean distance, with cells around pivots.

Equal vectors are one entry with its least ids, so that copies of one vector are not compared with each
other. Every entry belongs to the nearest of a bounded number of pivots. Its own cell gives an upper bound of
the distance wanted; by the triangle inequality only cells that can hold something as near are searched
afterwards. Cells are searched in blocks of bounded size, each of which returns ``k`` rows per query: a product
of matrices leaves out the pairs that are certainly farther, and the others' distances are computed exactly."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tankwise.plans.params import settle
from tankwise.session import release, stage

PIVOTS = 128
#: Entries of a cell, or queries to it, that one task compares at a time.
BLOCK = 2_000
_SLACK = 1e-9
_CHUNK = 1 << 22  # numbers in a table of differences
_SMALLEST = 1e-300  # far more than what is lost where squares are too small for a double


def _table(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _distances(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, distances of some rows of ``x`` to all of ``y``)."""
    rows = max(1, _CHUNK // max(y.size, 1))
    for start in range(0, len(x), rows):
        part = x[start : start + rows, None, :] - y[None, :, :]
        yield start, np.sqrt((part * part).sum(axis=2))


def _placing(pivots: np.ndarray):
    """Task function: the distances of entries to all pivots, the nearest one and the distance to it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = np.empty((len(batch), len(pivots)))
            for start, part in _distances(_table(batch.column("vector")), pivots):
                far[start : start + len(part)] = part
            cell = far.argmin(axis=1) if len(far) else np.zeros(0, np.int64)
            offsets = pa.array(np.arange(len(far) + 1, dtype=np.int32) * len(pivots))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in ("within", "key", "vector")),
                    pa.array(cell.astype(np.int32)),
                    pa.array(far[np.arange(len(far)), cell]),
                    pa.ListArray.from_arrays(offsets, pa.array(far.reshape(-1))),
                ],
                ["within", "key", "vector", "cell", "near", "far"],
            )

    return run


def _candidates(x: np.ndarray, y: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, rows, entries): for some rows of ``x`` at a time all entries of ``y``, but their own, that can
    be among the ``k`` nearest.

    Squares of distances come from one product of matrices. How far rounding can move them is added as a
    margin, so that no pair is left out whose exact distance counts; without a finite margin all pairs are."""
    with np.errstate(all="ignore"):
        long_x, long_y = (x * x).sum(axis=1), (y * y).sum(axis=1)
        top = long_y.max()
        step = max(1, _CHUNK // len(y))
        for start in range(0, len(x), step):
            mine = own[start : start + step]
            here = long_x[start : start + step, None]
            rough = here + long_y - 2 * (x[start : start + step] @ y.T)
            # Each of the sums errs by less than its number of terms times 2 ** -53 of the sum of lengths.
            margin = (here[:, 0] + top) * (8 * (x.shape[1] + 8) * 2.0**-53) + _SMALLEST
            use = np.ones(rough.shape, bool)
            if len(y) > k + 1:
                rough[np.flatnonzero(mine >= 0), mine[mine >= 0]] = np.inf
                kth = np.partition(rough, k - 1, axis=1)[:, k - 1]
                limit = kth + 2 * margin
                use = rough <= np.where(np.isfinite(limit), limit, np.inf)[:, None]
                use[~np.isfinite(rough).any(axis=1) | ~np.isfinite(margin)] = True
            use[np.flatnonzero(mine >= 0), mine[mine >= 0]] = False
            yield start, *np.nonzero(use)


def _nearest(k: int):
    """Group function over the queries and entries of two blocks: the ``k`` nearest other entries of each
    query, ties by key."""

    def run(table: pa.Table) -> pa.Table:
        asked, held = (table.filter(pa.array(table.column("asks").to_numpy() == side)) for side in (True, False))
        keys = held.column("key").combine_chunks()
        order = pa.compute.array_sort_indices(keys)
        held, keys = held.take(order), keys.take(order)
        rows, places, found = [], [], []
        if len(asked) and len(held):
            own = pa.compute.index_in(asked.column("key").combine_chunks(), keys).fill_null(-1).to_numpy()
            x, y = _table(asked.column("vector")), _table(held.column("vector"))
            for start, at, best in _candidates(x, y, own, k):
                value = np.empty(len(at))
                for first in range(0, len(at), step := max(1, _CHUNK // max(y.shape[1], 1))):
                    some = slice(first, first + step)
                    part = x[start + at[some]] - y[best[some]]
                    value[some] = np.sqrt((part * part).sum(axis=1))
                use = np.isfinite(value)
                at, best, value = at[use], best[use], value[use]
                # The nearest of each query, ties by key, which is the order of the entries.
                order = np.lexsort((best, value, at))
                at, best, value = at[order], best[order], value[order]
                use = np.arange(len(at)) - np.searchsorted(at, at, "left") < k
                rows.append(at[use] + start)
                places.append(best[use])
                found.append(value[use])
        rows, places = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in (rows, places))
        return pa.table(
            {
                "within": asked.column("within").take(pa.array(rows)),
                "key": asked.column("key").take(pa.array(rows)),
                "other": keys.take(pa.array(places)),
                "distance": pa.array(np.concatenate(found) if found else np.zeros(0)),
            }
        )

    return run


def _searched(queries: DataFrame, entries: DataFrame, k: int, block: int) -> DataFrame:
    """``within, key, other, distance``: the ``k`` nearest of each query in each pair of blocks."""
    cells = ["within", "cell"]

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(*cells).agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias(name))

    a, b = blocks(queries, "asking").alias("a"), blocks(entries, "holding").alias("b")
    sizes = a.join(b, _same("a", "b", cells)).select("a.*", "b.holding")
    sizes, few = settle(sizes)
    sizes = F.broadcast(sizes) if few else sizes

    def dealt(rows: DataFrame, asks: bool) -> DataFrame:
        mine, others = ("asking", "holding") if asks else ("holding", "asking")
        joined = rows.alias("r").join(sizes.alias("s"), _same("r", "s", cells)).select("r.*", "s.asking", "s.holding")
        own = F.pmod(F.xxhash64("key"), F.col(mine)).cast("int")
        spread = joined.select(*cells, "key", "vector", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias("to"))
        place = ("own", "to") if asks else ("to", "own")
        return spread.select(*cells, "key", "vector", F.lit(asks).alias("asks"), *(F.col(p).alias(n) for p, n in zip(place, ("i", "j"))))

    both = dealt(queries, True).unionByName(dealt(entries, False))
    kinds = {f.name: f.dataType.simpleString() for f in entries.schema.fields}
    schema = f"within {kinds['within']}, key {kinds['key']}, other {kinds['key']}, distance double"
    return both.groupBy(*cells, "i", "j").applyInArrow(_nearest(k), schema)


def _same(x: str, y: str, columns: Iterable[str]) -> Column:
    """Equality of columns of two aliased frames, null being equal to null."""
    terms = [F.col(f"{x}.{c}").eqNullSafe(F.col(f"{y}.{c}")) for c in columns]
    whole = terms[0]
    for term in terms[1:]:
        whole = whole & term
    return whole


def _first(rows: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """The ``k`` first rows per group; every task passes on at most that many of a group."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("place", place).filter(F.col("place") <= k)


def nearest_rows(
    df: DataFrame, id: str, vector: str, k: int = 5, within: str | None = None, pivots: int = PIVOTS, block: int = BLOCK
) -> DataFrame:
    """``id, neighbour, place, distance``: the ``k`` rows of smallest distance to each row, itself left out, within
    the rows of the same ``within`` value (null being one of them).

    Exact; ties go to the smaller id. Ids have to be unique and not null, vectors of one length; rows whose
    vector is null, or holds a null or NaN, are left out on both sides. Groups of fewer than ``k`` other rows
    give fewer neighbours. At most ``pivots`` vectors pass through the driver."""
    group = F.col(f"`{within}`") if within else F.lit(0)
    values = F.col(f"`{vector}`").cast("array<double>")
    rows = df.select(group.alias("within"), F.col(f"`{id}`").alias("key"), values.alias("vector"))
    # A vector with a negative zero equals that with a positive one.
    rows = rows.filter(F.col("vector").isNotNull() & ~F.exists("vector", lambda v: v.isNull() | F.isnan(v)))
    rows = rows.withColumn("vector", F.transform("vector", lambda v: v + F.lit(0.0)))

    firsts = _first(rows, ["within", "vector"], ["key"], k + 1)
    gathered = firsts.groupBy("within", "vector").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    same = stage(gathered.withColumn("key", F.col("keys")[0]))

    drawn = same.select("vector", "key").orderBy(F.xxhash64("key"), "key").limit(pivots).collect()
    if not drawn:
        release(same)
        return _expanded(rows, same, None, id, k)
    centres = np.array([row["vector"] for row in drawn], float)
    kinds = {f.name: f.dataType.simpleString() for f in same.schema.fields}
    schema = f"within {kinds['within']}, key {kinds['key']}, vector array<double>, cell int, near double, far array<double>"
    placed = stage(same.select("within", "key", "vector").mapInArrow(_placing(centres), schema))

    inner = stage(_searched(placed, placed, k, block))
    bound = _first(inner, ["within", "key"], ["distance", "other"], k).groupBy("within", "key").agg(
        F.max("distance").alias("reach"), F.count(F.lit(1)).alias("found")
    )
    known = placed.alias("p").join(bound.alias("b"), _same("p", "b", ["within", "key"]), "left").select(
        "p.*", F.when(F.col("b.found") >= k, F.col("b.reach")).otherwise(float("inf")).alias("reach")
    )
    # Per group at most one row per pivot: the ring around it in which the cell's entries lie.
    rings = placed.groupBy("within", "cell").agg(F.min("near").alias("low"), F.max("near").alias("high"))
    rings = rings.groupBy("within").agg(F.collect_list(F.struct("cell", "low", "high")).alias("rings"))
    few, small = settle(rings)
    few = F.broadcast(few) if small else few
    told = known.alias("k").join(few.alias("r"), _same("k", "r", ["within"])).select("k.*", F.explode("r.rings").alias("ring"))
    away = F.col("far")[F.col("ring.cell")]
    least = F.greatest(away - F.col("ring.high"), F.col("ring.low") - away, (away - F.col("near")) / 2)
    more = told.filter((F.col("ring.cell") != F.col("cell")) & (least <= F.col("reach") * (1 + _SLACK) + _SLACK))
    outer = _searched(more.select("within", F.col("ring.cell").alias("cell"), "key", "vector"), placed, k, block)

    best = _first(inner.unionByName(outer), ["within", "key"], ["distance", "other"], k)
    return _expanded(rows, same, best.select("within", "key", "other", "distance"), id, k)


def _expanded(rows: DataFrame, same: DataFrame, best: DataFrame | None, id: str, k: int) -> DataFrame:
    """Neighbours of every row, from those of the entries."""
    own = same.select("within", "key", F.lit(0.0).alias("distance"), "keys")
    found = own
    if best is not None:
        others = best.alias("b").join(same.alias("s"), _same("b", "s", ["within"]) & (F.col("b.other") == F.col("s.key")))
        found = own.unionByName(others.select("b.within", "b.key", "b.distance", "s.keys"))
    # At most k + 1 entries of at most k + 1 ids each.
    each = found.select("within", "key", F.explode(F.transform("keys", lambda n: F.struct(F.col("distance"), n.alias("neighbour")))).alias("c"))
    lists = each.groupBy("within", "key").agg(F.slice(F.array_sort(F.collect_list("c")), 1, k + 1).alias("list"))
    named = same.alias("s").join(lists.alias("l"), _same("s", "l", ["within", "key"])).select("s.within", "s.vector", "l.list")
    joined = rows.alias("r").join(named.alias("n"), _same("r", "n", ["within"]) & (F.col("r.vector") == F.col("n.vector")))
    mine = F.slice(F.filter("n.list", lambda c: c["neighbour"] != F.col("r.key")), 1, k)
    chosen = joined.select(F.col("r.key").alias(id), F.posexplode(mine).alias("place", "c"))
    return chosen.select(id, F.col("c.neighbour").alias("neighbour"), (F.col("place") + 1).alias("place"), F.col("c.distance").alias("distance"))
