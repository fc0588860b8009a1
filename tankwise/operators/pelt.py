"""Optimal partitioning of each series into pieces of constant mean (PELT).

The cost of a partition is the sum of squared deviations from the pieces' means and a penalty for each piece
after the first. The best cost up to a row is the least, over the rows at which the last piece may begin, of
the best cost before that row and the piece's own; beginnings that can never be best again are dropped. Rows
of a key are streamed in order, so a task holds the live beginnings of one series and what leads to each,
not its rows. The recursion is serial: a key's rows are one stream, whatever their number."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Partition:
    """The recursion over one series."""

    def __init__(self, penalty: float) -> None:
        self.penalty = penalty
        self.n, self.total, self.squares = 0, 0.0, 0.0
        # Of every live beginning: best cost before it, rows, sum and squares before it, and its chain.
        self.cost = np.array([-penalty])
        self.before = np.zeros((1, 3))
        self.chains: list[tuple | None] = [None]
        self.starts: list = [None]  # the row at the last beginning, filled in when it comes
        self.most = 1

    def add(self, value: float, row) -> None:
        if self.starts[-1] is None:
            self.starts[-1] = row
        self.n += 1
        self.total += value
        self.squares += value * value
        rows = self.n - self.before[:, 0]
        sums = self.total - self.before[:, 1]
        own = self.squares - self.before[:, 2] - sums * sums / rows
        through = self.cost + own
        best = int(through.argmin())  # the earliest of equals
        # What costs more than the best with one more piece can't win any more. The slack keeps those whose
        # cost differs by rounding only.
        kept = np.flatnonzero(through <= through[best] + self.penalty + 1e-9 * (1 + abs(self.squares)))
        chain = (self.chains[best], self.starts[best], tuple(self.before[best]))
        self.cost = np.append(self.cost[kept], through[best] + self.penalty)
        self.before = np.concatenate([self.before[kept], [[self.n, self.total, self.squares]]])
        self.chains = [self.chains[k] for k in kept] + [chain]
        self.starts = [self.starts[k] for k in kept] + [None]
        self.most = max(self.most, len(kept) + 1)

    def pieces(self) -> Iterator[tuple[object, int, float, float]]:
        """(row at the beginning, rows before it, rows, mean) of the best partition's pieces."""
        found, chain = [], self.chains[-1]
        end = (self.n, self.total, self.squares)
        while chain is not None:
            chain, row, before = chain
            rows = end[0] - before[0]
            found.append((row, int(before[0]), int(rows), (end[1] - before[1]) / rows))
            end = before
        yield from reversed(found)

    def best(self) -> float:
        """Cost of the best partition, penalties included."""
        return float(self.cost[-1])


def segments(df: DataFrame, order: Iterable[str], column: str, keys: Iterable[str], penalty: float) -> DataFrame:
    """One row per piece: ``keys``, ``idx`` (rows of the series before it), the order columns of its first row,
    ``rows``, ``mean``, and of the whole series ``cost`` and ``candidates`` (the most beginnings held).

    Rows without a value (NULL or NaN) are passed over and not counted. The rows at which a piece with
    ``idx > 0`` begins are the changepoints. The partition is exact; of equal ones that with the earlier
    beginnings is taken. A series that hardly changes keeps more beginnings, at worst all of them."""
    order, keys = list(order), list(keys)
    if not keys:
        raise ValueError("PELT works on keyed series: each is one stream of rows")
    if penalty <= 0:
        raise ValueError("the penalty has to be positive")
    value = F.col(column).cast("double")
    series = df.select(*dict.fromkeys([*keys, *order]), value.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    dealt = series.repartition(*keys).sortWithinPartitions(*keys, *order)
    outs = [f for f in dealt.schema.fields if f.name != "_x"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outs)
    schema += ", idx long, rows long, mean double, cost double, candidates long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, partition = None, None
        for batch in batches:
            held = zip(*(batch.column(f.name).to_pylist() for f in outs))
            places = zip(*(batch.column(k).to_pylist() for k in keys))
            for place, row, x in zip(places, held, batch.column("_x").to_pylist()):
                if partition is None or place != current:
                    if partition is not None:
                        yield made(partition, batch.schema)
                    current, partition = place, Partition(penalty)
                partition.add(x, row)
        if partition is not None:
            yield made(partition, batch.schema)

    def made(partition: Partition, kinds: pa.Schema) -> pa.RecordBatch:
        rows, idx, counts, means = zip(*partition.pieces())
        firsts = [pa.array(values, kinds.field(f.name).type) for f, values in zip(outs, zip(*rows))]
        n = len(rows)
        tail = [pa.array(idx, pa.int64()), pa.array(counts, pa.int64()), pa.array(means, pa.float64())]
        tail += [pa.array([partition.best()] * n), pa.array([partition.most] * n, pa.int64())]
        return pa.RecordBatch.from_arrays([*firsts, *tail], [f.name for f in outs] + ["idx", "rows", "mean", "cost", "candidates"])

    return dealt.mapInArrow(run, schema)
