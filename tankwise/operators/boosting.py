"""Gradient-boosted trees for any number of classes with one softmax loss.

Columns are cut into bins once. For each level of the trees of one round, every task sums the gradients and
curvatures of its rows per (class, leaf, column, bin), Spark adds the tasks' sums up, and the driver picks
the best cut of every leaf from the table, whose size depends on the model's settings only. Sums are of
whole numbers (multiples of 1 / ``SCALE``), so a fit does not depend on how the rows are dealt out. Rows
never leave the executors; their scores are written to the shared folder every few rounds."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tankwise.session import release, stage

BINS = 32
SCALE = 1 << 20
#: Added to a leaf's curvature.
SHRINK = 1.0
#: Rounds between two writings of the rows' scores.
KEEP = 10
_ACCURACY = 10_000


@dataclass
class Tree:
    """Nodes of a complete tree (children of node i: 2i + 1 and 2i + 2): the column that is cut (-1: a leaf),
    the last bin that goes left, and the value of a leaf."""

    column: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @staticmethod
    def of_depth(depth: int) -> "Tree":
        size = 2 ** (depth + 1) - 1
        return Tree(np.full(size, -1, np.int64), np.zeros(size, np.int64), np.zeros(size))

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row has come to."""
        node = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        for _ in range(len(self.column).bit_length() - 1):
            column = self.column[node]
            further = 2 * node + 1 + (bins[rows, column] > self.cut[node])
            node = np.where(column >= 0, further, node)
        return node


@dataclass
class Boosting:
    """A fitted model: bin borders per column, scores of no tree, and one tree per class and round."""

    edges: list[np.ndarray]
    base: np.ndarray
    rounds: list[list[Tree]] = field(default_factory=list)
    gains: np.ndarray | None = None

    def binned(self, values: np.ndarray) -> np.ndarray:
        """Bins of rows of values; NaN counts as 0."""
        values = np.where(np.isnan(values), 0.0, values)
        columns = [np.searchsorted(edges, values[:, i], "left") for i, edges in enumerate(self.edges)]
        return np.stack(columns, axis=1).astype(np.uint8)

    def scores(self, values: np.ndarray) -> np.ndarray:
        return _added(self.rounds, self.binned(values), np.tile(self.base, (len(values), 1)))

    def probabilities(self, values: Column) -> Column:
        """Probabilities of the classes for an array column of values without nulls."""
        model = self

        @F.arrow_udf("array<double>")
        def shares(column: pa.Array) -> pa.Array:
            rows = _matrix(column, len(model.edges))
            found = softmax(model.scores(rows))
            offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * found.shape[1])
            return pa.ListArray.from_arrays(offsets, pa.array(found.reshape(-1)))

        return shares(values)

    def to_json(self) -> str:
        rounds = [[{k: getattr(t, k).tolist() for k in ("column", "cut", "value")} for t in trees] for trees in self.rounds]
        parts = {"edges": [e.tolist() for e in self.edges], "base": self.base.tolist(), "gains": self.gains.tolist()}
        return json.dumps(parts | {"rounds": rounds})

    @staticmethod
    def from_json(text: str) -> "Boosting":
        parts = json.loads(text)
        rounds = [
            [Tree(np.array(t["column"], np.int64), np.array(t["cut"], np.int64), np.array(t["value"], float)) for t in trees]
            for trees in parts["rounds"]
        ]
        edges = [np.array(e, float) for e in parts["edges"]]
        return Boosting(edges, np.array(parts["base"], float), rounds, np.array(parts["gains"], float))


def softmax(scores: np.ndarray) -> np.ndarray:
    odds = np.exp(scores - scores.max(axis=1, keepdims=True))
    return odds / odds.sum(axis=1, keepdims=True)


def slopes(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the loss for every row and class, in whole multiples of 1 / ``SCALE``."""
    p = softmax(scores)
    gradient = p.copy()
    gradient[np.arange(len(p)), labels] -= 1
    return np.rint(gradient * SCALE), np.rint(p * (1 - p) * SCALE)


def _added(rounds: list[list[Tree]], bins: np.ndarray, scores: np.ndarray) -> np.ndarray:
    scores = scores.copy()
    for trees in rounds:
        for k, tree in enumerate(trees):
            scores[:, k] += tree.value[tree.leaves(bins)]
    return scores


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column; a null within counts as missing."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def _bytes(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in rows], pa.binary())


def _rows_of(batch: pa.RecordBatch, columns: int, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, columns)
    scores = np.frombuffer(b"".join(batch.column("scores").to_pylist()), np.float64).reshape(-1, classes)
    return bins, scores, batch.column("label").to_numpy()


def _binning(model: Boosting):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = model.binned(_matrix(batch.column("values"), len(model.edges)))
            scores = np.tile(model.base, (len(bins), 1))
            yield pa.RecordBatch.from_arrays([_bytes(bins), batch.column("label"), _bytes(scores)], ["bins", "label", "scores"])

    return run


def _rescored(rounds: list[list[Tree]], columns: int, classes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, scores, _ = _rows_of(batch, columns, classes)
            new = _bytes(_added(rounds, bins, scores))
            yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("label"), new], ["bins", "label", "scores"])

    return run


def _histogram(rounds: list[list[Tree]], growing: list[Tree], places: list[np.ndarray], open_leaves: int, columns: int, bins_each: int):
    """Task function: sums per cell (class, open leaf, column, bin) over a task's rows.

    ``places[k][node]`` is the number of an open leaf of class k's tree, -1 for other nodes."""
    classes = len(growing)
    cells = classes * open_leaves * columns * bins_each

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((3, cells), np.int64)
        offsets = np.arange(columns) * bins_each
        for batch in batches:
            bins, scores, labels = _rows_of(batch, columns, classes)
            gradient, curvature = slopes(_added(rounds, bins, scores), labels)
            for k, tree in enumerate(growing):
                leaf = places[k][tree.leaves(bins)]
                use = leaf >= 0
                first = (k * open_leaves + leaf[use]) * columns * bins_each
                cell = (first[:, None] + offsets + bins[use]).reshape(-1)
                for total, value in zip(totals, (gradient[use, k], curvature[use, k], np.ones(int(use.sum())))):
                    total += np.bincount(cell, np.repeat(value, columns), cells).astype(np.int64)
        seen = np.flatnonzero(totals[2])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), *(pa.array(total[seen]) for total in totals)], ["cell", "gradient", "curvature", "n"]
        )

    return run


def best_cuts(gradient: np.ndarray, curvature: np.ndarray, n: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Gain and (column, bin) number of the best cut for tables of shape (leaf, column, bin); gain 0 where no
    cut helps. Ties go to the first column and bin."""
    left_g, left_h, left_n = (t.cumsum(axis=2) for t in (gradient, curvature, n))
    all_g, all_h, all_n = (t[:, :, -1:] for t in (left_g, left_h, left_n))
    right_g, right_h, right_n = all_g - left_g, all_h - left_h, all_n - left_n
    gain = _worth(left_g, left_h) + _worth(right_g, right_h) - _worth(all_g, all_h)
    gain = np.where((left_n >= least) & (right_n >= least), gain, 0.0).reshape(len(gradient), -1)
    gain = np.where(gain > 1e-9, gain, 0.0)
    best = gain.argmax(axis=1)
    return gain[np.arange(len(best)), best], best


def _worth(gradient: np.ndarray, curvature: np.ndarray) -> np.ndarray:
    g, h = gradient / SCALE, curvature / SCALE
    return g * g / (h + SHRINK)


def bin_edges(rows: DataFrame, columns: list[str], bins: int) -> list[np.ndarray]:
    """Borders of at most ``bins`` bins per column, from one aggregate of approximate quantiles."""
    shares = [k / bins for k in range(1, bins)]
    wanted = [F.percentile_approx(F.nanvl(F.col(f"`{c}`"), F.lit(0.0)), shares, _ACCURACY).alias(f"q{i}") for i, c in enumerate(columns)]
    found = rows.agg(*wanted).first()
    return [np.unique(np.array(found[f"q{i}"] or [], float)) for i in range(len(columns))]


def fit_softmax(
    rows: DataFrame,
    columns: list[str],
    label: str,
    classes: int,
    iterations: int = 100,
    rate: float = 0.1,
    depth: int = 5,
    bins: int = BINS,
    least: int = 1,
    edges: list[np.ndarray] | None = None,
) -> Boosting:
    """Fit on the double columns of ``rows``; ``label`` counts classes from 0, and rows without one are left
    out. ``least`` is the fewest rows on either side of a cut."""
    if not 2 <= bins <= 256:
        raise ValueError("2 to 256 bins")
    known = rows.filter(F.col(label).isNotNull())
    edges = bin_edges(known, columns, bins) if edges is None else edges
    counts = dict(known.groupBy(F.col(label).cast("int")).count().collect())  # one row per class
    shares = np.array([counts.get(k, 0) for k in range(classes)], float)
    model = Boosting(edges, np.log(np.maximum(shares, 1e-9) / max(shares.sum(), 1)), [], np.zeros(len(columns)))
    values = known.select(F.array(*(F.col(f"`{c}`") for c in columns)).alias("values"), F.col(label).cast("int").alias("label"))
    schema = "bins binary, label int, scores binary"
    held = stage(values.mapInArrow(_binning(model), schema))
    written = 0
    for done in range(iterations):
        if done - written >= KEEP:
            fresh = stage(held.mapInArrow(_rescored(model.rounds[written:], len(columns), classes), schema))
            release(held)
            held, written = fresh, done
        model.rounds.append(_grown(held, model, written, classes, rate, depth, bins, least))
    release(held)
    return model


def _grown(held: DataFrame, model: Boosting, written: int, classes: int, rate: float, depth: int, bins: int, least: int) -> list[Tree]:
    """The next round's trees, level by level."""
    trees = [Tree.of_depth(depth) for _ in range(classes)]
    leaves = [[0] for _ in range(classes)]  # nodes that may still be cut
    damped = rate * (classes - 1) / classes
    columns = len(model.edges)
    for level in range(depth):
        most = max(map(len, leaves))
        if not most:
            break
        places = [np.full(len(trees[0].column), -1, np.int64) for _ in range(classes)]
        for k, nodes in enumerate(leaves):
            places[k][nodes] = np.arange(len(nodes))
        task = _histogram(model.rounds[written:], trees, places, most, columns, bins)
        cells = held.mapInArrow(task, "cell long, gradient long, curvature long, n long")
        summed = cells.groupBy("cell").agg(*(F.sum(c).alias(c) for c in ("gradient", "curvature", "n"))).toArrow()
        table = np.zeros((3, classes * most * columns * bins), np.int64)
        for i, name in enumerate(("gradient", "curvature", "n")):
            table[i, summed.column("cell").to_numpy()] = summed.column(name).to_numpy()
        table = table.reshape(3, classes, most, columns, bins)
        for k, tree in enumerate(trees):
            nodes = leaves[k]
            if not nodes:
                continue
            g, h, n = table[:, k, : len(nodes)]
            gains, cuts = best_cuts(g, h, n, least)
            leaves[k] = []
            for i, node in enumerate(nodes):
                tree.value[node] = _leaf(g[i, 0].sum(), h[i, 0].sum(), damped)
                if gains[i] <= 0:
                    continue
                column, cut = divmod(int(cuts[i]), bins)
                tree.column[node], tree.cut[node] = column, cut
                model.gains[column] += gains[i]
                for child, part in ((2 * node + 1, slice(0, cut + 1)), (2 * node + 2, slice(cut + 1, bins))):
                    tree.value[child] = _leaf(g[i, column, part].sum(), h[i, column, part].sum(), damped)
                    if level + 1 < depth:
                        leaves[k].append(child)
    return trees


def _leaf(gradient: int, curvature: int, damped: float) -> float:
    return float(-damped * (gradient / SCALE) / (curvature / SCALE + SHRINK))
