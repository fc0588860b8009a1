"""Nearest rows against all distances."""

import numpy as np
import pytest

from tankwise.operators.neighbours import _candidates, nearest_rows


def expected(rows, k):
    found = set()
    for i, label, vector in rows:
        near = sorted((float(np.sqrt(((np.array(vector) - np.array(v)) ** 2).sum())), j) for j, l, v in rows if j != i and l == label)
        found |= {(i, j, place + 1, round(d, 9)) for place, (d, j) in enumerate(near[:k])}
    return found


def got(df):
    return {(r["id"], r["neighbour"], r["place"], round(r["distance"], 9)) for r in df.collect()}


SCHEMA = "id long, label string, v array<double>, key string, cell int, within int, far string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA).repartition(5)


def made(n, seed, dims=3, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 3, (6, dims))
    return [
        (i, [None, "a", "b"][i % 3] if i % 7 else "hot", np.round(centres[i % 6] + rng.normal(0, spread, dims), 2).tolist()) for i in range(n)
    ]


@pytest.mark.parametrize("pivots, block", [(1, 15), (8, 15), (40, 2_000)])
def test_equals_all_distances(spark, pivots, block):
    rows = made(240, pivots)
    rows += [(1_000 + k, "a", rows[1][2]) for k in range(40)]  # copies of one vector
    rows += [(2_000, "alone", [0.0, 0.0, 0.0]), (2_001, "two", [0.0, -0.0, 1.0]), (2_002, "two", [0.0, 0.0, 1.0])]
    assert got(nearest_rows(frame(spark, rows), "id", "v", 4, "label", pivots, block)) == expected(rows, 4)


def test_whole_table_and_ties(spark):
    rows = [(x * 10 + y, None, [float(x), float(y), 0.0]) for x in range(10) for y in range(10)]
    assert got(nearest_rows(frame(spark, rows), "id", "v", 3, None, 9, 20)) == expected(rows, 3)


def test_odd_vectors_are_left_out(spark):
    rows = [(1, "a", [1.0, 0.0, 0.0]), (2, "a", [2.0, 0.0, 0.0]), (3, "a", None), (4, "a", [float("nan"), 0.0, 0.0]), (5, "a", [None, 0.0, 0.0])]
    assert got(nearest_rows(frame(spark, rows), "id", "v", 2, "label")) == {(1, 2, 1, 1.0), (2, 1, 1, 1.0)}
    assert nearest_rows(frame(spark, rows).limit(0), "id", "v").collect() == []


def test_cells_are_pruned(spark):
    """With well separated groups few entries are compared outside their own cell."""
    from tankwise.operators import neighbours

    rows = [(i, None, [100.0 * (i % 8) + (i // 8) * 0.01, 0.0, 0.0]) for i in range(400)]
    asked = []
    original = neighbours._searched

    def counted(queries, entries, k, block):
        asked.append(queries.count())
        return original(queries, entries, k, block)

    neighbours._searched = counted
    try:
        assert got(nearest_rows(frame(spark, rows), "id", "v", 3, None, 60)) == expected(rows, 3)
    finally:
        neighbours._searched = original
    assert asked[0] == 400 and asked[1] < 400 * 60 * 0.2


def test_few_pairs_are_compared_exactly():
    """The product of matrices leaves about k pairs a query, among them all nearest, also where it rounds."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=(400, 16))
    kinds = {"plain": base, "ties": np.round(base * 0.5), "far off": base + 1e6, "tiny": base * 1e-160, "overflow": base * 1e160}
    for kind, y in kinds.items():
        x, own = y[100:], np.arange(100, 400)
        pairs = [(s + a, b) for s, at, best in _candidates(x, y, own, 5) for a, b in zip(at, best)]
        with np.errstate(all="ignore"):
            far = np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2))
        far[np.arange(300), own] = np.inf
        nearest = {(i, j) for i in range(300) for j in np.argsort(far[i], kind="stable")[:5]}
        assert nearest <= set(pairs) and len(pairs) == len(set(pairs)), kind
        assert not any(own[i] == j for i, j in pairs)
        assert kind != "plain" or len(pairs) == 5 * 300
