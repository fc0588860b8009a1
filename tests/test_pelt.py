"""Optimal partitioning against the recursion without pruning."""

import numpy as np
import pytest

from tankwise.operators.changepoints import partitioned
from tankwise.operators.pelt import Partition, segments


def plain(values, penalty):
    """All best costs, and the beginnings of the best pieces."""
    n = len(values)
    s, q = np.append(0, np.cumsum(values)), np.append(0, np.cumsum(np.square(values)))
    best, back = [-penalty], [0]
    for t in range(1, n + 1):
        costs = [best[k] + q[t] - q[k] - (s[t] - s[k]) ** 2 / (t - k) for k in range(t)]
        back.append(int(np.argmin(costs)))
        best.append(min(costs) + penalty)
    starts, t = [], n
    while t:
        starts.append(back[t])
        t = back[t]
    return best[n], starts[::-1]


def series(seed, n=200):
    rng = np.random.default_rng(seed)
    levels = np.repeat(rng.integers(0, 6, n // 20), 20)[:n]
    return np.round(levels + rng.normal(0, 0.5, n), 3)


@pytest.mark.parametrize("seed", range(5))
def test_pruned_equals_unpruned(seed):
    values = series(seed)
    for penalty in (0.5, 3.0, 50.0):
        partition = Partition(penalty)
        for k, v in enumerate(values):
            partition.add(float(v), k)
        cost, starts = plain(values, penalty)
        assert partition.best() == pytest.approx(cost) and [p[0] for p in partition.pieces()] == starts
        assert [p[1] for p in partition.pieces()] == starts and sum(p[2] for p in partition.pieces()) == len(values)
    short = Partition(3.0)
    for k, v in enumerate(np.tile(series(9), 10)):
        short.add(float(v), k)
    assert short.most < 500  # of 2,000 rows: beginnings are dropped


def test_constant_and_single_rows():
    flat = Partition(1.0)
    for k in range(50):
        flat.add(7.0, k)
    assert [p[0] for p in flat.pieces()] == [0] and flat.best() == pytest.approx(0)


def test_segments_per_key(spark):
    rows, want = [], {}
    for key in ("a", "b", None, "long"):
        values = series(len(str(key)), 600 if key == "long" else 100)
        want[key] = plain(values, 4.0)[1]
        rows += [(key, k, float(v)) for k, v in enumerate(values)]
    rows += [("a", 50, None), ("b", 20, float("nan")), ("only missing", 1, None), ("one", 1, 5.0)]
    frame = spark.createDataFrame(rows, "tank string, ts long, x double").repartition(5)
    found = segments(frame, ["ts"], "x", ["tank"], 4.0).collect()
    got = {}
    for r in sorted(found, key=lambda r: r["idx"]):
        got.setdefault(r["tank"], []).append(r["idx"])
    assert got == want | {"one": [0]}
    assert all(r["ts"] == r["idx"] for r in found if r["tank"] not in ("one",))
    changes = partitioned(frame, ["ts"], "x", ["tank"], 4.0).collect()
    assert len(changes) == sum(len(v) - 1 for v in want.values()) and all(r["idx"] > 0 for r in changes)
    assert segments(frame.limit(0), ["ts"], "x", ["tank"], 4.0).collect() == []


def test_settings(spark):
    with pytest.raises(ValueError, match="keyed"):
        segments(spark.range(3), ["id"], "id", [], 1.0)
    with pytest.raises(ValueError, match="positive"):
        segments(spark.range(3), ["id"], "id", ["id"], 0.0)
