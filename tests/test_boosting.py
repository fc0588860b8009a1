"""Softmax boosting against a plain numpy version, tree by tree."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tankwise.operators import boosting, models


def plain_fit(values, labels, edges, classes, iterations, rate, depth, least=1):
    """Row by row and cut by cut; returns (column, cut, value) per node of every tree."""
    bins = np.array([[int(np.sum(np.array(edges[c]) < v)) for c, v in enumerate(row)] for row in values])
    counts = np.array([(labels == k).sum() for k in range(classes)], float)
    scores = np.tile(np.log(counts / counts.sum()), (len(values), 1))
    rounds = []
    for _ in range(iterations):
        gradient, curvature = boosting.slopes(scores, labels)
        gradient, curvature = gradient / boosting.SCALE, curvature / boosting.SCALE
        trees = []
        for k in range(classes):
            nodes = {}

            def grow(node, rows, level):
                g, h = gradient[rows, k].sum(), curvature[rows, k].sum()
                value = -rate * (classes - 1) / classes * g / (h + boosting.SHRINK)
                best = (1e-9, None)
                if level < depth:
                    for c in range(values.shape[1]):
                        for cut in range(boosting.BINS):
                            left = rows[bins[rows, c] <= cut]
                            right = rows[bins[rows, c] > cut]
                            if len(left) < least or len(right) < least:
                                continue
                            gain = sum(
                                gradient[side, k].sum() ** 2 / (curvature[side, k].sum() + boosting.SHRINK) for side in (left, right)
                            ) - g**2 / (h + boosting.SHRINK)
                            if gain > best[0] + 1e-12:
                                best = (gain, (c, cut, left, right))
                if best[1] is None:
                    nodes[node] = (-1, 0, value)
                    scores[rows, k] += value
                    return
                c, cut, left, right = best[1]
                nodes[node] = (c, cut, value)
                grow(2 * node + 1, left, level + 1)
                grow(2 * node + 2, right, level + 1)

            grow(0, np.arange(len(values)), 0)
            trees.append(nodes)
        rounds.append(trees)
    return rounds, scores


@pytest.fixture(scope="module")
def made(spark):
    rng = np.random.default_rng(4)
    values = np.round(rng.normal(0, 1, (160, 3)), 2)
    labels = ((values[:, 0] > 0).astype(int) + (values[:, 1] + rng.normal(0, 0.4, 160) > 0.5)).astype(int)
    values[::13, 2] = np.nan
    rows = [(int(y), *map(float, v)) for y, v in zip(labels, values)]
    return values, labels, spark.createDataFrame(rows, "label int, a double, b double, c double")


@pytest.mark.parametrize("least", [1, 12])
def test_equals_plain_version(made, least, monkeypatch):
    monkeypatch.setattr(boosting, "KEEP", 2)
    values, labels, frame = made
    model = boosting.fit_softmax(frame.repartition(5), ["a", "b", "c"], "label", 3, iterations=5, rate=0.3, depth=2, least=least)
    filled = np.where(np.isnan(values), 0.0, values)
    rounds, scores = plain_fit(filled, labels, model.edges, 3, 5, 0.3, 2, least)
    for mine, plain in zip(model.rounds, rounds, strict=True):
        for tree, nodes in zip(mine, plain, strict=True):
            for node, (column, cut, value) in nodes.items():
                assert tree.column[node] == column
                assert column < 0 or tree.cut[node] == cut
                assert tree.value[node] == pytest.approx(value, abs=1e-9)
    assert model.scores(values) == pytest.approx(scores, abs=1e-9)


def test_fit_does_not_depend_on_partitions(made):
    _, _, frame = made
    fits = [
        boosting.fit_softmax(part, ["a", "b"], "label", 3, iterations=3, depth=3, edges=[np.array([-1.0, 0.0, 1.0])] * 2).to_json()
        for part in (frame.coalesce(1), frame.repartition(7), frame.orderBy("b"))
    ]
    assert fits[0] == fits[1] == fits[2]


def test_rows_without_label_and_odd_columns(spark):
    rows = [(None, 5.0, 1.0), (0, 0.0, 1.0), (0, None, 1.0), (1, float("inf"), 1.0), (1, 9.0, 1.0), (2, -float("inf"), 1.0), (2, -9.0, 1.0)]
    frame = spark.createDataFrame(rows * 3, "label int, v double, same double")
    model = models.fit_boosted(frame, "label", ["v", "same"], iterations=20, rate=0.5, depth=2)
    got = model.predict(frame).select("label", "predicted", "probabilities").collect()
    assert all(r["predicted"] == r["label"] for r in got if r["label"] is not None)
    assert all(sum(r["probabilities"]) == pytest.approx(1) for r in got) and len(got) == 21
    assert model.importances(spark).filter(F.col("feature") == "same").first()["importance"] == 0


def test_loss_falls_with_rounds(made):
    values, labels, frame = made
    model = boosting.fit_softmax(frame, ["a", "b"], "label", 3, iterations=12, depth=2)
    losses = []
    for n in (1, 4, 12):
        part = boosting.Boosting(model.edges, model.base, model.rounds[:n], model.gains)
        p = boosting.softmax(part.scores(values[:, :2]))
        losses.append(-np.log(p[np.arange(len(p)), labels]).mean())
    assert losses[0] > losses[1] > losses[2]
