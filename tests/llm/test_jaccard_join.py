import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tankwise.llm import jaccard_join
from tankwise.llm.components import components
from tankwise.llm.jaccard_join import Tree, keep_first, near_duplicates, prefix_length, tree_join
from tests.llm.frames import changed, docs, found, rows, text


def shingles(t, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not words:
        return set()
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))}


def expected(pairs, percent=75, size=5):
    sets = [shingles(t, size) for _, t in pairs]
    root = list(range(len(pairs)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(pairs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(pairs):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return sorted(((i, len(s), least.get(top(k))) for k, ((i, _), s) in enumerate(zip(pairs, sets))), key=repr)


def corpus():
    """Chains of near copies, copies of copies, and passages that many texts share."""
    shared = text(50, 60)
    pairs = [(1_000 + k, changed(text(60, 150), 70, k)) for k in range(25)]
    chain = text(61, 200)
    for k in range(8):
        pairs.append((2_000 + k, chain))
        chain = " ".join([*chain.split(" ")[8:], *text(70 + k, 8).split(" ")])
    pairs += [(3_000 + k, text(100 + k, 70) + " " + shared) for k in range(30)]
    pairs += [(4_000 + k, shared + " " + text(200, 15 + 3 * k)) for k in range(12)]
    return pairs + rows()


@pytest.mark.parametrize("block", [3, 2_000])
def test_equals_brute_force(spark, block):
    pairs = corpus()
    got = found(near_duplicates(docs(spark, pairs).repartition(5), block=block), "doc_id", "n_shingles", "component_id")
    assert got == expected(pairs)


def test_other_thresholds(spark):
    pairs = corpus()[:60]
    got = found(near_duplicates(docs(spark, pairs), size=3, percent=40), "doc_id", "n_shingles", "component_id")
    assert got == expected(pairs, 40, 3)


def test_boundary_of_the_threshold(spark):
    """Exactly 75 of 100 links, 74 of 100 doesn't."""
    words = [f"w{k}" for k in range(200)]
    pairs = [(1, " ".join(words[:92])), (2, " ".join(words[:79] + words[100:109])), (3, " ".join(words[:78] + words[120:130]))]
    assert found(near_duplicates(docs(spark, pairs)), "doc_id", "n_shingles", "component_id") == expected(pairs)


def test_one_of_each_component_stays(spark):
    pairs = [(i, t) for i, t in corpus() if i is not None and i != 14]
    frame = docs(spark, pairs)
    kept = keep_first(frame)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _, root in expected(pairs) if i == root}


def test_one_of_each_component_stays_under_null_and_shared_ids(spark):
    base, lone = text(81, 120), text(82, 90)
    near = [changed(base, 60, k) for k in range(4)]
    alike = [changed(lone, 45, k) for k in range(3)]
    pairs = [(None, base), (None, near[0]), (7, near[1]), (7, near[2]), (9, near[3]), (9, near[3])]
    pairs += [(7, text(83, 40)), (None, text(84, 40)), (None, None), (None, ""), (7, "")]
    pairs += [(None, lone), (None, lone), *((None, t) for t in alike)]
    pairs += [(20, text(85, 50)), (20, text(85, 50))]
    kept = [(r["doc_id"], r["text"]) for r in keep_first(docs(spark, pairs)).collect()]
    least = min(near[1:3], key=lambda t: hashlib.sha256(t.encode()).digest())
    first = min([lone, *alike], key=lambda t: hashlib.sha256(t.encode()).digest())
    want = [(7, least), (None, first), *pairs[6:11], pairs[-1]]
    assert sorted(kept, key=repr) == sorted(want, key=repr)


def test_texts_that_stay_are_not_dealt_out(spark):
    """Only rows whose digest may be one of those that go are joined; the others come out where they are read."""
    pairs = [(i, t) for i, t in corpus() if i is not None and i != 14]
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = keep_first(docs(spark, pairs))
        top = kept._jdf.queryExecution().executedPlan().initialPlan()
        while top.children().size() == 1:
            assert top.nodeName() != "Exchange"
            top = top.children().head()
        sides = [top.children().apply(k).toString() for k in range(top.children().size())]
        assert top.nodeName() == "Union" and sorted("Exchange" in side for side in sides) == [False, True]
        assert {r["doc_id"] for r in kept.collect()} == {i for i, _, root in expected(pairs) if i == root}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)


def test_rows_told_apart_by_digest(spark):
    frame = spark.createDataFrame([(k, bytes([k])) for k in range(200)], "doc_id long, form binary")
    named = frame.filter("doc_id % 20 = 3").select(F.col("form").alias("other"))
    plain, others = jaccard_join._told_apart(frame, "form", named, "other")
    plain, others = ({r["doc_id"] for r in part.collect()} for part in (plain, others))
    assert plain | others == set(range(200)) and not plain & others
    assert {k for k in range(200) if k % 20 == 3} <= others and len(others) < 15
    assert jaccard_join._told_apart(frame, "form", named.limit(0), "other")[1].count() == 0


def test_empty_table(spark):
    assert near_duplicates(docs(spark, [])).collect() == []
    assert keep_first(docs(spark, [(None, None), (3, "")])).count() == 2


def test_prefix_length():
    for n in range(1, 60):
        assert prefix_length(n, 75) == n - -(-75 * n // 100) + 1


def test_tree_join_finds_all_pairs_within_the_bound():
    rng = np.random.default_rng(4)
    points = rng.poisson(0.4, (300, jaccard_join.GROUPS)).astype(np.uint32)
    points[150:] = points[:150]
    points[150:, :20] += 1
    labels = np.arange(300) % 7
    bound = np.minimum(points[:, None, :], points[None, :, :]).sum(axis=2)
    total = points.sum(axis=1)
    good = 175 * bound >= 75 * (total[:, None] + total[None, :])
    want = {(a, b) for a, b in zip(*np.nonzero(np.triu(good, 1))) if labels[a] != labels[b]}
    tree = Tree(points, labels)
    mine = [(min(a, b), max(a, b)) for x, y in tree_join(tree, tree, points, labels, 75) for a, b in zip(x.tolist(), y.tolist())]
    assert len(mine) == len(set(mine)) and set(mine) == want
    sides = Tree(points, labels, np.arange(0, 120)), Tree(points, labels, np.arange(120, 300))
    across = {(min(a, b), max(a, b)) for x, y in tree_join(*sides, points, labels, 75) for a, b in zip(x.tolist(), y.tolist())}
    assert across == {(a, b) for a, b in want if (a < 120) != (b < 120)}


def test_components(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(-5, -5), (7, 8), (8, 7), (160, 159)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {k: 100 for k in range(100, 161)}
