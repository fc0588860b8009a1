"""The toxicity classifier: its counts against plain ones, and held-out accuracy."""

import random
from collections import Counter

import numpy as np
import pytest

from tankwise.llm import toxicity
from tests.llm.frames import docs, rows

SYLLABLES = "ba ke lo mi nu ra se ti vo zu an el".split()
BAD = ["grobnik", "fulzart"]


def sentence(rng, toxic):
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(20, 80))]
    if toxic:
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(len(words))] = rng.choice(BAD) + rng.choice(SYLLABLES)
    return " ".join(words).capitalize() + "."


def corpus(n, seed=1):
    rng = random.Random(seed)
    return [(k, sentence(rng, k % 5 == 0), int(k % 5 == 0)) for k in range(n)]


def labelled(spark, rows):
    return spark.createDataFrame([(i, y, "x", "x", "x") for i, _, y in rows], "doc_id long, toxic int, label string, digest string, hash string")


def auc(scores, labels):
    order = np.argsort(scores)
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    pos = labels == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_pieces_have_the_same_grams(monkeypatch):
    text = "Ab, cd  éf_gh İ " * 40
    whole = Counter(np.concatenate(list(toxicity.grams(text))).tolist())
    monkeypatch.setattr(toxicity, "_PIECE", 7)
    assert Counter(np.concatenate(list(toxicity.grams(text))).tolist()) == whole
    plain = f" {toxicity._BREAK.sub(' ', text.lower())}"
    assert sum(whole.values()) == sum(len(plain) - n + 1 for n in toxicity.SIZES)


def test_held_out_accuracy(spark):
    made = corpus(1_200)
    frame = docs(spark, [(i, t) for i, t, _ in made])
    got = {r["doc_id"]: r for r in toxicity.assess(frame, labelled(spark, made)).collect()}
    held = [(got[i]["score"], y, got[i]["predicted"]) for i, _, y in made if got[i]["held_out"]]
    assert len(got) == 1_200 and 200 < len(held) < 400
    scores, labels, predicted = (np.array(v) for v in zip(*held))
    assert auc(scores, labels) > 0.99
    assert (predicted == labels).mean() > 0.95 and set(predicted) == {0, 1}
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.values())


def test_registered_query_on_the_tables(spark):
    from tankwise.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    got = QUERIES["op11_toxicity"](spark, folder)
    marks = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    held = got.filter("held_out").join(marks, "doc_id").collect()
    labels, scores = np.array([r["toxic"] for r in held]), np.array([r["score"] for r in held])
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert auc(scores, labels) > 0.8
    assert np.mean([r["predicted"] for r in held if r["toxic"] == 0]) < 0.1


def test_odd_rows_and_shared_ids(spark):
    made = corpus(300)
    odd = [(None if i is None else 10_000 + i, t) for i, t in rows()] + [(20_000, "k " * 300_000 + BAD[0] + "ba")]
    frame = docs(spark, [(i, t) for i, t, _ in made] + odd)
    marks = labelled(spark, made).unionByName(
        spark.createDataFrame([(None, 1, "", "", ""), (0, None, "", "", ""), (0, 0, "", "", ""), (3, 9, "", "", "")], labelled(spark, made).schema)
    )
    got = toxicity.assess(frame, marks).collect()
    assert len(got) == 300 + len(odd)
    assert {r["predicted"] for r in got if r["doc_id"] in (10_005, 10_006, 10_008)} == {0}
    assert {r["predicted"] for r in got if r["doc_id"] == 20_000} == {1}
    twice = [r["score"] for r in got if r["doc_id"] in (10_001, 10_002)]
    assert twice[0] == twice[1]


def test_one_repeated_text_does_not_fill_the_sample(spark):
    made = corpus(200)
    copies = [(1_000 + k, "ke lo mi nu", 0) for k in range(3_000)]
    frame = docs(spark, [(i, t) for i, t, _ in made + copies])
    model = toxicity.learn(frame, labelled(spark, made + copies), most=200)
    scores = {i: model.score(t) for i, t, _ in corpus(60, seed=9)}
    assert np.mean([(scores[i] >= 0.3) == y for i, _, y in corpus(60, seed=9)]) > 0.9


@pytest.mark.parametrize("kinds, share", [((), 0.0), ((0,), 0.0), ((1,), 1.0)])
def test_without_two_classes(spark, kinds, share):
    made = [r for r in corpus(40) if r[2] in kinds]
    marks = labelled(spark, made) if made else labelled(spark, corpus(1)).limit(0)
    got = toxicity.assess(docs(spark, [(i, t) for i, t, _ in corpus(40)]), marks).collect()
    assert {r["score"] for r in got} == {share}


def test_empty_table(spark):
    none = docs(spark).limit(0)
    assert toxicity.assess(none, labelled(spark, corpus(3))).collect() == []
