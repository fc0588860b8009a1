import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tankwise.llm import language, quality
from tests.llm.frames import docs, rows, text

PARTS = {"aa": "the ing and tion wh ere sh".split(), "bb": "der sch ung ein ich für ß".split(), "cc": "que ción ñ los ara í".split()}


def word(lang, rng):
    return "".join(rng.choice(PARTS[lang]) for _ in range(rng.randrange(1, 4)))


def labelled(spark, n=600):
    rng = random.Random(3)
    made = []
    for k in range(n):
        lang = sorted(PARTS)[k % 3]
        made.append((k, " ".join(word(lang, rng) for _ in range(rng.randrange(3, 400))), lang))
    return spark.createDataFrame(made + [(9_000, None, "aa"), (9_001, "12 34 !!", "bb"), (9_002, "the ing", None)], "doc_id long, text string, lang string")


def test_language_held_out(spark):
    frame = labelled(spark)
    got = {r["doc_id"]: r for r in language.identify(frame).collect()}
    assert len(got) == 603
    for r in got.values():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    right = [got[k]["lang_pred"] == sorted(PARTS)[k % 3] for k in range(600) if got[k]["held_out"]]
    assert np.mean(right) > 0.95
    assert got[9_000]["lang_pred"] == got[9_001]["lang_pred"] == "und"


def test_network_gradient():
    """Against differences of the loss."""
    rng = np.random.default_rng(0)
    windows, labels = rng.integers(1, 256, (3, language.WINDOW)).astype(np.uint8), np.array([0, 1, 0])
    net = language.train(windows, labels, ["a", "b"], epochs=0)
    for name in ("embedding", "filters", "bias", "dense", "offset"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    mask = np.ones_like(net.filters)
    gradients = language._gradients(net, windows, labels, np.ones(3), mask)
    loss = lambda: -np.log(net.probabilities(windows)[np.arange(3), labels]).mean()
    for part, gradient in zip((net.embedding, net.filters, net.bias, net.dense, net.offset), gradients):
        flat, flat_gradient = part.reshape(-1), np.asarray(gradient).reshape(-1)
        for k in np.argsort(-np.abs(flat_gradient))[:4]:
            kept = flat[k]
            flat[k] = kept + 1e-6
            up = loss()
            flat[k] = kept - 1e-6
            down = loss()
            flat[k] = kept
            assert abs((up - down) / 2e-6 - flat_gradient[k]) < 1e-4


def test_language_odd_rows(spark):
    frame = docs(spark)
    got = language.identify(frame)
    assert got.count() == len(rows())
    unknown = {r["doc_id"] for r in got.filter("lang_pred = 'und'").collect()}
    assert {5, 6, 7, 8, 16} <= unknown
    assert language.identify(docs(spark, [])).collect() == []
    nothing = language.identify(frame.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    net = language.learn(labelled(spark).select("lang", "text"))
    kept = language.keep_known(frame, net)
    assert kept.columns == frame.columns and not {5, 6, 7, 8, 16} & {r["doc_id"] for r in kept.collect()}


def test_whole_texts_count():
    net = language.Network(["a"], *(np.zeros(1),) * 5)
    windows, owner, sizes = language.windowed([b"x" * 700, b"", b"y"])
    assert windows.shape == (5, language.WINDOW) and owner.tolist() == [0, 0, 0, 1, 2]
    assert sizes.tolist() == [256, 256, 188, 0, 1] and net.languages == ["a"]


def test_quality(spark):
    rng = random.Random(5)
    made, marks = [], []
    for k in range(900):
        good = k % 10 < 7
        words = [word("aa", rng) for _ in range(rng.randrange(20, 200))]
        made.append((k, " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words[:5] * 20)))
        if k % 2 == 0:
            marks.append((k, int(good)))
    frame = spark.createDataFrame(made + [(9_000, None), (9_001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(*m, 0) for m in marks] + [(0, 0, 1), (None, 1, 1), (2, None, 1)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.assess(frame, labels).collect()}
    assert len(got) == 902
    held = [got[k] for k in range(900) if got[k]["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got.values())
    assert np.mean([r["predicted"] == int(r["doc_id"] % 10 < 7) for r in held]) > 0.95
    assert 0 <= got[9_000]["score"] == got[9_001]["score"] <= 1


def test_class_prior():
    rng = np.random.default_rng(1)
    good = rng.normal(1, 1, (3_000, quality.FEATURES))
    mixed = np.concatenate([rng.normal(1, 1, (1_800, quality.FEATURES)), rng.normal(-1, 1, (1_200, quality.FEATURES))])
    assert abs(quality.class_prior(good, rng.permutation(mixed), epochs=20) - 0.6) < 0.07


def test_quality_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.assess(docs(spark, []), none).collect() == []
    got = quality.assess(docs(spark), none).collect()
    assert len(got) == len(rows()) and {r["score"] for r in got} == {0.5}
    assert all(np.isfinite(quality.features(t or "")).all() and len(quality.features(t or "")) == quality.FEATURES for _, t in rows())
    assert len(quality.features(text(1, 100_000))) == quality.FEATURES


@pytest.mark.parametrize("text", ["", "x", "!", "a b\nc"])
def test_features_of_short_texts(text):
    assert np.isfinite(quality.features(text)).all()


def test_documents_with_letters_stay_whatever_the_score(spark):
    """With nothing to learn from, and with forty languages that look alike."""
    frame = docs(spark)
    want = sorted((r["doc_id"] for r in frame.filter(language.has_letter(frame["text"])).collect()), key=repr)
    unlabelled = language.learn(frame.selectExpr("cast(null AS string) AS lang", "text"))
    assert unlabelled is None
    flat = language.train(np.full((40, language.WINDOW), 97, np.uint8), np.arange(40), [f"l{k:02}" for k in range(40)])
    for net in (None, flat):
        kept = language.keep_known(frame, net)
        assert kept.columns == frame.columns
        assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == want


@pytest.mark.parametrize("trusted", [1, 2, 3, 5])
def test_few_trusted_texts(trusted):
    rng = np.random.default_rng(trusted)
    for unmarked in (2, 6, 400):
        model = quality.fit(rng.normal(1, 1, (trusted, 24)), rng.normal(0, 1, (unmarked, 24)))
        assert (model is None) == (trusted < 2)
        assert model is None or (0 < model.prior < 1 and np.isfinite(model.probability(rng.normal(0, 1, (4, 24)))).all())


def test_any_number_of_languages(spark):
    """Each of 501 has a text to learn from; with fewer texts allowed than languages, the common ones do."""
    frame = spark.range(1_503).selectExpr("concat('l', id % 501) AS lang", "concat('word ', char(97 + id % 26), ' ', id) AS text")
    frame = frame.unionByName(spark.createDataFrame([("often", f"más {k}") for k in range(40)], "lang string, text string"))
    net = language.learn(frame, most=600)
    assert len(net.languages) == 502
    assert language._examples(frame.withColumn("digest", F.unhex(F.sha2("text", 256))), 2_000, 100).filter("lang = 'often'").count() == 1


def test_one_repeated_text_is_learnt(spark):
    """A language of one text in many rows, beside one of many texts."""
    rng = random.Random(4)
    spanish = "el perro corre por la casa y la niña come una manzana roja"
    english = [(k, " ".join(word("aa", rng) for _ in range(12)), "en") for k in range(600)]
    frame = spark.createDataFrame(english + [(1_000 + k, spanish, "es") for k in range(6_000)], "doc_id long, text string, lang string")
    got = language.identify(frame).groupBy("lang_pred").count().collect()
    assert {r["lang_pred"]: r["count"] for r in got} == {"en": 600, "es": 6_000}


def test_shared_ids_and_copies_in_the_quality_sample(spark):
    """Neither rows of one id nor copies of one text enter or stay out together, and the sample is bounded."""
    rng = random.Random(6)
    rows = [(None if k % 10 else k, f"{rng.random()} word {k}") for k in range(4_000)] + [(7, "one text in many rows")] * 3_000
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.unhex(F.sha2("text", 256)))
    assert len(quality._sampled(frame, frame, 500)) == 500
    assert len(quality._sampled(frame, frame, 9_000)) == 4_001
    shared = quality._sampled(frame.filter("doc_id IS NULL"), frame, 1_000)
    assert len(shared) == 1_000


@pytest.mark.parametrize("name, floor", [("op2_quality", 0.95), ("op9_language", 0.98)])
def test_registered_classifiers_on_the_tables(spark, name, floor):
    from tankwise.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    got = QUERIES[name](spark, folder).filter("held_out")
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    if name == "op9_language":
        held = got.join(documents.filter("lang IS NOT NULL AND text rlike '[a-z]'").select("doc_id", "lang"), "doc_id").collect()
        assert np.mean([r["lang"] == r["lang_pred"] for r in held]) >= floor
    else:
        held = got.join(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality"), "doc_id").collect()
        good, bad = ([r["score"] for r in held if r["quality"] == q] for q in (1, 0))
        assert np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad]) >= floor
