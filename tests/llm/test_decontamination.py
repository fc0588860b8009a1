import hashlib
import re

import pytest

from tankwise.llm import decontamination
from tankwise.llm.decontamination import contamination, decontaminate, find_passages
from tests.llm.frames import docs, rows, text

BENCH = [
    (1, " ".join(text(1, 120).split(" ")[30:55])),  # inside the first text
    (2, "one, TWO"),  # shorter than a window
    (3, None),
    (4, "!!"),
    (5, " ".join(text(2, 30_000).split(" ")[-12:])),  # the end of a very long text
    (5, "a text without an id of its own"),  # an id given twice
    (None, "ab c dé 123"),
    (6, text(99, 40)),  # nowhere
    (7, " ".join(text(3, 200).split(" ")[:10])),  # the beginning
]


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def expected(pairs, bench, window):
    result = []
    for i, t in pairs:
        w, hit, items = words(t), set(), set()
        for item, it in bench:
            b = words(it)
            for start in range(max(1, len(b) - window + 1) if b else 0):
                part = b[start : start + window]
                for at in range(len(w) - len(part) + 1):
                    if w[at : at + len(part)] == part:
                        hit.update(range(at, at + len(part)))
                        items.add("" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        result.append((i, len(w), len(hit), len(items), digest, bool(hit)))
    return sorted(result, key=repr)


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def small_rows():
    return [(i, t if t is None or len(t) < 10_000 else t[-3_000:]) for i, t in rows()]


@pytest.mark.parametrize("block_bytes", [1_000_000, 300])
@pytest.mark.parametrize("window, shingle", [(10, 3), (3, 1), (10, 12)])
def test_equals_brute_force(spark, window, shingle, block_bytes):
    pairs = small_rows()
    bench = spark.createDataFrame([(a, b, 1, "x") for a, b in BENCH], "item_id long, text string, n_words int, doc_id string")
    got = contamination(find_passages(docs(spark, pairs), bench, window=window, shingle=shingle, block_bytes=block_bytes))
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr) == expected(pairs, BENCH, window)


def test_very_long_text(spark):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got = {r["doc_id"]: r for r in contamination(find_passages(docs(spark), bench)).collect()}
    assert got[12]["n_hit"] == 12 and got[12]["n_words"] == 30_000
    assert got[14]["n_hit"] == 10 and not got[5]["contaminated"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(find_passages(docs(spark, []), none)).collect() == []
    assert all(r["n_hit"] == 0 for r in contamination(find_passages(docs(spark), none)).collect())


def test_clean_documents_stay(spark):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    frame = docs(spark)
    kept = decontaminate(frame, bench)
    assert kept.columns == frame.columns
    flagged = {i for i, _, n, *_ in expected(small_rows(), BENCH, 10) if n and i is not None}
    assert {r["doc_id"] for r in kept.collect()} >= {5, 6, 7, 8, 16, -17}
    assert not {r["doc_id"] for r in kept.collect()} & flagged


@pytest.mark.parametrize("window_block", [4_000_000, 300])
def test_null_and_shared_ids_go_by_their_texts(spark, monkeypatch, window_block):
    """Clean and dirty rows under a null id and under a shared one, of equally many words too."""
    monkeypatch.setattr(decontamination._passages, "__defaults__", (*decontamination._passages.__defaults__[:-1], window_block))
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    passage = BENCH[0][1]
    dirty, clean, other = passage + " " + text(71, 5), text(72, 30), text(73, 9)
    pairs = [(None, dirty), (None, clean), (None, other), (7, dirty), (7, clean), (7, other), (8, clean), (9, dirty)]
    pairs += [(None, None), (7, ""), (7, clean)]
    kept = decontaminate(docs(spark, pairs), bench)
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert got == sorted(((i, t) for i, t in pairs if t != dirty), key=repr)
    found = find_passages(docs(spark, pairs), bench, block_bytes=window_block)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in contamination(found).collect()), key=repr) == expected(pairs, BENCH, 10)
