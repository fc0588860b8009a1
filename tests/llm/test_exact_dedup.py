import hashlib
from collections import Counter

import pytest

from tankwise.llm.exact_dedup import deduplicate, duplicate_groups, heavy_digests, misra_gries
from tests.llm.frames import docs, found, rows

import pyarrow as pa


def expected(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault(t or "", []).append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(
        (
            (i, best[t or ""], len(groups[t or ""]), i == best[t or ""], hashlib.sha256((t or "").encode()).hexdigest())
            for i, t in pairs
        ),
        key=repr,
    )


@pytest.mark.parametrize("heavy", [1, 3, 1_000])
def test_groups(spark, heavy):
    pairs = rows() + [(100 + k, "hot") for k in range(40)]
    mine = found(duplicate_groups(docs(spark, pairs), heavy=heavy), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert mine == expected(pairs)


def test_one_row_of_each_group_stays(spark):
    frame = docs(spark)
    kept = deduplicate(frame)
    assert kept.columns == frame.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert Counter(texts) == Counter({t or "" for _, t in rows()})
    ids = {r["text"] or "": r["doc_id"] for r in kept.collect()}
    assert ids[""] == 7 and ids[rows()[0][1]] == 2


def test_empty_table(spark):
    assert duplicate_groups(docs(spark, [])).collect() == []
    assert deduplicate(docs(spark, [])).collect() == []


def test_summaries_keep_frequent_values():
    values = [b"a"] * 50 + [bytes([k]) for k in range(100)] + [b"b"] * 40
    batches = [pa.RecordBatch.from_pydict({"d": pa.array(values[k : k + 7], pa.binary())}) for k in range(0, len(values), 7)]
    (summary,) = misra_gries(10)(batches)
    counts = dict(zip(summary.column(0).to_pylist(), summary.column(1).to_pylist()))
    assert len(counts) <= 10
    for value, true in Counter(values).items():
        assert true - len(values) / 11 <= counts.get(value, 0) <= true


def test_heavy_digests_are_exact(spark):
    frame = spark.createDataFrame([(k, b"h") for k in range(30)] + [(100 + k, bytes([k])) for k in range(30)], "doc_id long, digest binary")
    assert found(heavy_digests(frame.repartition(7), 5), "digest", "keep_id", "group_size") == [(bytearray(b"h"), 29, 30)]
