"""The queries and the pipeline on small tables."""

import hashlib
import re

import pytest
import tokenizers

import __spark_entry__ as driver
import corpus_pipeline
from tankwise.llm.queries import tokenizer_path
from tests.llm.frames import docs, rows, text
from tests.llm.test_jaccard_join import expected as near


def test_every_operator_has_a_query():
    names = driver.queries()
    for n in range(1, 14):
        assert sum(bool(re.match(f"op{n}_", name)) for name in names) == 1
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables of the odd rows and some plain ones, with a benchmark item in two of them."""
    path = str(tmp_path_factory.mktemp("tables"))
    plain = [(200 + k, text(300 + k, 40)) for k in range(30)]
    item = " ".join(plain[3][1].split(" ")[5:25])
    plain.append((300, text(400, 30) + " " + item))
    plain.append((301, text(401, 30_000) + " " + item))  # at the very end of a long text
    frame = docs(spark, [r for r in rows() if r[0] not in (14,)] + plain)
    frame.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def windows(value, size=10):
    """All runs of ten words of a whole text."""
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", value.lower())
    return set(zip(*(found[k:] for k in range(size))))


def test_pipeline_equals_brute_force(spark, folder):
    got = corpus_pipeline.run(spark, folder).collect()
    table = spark.read.parquet(f"{folder}/documents.parquet")
    # What the first stage keeps is tested with the network; the others follow from it.
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.known_language(spark, table, folder).collect()]
    assert {5, 6, 7, 8, 16}.isdisjoint(i for i, _ in kept) and {200, 203, 300} <= {i for i, _ in kept}
    best = {}
    for i, t in kept:
        if t not in best or best[t] is None or (i is not None and i > best[t]):
            best[t] = i
    kept = [(i, t) for t, i in best.items()]
    roots = near(kept)
    gone = {i for i, _, root in roots if i is not None and i != root}
    kept = [(i, t) for i, t in kept if i not in gone]
    item = spark.read.parquet(f"{folder}/benchmark.parquet").first()["text"]
    bad = {i for i, t in kept if windows(t) & windows(item)}
    assert bad == {203, 300, 301}
    kept = [(i, t) for i, t in kept if i not in bad]
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    library.no_truncation()
    library.no_padding()
    want = []
    for i, t in kept:
        ids = library.encode(t, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((i, t, len(ids), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["text"], r["n_tokens"], r["decoded_sha256"]) for r in got), key=repr) == sorted(want, key=repr)


def test_stages_keep_the_columns(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    for _, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, table, folder).columns == table.columns


def test_stages_over_an_empty_table(spark, folder):
    none = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, none, folder).collect() == []
