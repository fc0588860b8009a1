import hashlib
import random
import zlib

import numpy as np
import pytest
import tokenizers

from tankwise.llm import bpe, token_files
from tankwise.llm.elias_fano import EliasFano, encode
from tankwise.llm.queries import tokenizer_path
from tests.llm.frames import docs, rows


@pytest.fixture(scope="module")
def library():
    tokenizer = tokenizers.Tokenizer.from_file(tokenizer_path())
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


ALPHABET = [*"abAB'stredvlm  \n\t\x1c\x85 　éÉßİΣσςǅ1²٣!?…<|>", "<|endoftext|>", "é", "가", "각", "👍🏽", "Ᲊ", "࢏"]


def test_equals_the_library(library):
    mine, rng = bpe.load(tokenizer_path()), random.Random(1)
    for _ in range(3_000):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(14)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert mine.encode(text) == ids, repr(text)
        assert mine.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_cache_generations():
    made = []
    cache = bpe.Cache(lambda k: made.append(k) or k * 2, size=3)
    assert [cache[k] for k in (1, 2, 3, 4, 1, 5, 6, 7, 8, 9, 1)] == [2, 4, 6, 8, 2, 10, 12, 14, 16, 18, 2]
    assert len(cache) + len(cache.old) <= 6 and made.count(1) == 2


def expected_ids(library):
    return [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows()]


def test_fingerprints(spark, library):
    want = sorted(
        (
            (
                i,
                len(ids),
                hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest(),
            )
            for i, ids in expected_ids(library)
        ),
        key=repr,
    )
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    got = bpe.fingerprints(docs(spark), tokenizer_path()).collect()
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == want
    whole = bpe.with_counts(docs(spark), tokenizer_path())
    assert whole.columns == [*docs(spark).columns, *columns[1:]]
    assert sorted((tuple(r[c] for c in columns) for r in whole.collect()), key=repr) == want
    ids = {r["doc_id"]: (r["ids"], r["decoded"]) for r in bpe.encode(docs(spark), tokenizer_path()).collect()}
    assert ids[5] == ([], "") and ids[10][0] == dict(expected_ids(library))[10]


def test_empty_tables(spark):
    assert bpe.fingerprints(docs(spark, []), tokenizer_path()).collect() == []
    shards = token_files.write(docs(spark, []), tokenizer_path(), 2)
    assert token_files.checksums(shards).collect() == []


def test_token_files(spark, library):
    shards = token_files.write(docs(spark), tokenizer_path(), end_id=2)
    got = token_files.checksums(shards).collect()
    order = sorted(got, key=lambda r: r["start"])
    ids = [r["doc_id"] for r in order]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    assert [r["start"] for r in order] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in order])[:-1]]).tolist()
    want = sorted(((i, len(x) + 1, zlib.crc32(np.array(x + [2], "<u4").tobytes())) for i, x in expected_ids(library)), key=repr)
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=repr) == want
    whole = {r["doc_id"]: r["ids"] for r in token_files.read(shards).collect()}
    assert whole[12] == dict(expected_ids(library))[12] + [2]


def test_token_files_of_far_ids(spark):
    far = [(-(1 << 63), "one two"), (-5, ""), (3, "three"), ((1 << 63) - 1, None)]
    shards = token_files.write(docs(spark, far).coalesce(1), tokenizer_path(), end_id=2)
    got = token_files.read(shards).collect()
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])] == [i for i, _ in far]
    with pytest.raises(ValueError, match="whole numbers"):
        token_files.write(spark.createDataFrame([("a", "b")], "doc_id string, text string"), tokenizer_path(), 2)


def test_library_encoder_with_a_small_cache(library, monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_BYTES", 2_000)
    coder = token_files.LibraryEncoder(tokenizer_path())
    for _ in range(3):
        texts = [t or "" for _, t in rows()]
        got = [np.frombuffer(b, coder.kind).tolist() for b in coder.encode(texts)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("values", [[], [0], [7], [0, 0, 0], [0, 1, 1, 5, 10**12], list(range(2_000)), [2**40] * 700])
def test_elias_fano(values):
    read = EliasFano(encode(np.array(values, np.int64)))
    assert len(read) == len(values)
    assert read.slice(0, len(values)).tolist() == values
    assert [read.select(i) for i in range(len(values))] == values


def test_elias_fano_space_and_select():
    rng = np.random.default_rng(2)
    values = np.cumsum(rng.integers(0, 3_000, 50_000))
    data = encode(values)
    assert len(data) * 8 / len(values) < 2.6 + np.log2(values[-1] / len(values))
    read = EliasFano(data)
    for i in rng.integers(0, len(values), 300).tolist():
        assert read.select(i) == values[i]
    assert (read.slice(255, 40_001) == values[255:40_001]).all()
    with pytest.raises(ValueError):
        encode(np.array([2, 1]))


def test_registered_queries_equal_the_library(spark, library):
    from tankwise.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    corpus = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    coded = {i: library.encode(t, add_special_tokens=False).ids for i, t in corpus}
    got = {r["doc_id"]: r for r in QUERIES["op3_bpe"](spark, folder).collect()}
    assert set(got) == set(coded)
    for i, ids in coded.items():
        decoded = library.decode(ids, skip_special_tokens=False)
        want = len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
        assert tuple(got[i][c] for c in ("n_tokens", "ids_sha256", "decoded_sha256")) == want
    start = 0
    files = {r["doc_id"]: r for r in QUERIES["op4_token_files"](spark, folder).collect()}
    for i in sorted(coded):
        ids = coded[i] + [2]
        assert (files[i]["start"], files[i]["n_tokens"]) == (start, len(ids))
        assert files[i]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert len(files) == len(coded)
