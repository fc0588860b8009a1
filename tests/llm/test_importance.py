"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

from tankwise.llm import importance
from tests.llm.frames import docs, found, rows, text

COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]


def plain_words(value):
    data = (value or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", data)


def plain_features(value, longest=2):
    words = plain_words(value)
    return [b" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def expected(corpus, target, percent=25, least=20):
    source, aim = Counter(), Counter()
    for _, value in corpus:
        source.update(crc32(f) % 10_000 for f in plain_features(value))
    for value in target:
        aim.update(crc32(f) % 10_000 for f in plain_features(value))
    big, small = sum(source.values()), sum(aim.values())

    def gain(bucket):
        return math.floor(1000 * math.log((aim[bucket] + 1.0) * (big + 10_000.0) / ((source[bucket] + 1.0) * (small + 10_000.0))))

    scored = []
    for i, value in corpus:
        gains = [gain(crc32(f) % 10_000) for f in plain_features(value)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((i, len(gains), weight, score, len(plain_words(value)) >= least))
    able = sorted((s for s in scored if s[4]), key=lambda s: (-s[3], s[0] is None, s[0] or 0, -s[2]))
    drawn = percent * len(able) // 100
    out = [(*s[:4], k + 1 if k < drawn else None) for k, s in enumerate(able)]
    return sorted(out + [(*s[:4], None) for s in scored if not s[4]], key=repr)


def test_features_across_pieces():
    rng = random.Random(1)
    for _ in range(200):
        value = "".join(rng.choice("aBé1 .,\n\x1f") for _ in range(rng.randrange(60)))
        for longest in (1, 2, 3):
            for piece in (1, 5, 1000):
                got = list(importance.features(value, longest, piece))
                assert sorted(f for _, some in got for f in some) == sorted(map(crc32, plain_features(value, longest)))
                assert sum(n for n, _ in got) == len(plain_words(value))


def test_equals_brute_force(spark):
    corpus = rows() + [(100 + k, text(500 + k, 25 + k)) for k in range(40)]
    target = [text(700, 300), None, "", text(505, 20)]
    frame = spark.createDataFrame([(t, "x", 1) for t in target], "text string, item_id string, bucket int")
    got = importance.resample(docs(spark, corpus).repartition(5), frame)
    assert got.columns == COLUMNS and found(got, *COLUMNS) == expected(corpus, target)


def test_ties_and_repeated_rows(spark):
    same = text(1, 30)
    corpus = [(1, same)] * 40 + [(None, same)] * 20 + [(None, text(2, 30))]
    got = importance.resample(docs(spark, corpus), spark.createDataFrame([(same,)], "text string"))
    assert found(got, *COLUMNS) == expected(corpus, [same])
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == list(range(1, 16))


def test_ids_as_text(spark):
    corpus = [(f"a{k}", text(k, 30)) for k in range(12)]
    got = importance.resample(spark.createDataFrame(corpus, "doc_id string, text string"), docs(spark, []))
    assert sum(r["rank"] is not None for r in got.collect()) == 3


def test_empty_tables(spark):
    none = docs(spark, rows()).limit(0)
    assert importance.resample(none, none).collect() == []
    got = importance.resample(docs(spark), none)
    assert found(got, *COLUMNS) == expected(rows(), [])
