"""Importance resampling of documents towards a target corpus by hashed n-grams of words.

A 256-byte table lower-cases A-Z and blanks every separator in a text's UTF-8 bytes, and ``bytes.split``
gives the words. The CRC-32 of a word seeds that of the space and word after it, so longer n-grams cost no
new strings; its remainder is the n-gram's bucket. Counts per bucket over both corpora give every bucket an
integer gain, a document's weight is the mean gain of its n-grams, and a Gumbel number from a hash of its
id turns the highest scores into a weighted draw without replacement."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tankwise.llm.bpe import small
from tankwise.llm.common import picked
from tankwise.session import release, stage

BUCKETS = 10_000
LONGEST = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: Bytes of a text that are split at a time, up to the end of a word.
PIECE = 1 << 20

_TABLE = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte if 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A or byte >= 0x80 else 0x20
    for byte in range(256)
)
_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row number below


def words(text: str, piece: int = PIECE) -> Iterator[list[bytes]]:
    """Lists of the words of a text, in order."""
    data = text.encode("utf-8", "surrogatepass").translate(_TABLE)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + piece)
        end = len(data) if end < 0 else end
        found = data[start:end].split()
        if found:
            yield found
        start = end


def features(text: str, longest: int = LONGEST, piece: int = PIECE) -> Iterator[tuple[int, list[int]]]:
    """(number of words, CRC-32 of all n-grams ending in them) for each piece of a text."""
    ends: list[list[int]] = [[] for _ in range(longest)]  # the n-gram that ends in the last word so far
    for found in words(text, piece):
        level = list(map(crc32, found))
        every, after = list(level), [level[-1:]]
        for n in range(1, longest):
            seeds = ends[n - 1] + level[:-1]
            level = list(map(crc32, found[len(found) - len(seeds) :], map(crc32, repeat(b" "), seeds)))
            every += level
            after.append(level[-1:])
        ends = after
        yield len(found), every


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """N-grams per bucket over all texts; at most one row per bucket reaches the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for part in small(batches):
            for text in part.column(0).to_pylist():
                for _, found in features(text or "", longest):
                    counts.update(found)
                    if len(counts) > 200_000:
                        counts = _folded(counts, buckets)
        counts = _folded(counts, buckets)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], ["bucket", "n"]
        )

    counted = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    total = np.zeros(buckets, np.int64)
    total[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return total


def _folded(counts: Counter, buckets: int) -> Counter:
    """Counts of remainders (of remainders, too) by bucket."""
    folded: Counter[int] = Counter()
    for value, n in counts.items():
        folded[value % buckets] += n
    return folded


def bucket_gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """Thousandths of the log ratio of a bucket's smoothed shares, rounded down."""
    size, most, least = float(len(source)), float(source.sum()), float(target.sum())
    return [
        math.floor(1000 * math.log(((t + 1.0) * (most + size)) / ((s + 1.0) * (least + size))))
        for s, t in zip(source.tolist(), target.tolist())
    ]


def _weighed(gains, longest: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.array(gains.value, np.int64)
        for part in small(batches):
            rows = []
            for text in part.column("text").to_pylist():
                n_words = n = total = 0
                for held, found in features(text or "", longest):
                    n_words += held
                    n += len(found)
                    total += int(gain[np.array(found, np.int64) % len(gain)].sum())
                rows.append((n_words, n, total // n if n else 0))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(column, pa.int64()) for column in (zip(*rows) if rows else ((), (), ())))],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    return run


def gumbel(id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel number from the hash of an id (null: no text), rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, order: list[Column]) -> tuple[DataFrame, int]:
    """``rows`` with ``rank``, their number in the given order, and how many there are.

    Rows are sorted by ranges and written once; a range's ranks start behind the rows of those before it, of
    which the driver gets one count per range."""
    dealt = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    split = F.shiftright("at", _POSITION_BITS).alias("range")
    sizes = sorted(dealt.groupBy(split).count().collect())
    starts, total = [], 0
    for row in sizes:
        starts.append((row["range"], total))
        total += row["count"]
    # One row per range, as many as the session has shuffle partitions.
    offsets = F.broadcast(rows.sparkSession.createDataFrame(starts, "range long, start long"))
    number = F.col("start") + F.col("at") - F.shiftleft(F.col("range"), _POSITION_BITS) + 1
    named = dealt.withColumn("range", split).join(offsets, "range").withColumn("rank", number)
    return named.drop("range", "start", "at"), total


def resample(
    docs: DataFrame,
    target: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` per row; ``rank`` is null for those not drawn.

    Words are runs of ASCII letters, digits and anything beyond ASCII, with A-Z in lower case; features are
    all runs of 1 to ``longest`` of them. A null or empty text has none, and weight 0. Of the rows with at least
    ``least_words`` words the ``percent`` per cent (rounded down) of highest score are drawn; ties go to the
    smaller id, a null id last, and then to the larger weight. Rows given twice are ranked one after the
    other. Long texts are split piece by piece. Without a target text all its counts are 0; an empty table
    gives no rows; further columns play no part."""
    texts = picked(docs, doc_id=id, text=text)
    wanted = picked(target, text=target_text)
    gains = bucket_gains(bucket_counts(texts, buckets, longest), bucket_counts(wanted, buckets, longest))
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    kind = texts.schema["doc_id"].dataType.simpleString()
    weighed = texts.mapInArrow(_weighed(shared, longest), f"doc_id {kind}, n_words long, n_features long, weight long")
    scored = stage(
        weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)).withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.asc("row")]
    able, total = ranked(scored.filter(F.col("n_words") >= least_words), order)
    drawn = percent * total // 100
    able = able.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return able.select(*columns).unionByName(rest.select(*columns))
