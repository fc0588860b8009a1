"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is lower-cased and whatever is neither letter nor digit becomes one space; runs of 3 to 6 characters
of that are counted, each under a hash. From the texts to learn from come, for every hash, the numbers of
toxic and of other texts that have it. The hashes that tell most about the label are kept, each with the log
of the ratio of its smoothed shares in the two classes. A text's value for a hash is the log of its count
times that ratio, and logistic regression over these values gives the score."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tankwise.llm.bpe import small
from tankwise.llm.common import picked
from tankwise.llm.language import in_fold
from tankwise.session import release, stage

SIZES = (3, 4, 5, 6)
BITS = 20
#: Hashes that the classifier weighs.
KEPT = 4_096
#: Different texts of each class that it learns from at most.
TEXTS = 6_000
EPOCHS = 40
_BATCH = 256
_RATE = 0.1
_SHRINK = 1e-4
_MOST = 255  # a larger count counts as this
_PIECE = 1 << 18
_BREAK = re.compile(r"[\W_]+")


def grams(text: str) -> Iterator[np.ndarray]:
    """Hashes of all n-grams of a text, repeats included, in pieces of bounded length."""
    plain = f" {_BREAK.sub(' ', text.lower())} ".replace("  ", " ")
    codes = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), np.uint32)
    for start in range(0, len(codes), _PIECE):
        part = codes[start : start + _PIECE + SIZES[-1] - 1]
        mixed = part * np.uint32(0x9E3779B1)
        h = np.zeros(len(part), np.uint32)
        for n in range(1, min(SIZES[-1], len(part)) + 1):
            h = h[: len(part) - n + 1] * np.uint32(0x01000193) + mixed[n - 1 :]
            if n in SIZES:
                g = (h[:_PIECE] ^ (h[:_PIECE] >> np.uint32(15))) * np.uint32(0x85EBCA6B)
                g = ((g ^ (g >> np.uint32(13))) + np.uint32(n)) * np.uint32(0xC2B2AE35)
                yield g >> np.uint32(32 - BITS)


def _distinct(text: str) -> np.ndarray:
    found = [np.unique(part) for part in grams(text)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32)


@dataclass
class Vocabulary:
    """The kept hashes: ``place`` of each hash among them (-1: not kept) and their log-count ratios."""

    place: np.ndarray
    ratios: np.ndarray

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Places that the text has, and how often (at most ``_MOST``)."""
        total = np.zeros(len(self.ratios), np.int64)
        for part in grams(text):
            at = self.place[part]
            total += np.bincount(at[at >= 0], minlength=len(total))
        places = np.flatnonzero(total)
        return places, np.minimum(total[places], _MOST)

    def values(self, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return np.log2(1.0 + counts) * self.ratios[places]


def vocabulary(hashes: np.ndarray, toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int, kept: int = KEPT) -> Vocabulary:
    """The hashes of largest mutual information with the label, from the numbers of texts that have each;
    ties go to the smaller hash."""
    n = n_toxic + n_other
    share = (toxic + other) / n
    gain = np.zeros(len(hashes))
    for both, expected in (
        (toxic / n, share * n_toxic / n),
        (other / n, share * n_other / n),
        ((n_toxic - toxic) / n, (1 - share) * n_toxic / n),
        ((n_other - other) / n, (1 - share) * n_other / n),
    ):
        use = both > 0
        gain[use] += both[use] * np.log(both[use] / expected[use])
    top = np.sort(np.lexsort((hashes, -np.round(gain, 12)))[:kept])
    place = np.full(1 << BITS, -1, np.int16)
    place[hashes[top]] = np.arange(len(top))
    ratios = np.log(((toxic[top] + 0.5) / (n_toxic + 1)) / ((other[top] + 0.5) / (n_other + 1)))
    return Vocabulary(place, ratios)


@dataclass
class Model:
    """Without a vocabulary (nothing to tell classes apart by) every text gets ``share``."""

    share: float
    words: Vocabulary | None = None
    weights: np.ndarray | None = None
    offset: float = 0.0

    def score(self, text: str) -> float:
        if self.words is None:
            return self.share
        places, counts = self.words.counts(text)
        z = float(self.words.values(places, counts) @ self.weights[places]) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def fit(words: Vocabulary, texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, share: float, seed: int = 5) -> Model:
    """Logistic regression by Adam over the texts' places and counts; ``share`` is that of toxic texts
    among all labelled ones, and each class weighs as much as its share."""
    rng = np.random.default_rng(seed)
    values = [words.values(*pair) for pair in texts]
    size = np.sqrt(np.mean([float(v @ v) for v in values])) or 1.0
    values = [v / size for v in values]
    mean = labels.mean()
    importance = np.where(labels == 1, share / mean, (1 - share) / (1 - mean))
    weights, n = np.zeros(len(words.ratios) + 1), len(texts)
    weights[-1] = np.log(share / (1 - share))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    steps, step = EPOCHS * -(-n // _BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for start in range(0, n, _BATCH):
            rows = order[start : start + _BATCH]
            at = np.repeat(np.arange(len(rows)), [len(values[i]) for i in rows])
            places = np.concatenate([texts[i][0] for i in rows])
            x = np.concatenate([values[i] for i in rows])
            z = np.bincount(at, x * weights[places], len(rows)) + weights[-1]
            slope = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels[rows]) * importance[rows] / len(rows)
            gradient = np.append(
                np.bincount(places, x * slope[at], len(weights) - 1) + _SHRINK * weights[:-1], slope.sum()
            )
            step += 1
            first += 0.1 * (gradient - first)
            second += 0.001 * (gradient**2 - second)
            rate = _RATE * (1 - step / (steps + 1))
            weights -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(share, words, weights[:-1] / size, float(weights[-1]))


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros((2, 1 << BITS), np.int32)
    for part in small(batches):
        for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist()):
            totals[label, _distinct(text)] += 1
    seen = np.flatnonzero(totals.any(axis=0))
    for start in range(0, len(seen), 1 << 16):
        some = seen[start : start + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(totals[1, some]), pa.array(totals[0, some])], ["hash", "toxic", "other"]
        )


def _placed(words):
    """Task function: label, places (16 bits each) and counts (8 bits each) of every text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            found = [words.value.counts(text) for text in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("digest"),
                    part.column("label"),
                    pa.array([places.astype(np.int16).tobytes() for places, _ in found], pa.binary()),
                    pa.array([counts.astype(np.uint8).tobytes() for _, counts in found], pa.binary()),
                ],
                ["digest", "label", "places", "counts"],
            )

    return run


def _examples(docs: DataFrame, labels: DataFrame, most: int) -> tuple[DataFrame, float] | None:
    """Staged ``digest, label, text`` of at most ``most`` different texts of each class, those with the
    least hashes, and the share of toxic ones among all labelled texts. None if nothing is labelled."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("digest", F.unhex(F.sha2("text", 256)))
    # Only digests are shuffled here; a text counts as toxic if any row of it is marked so.
    known = texts.select("doc_id", "digest").join(labels, "doc_id").groupBy("digest").agg(F.max("label").alias("label"))
    known = stage(known)
    sizes = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}  # two rows
    if not sizes:
        return None
    share = sizes.get(1, 0) / sum(sizes.values())
    order = F.xxhash64("digest"), F.col("digest")
    chosen = [known.filter(F.col("label") == label).orderBy(*order).limit(most) for label in (0, 1)]
    chosen = stage(chosen[0].unionByName(chosen[1]))
    # At most twice ``most`` digests go to every task.
    sample = stage(texts.select("digest", "text").join(F.broadcast(chosen), "digest").dropDuplicates(["digest"]))
    release(known, chosen)
    return sample, share


def learn(
    docs: DataFrame,
    labels: DataFrame,
    most: int = TEXTS,
    id: str = "doc_id",
    text: str = "text",
    label_id: str = "doc_id",
    label: str = "toxic",
) -> Model:
    """Learn from the texts whose id ``labels`` marks as toxic (1 in any row of the id) or not (0).

    At most ``most`` different texts of each class are used, chosen by hash, however many rows repeat one;
    log-count ratios come from all of these. A null label or id marks nothing; null texts count as empty. If
    only one class is marked, or none, every score is the share of toxic texts (0 without any label)."""
    texts = picked(docs, doc_id=id, text=text)
    marked = picked(labels, doc_id=label_id, label=label).filter("label IN (0, 1) AND doc_id IS NOT NULL")
    marked = marked.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    found = _examples(texts, marked, most)
    if found is None:
        return Model(0.0)
    sample, share = found
    sizes = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}  # two rows
    if len(sizes) < 2:
        return Model(share)
    counted = sample.select("text", "label").mapInArrow(_counted, "hash int, toxic int, other int")
    counted = counted.groupBy("hash").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    rows = counted.filter("toxic + other > 1").toArrow().sort_by("hash")  # at most 2 ** BITS rows
    if not len(rows):
        return Model(share)
    words = vocabulary(*(rows.column(name).to_numpy() for name in ("hash", "toxic", "other")), sizes[1], sizes[0])
    shared = docs.sparkSession.sparkContext.broadcast(words)
    held = sample.select("digest", "label", "text").mapInArrow(
        _placed(shared), "digest binary, label int, places binary, counts binary"
    )
    held = held.toArrow().sort_by("digest")  # at most twice ``most`` rows of at most 3 bytes per kept hash
    release(sample)
    texts = [
        (np.frombuffer(p, np.int16).astype(np.int64), np.frombuffer(c, np.uint8))
        for p, c in zip(held.column("places").to_pylist(), held.column("counts").to_pylist())
    ]
    return fit(words, texts, held.column("label").to_numpy().astype(float), share)


def score(docs: DataFrame, model: Model, threshold: float = 0.3, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` for every row, from the whole text.

    Null and empty texts, and texts without a letter or digit, have no n-grams and get the score of the
    offset alone. Long texts are counted piece by piece. Rows given twice give two rows with one score; an
    empty table gives none; further columns play no part."""
    rows = picked(docs, doc_id=id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            found = np.array([shared.value.score(t or "") for t in part.column("text").to_pylist()], float)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score, predicted, held_out``, learnt from ids that are not held out (CRC-32 of the id as
    text, modulo 4, is 2)."""

    def held_out() -> Column:
        return in_fold(F.col("doc_id"), 4, 2)

    model = learn(docs.filter(~held_out()), labels.filter(~held_out()))
    return score(docs, model).withColumn("held_out", held_out())
