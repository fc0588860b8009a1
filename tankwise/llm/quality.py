"""Text quality by positive-unlabelled learning.

The classifier learns from texts that are trusted to be good and from a sample of all texts, good and bad
unmarked. A first network tells trusted from unmarked texts; from its scores on texts it has not seen
comes the class prior, the share of good texts among the unmarked: the least ratio, over thresholds, of
the shares of unmarked and of trusted texts above the threshold. A second network then minimises the
non-negative unbiased risk: the loss of trusted texts as good, weighted by the prior, and the loss of
unmarked texts as bad less that of trusted texts as bad, which is kept from falling below zero."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tankwise.llm.bpe import small
from tankwise.llm.common import picked
from tankwise.llm.language import in_fold
from tankwise.session import release, stage

#: Different trusted and unmarked texts that the networks learn from at most.
POSITIVES = 10_000
UNLABELLED = 20_000
HIDDEN = 24
EPOCHS = 60
_BATCH = 512
_RATE = 0.01
_CLASSES = np.zeros(256, np.int64)  # kinds of bytes: other, upper, lower, digit, space, mark, beyond ASCII
_CLASSES[ord("A") : ord("Z") + 1] = 1
_CLASSES[ord("a") : ord("z") + 1] = 2
_CLASSES[ord("0") : ord("9") + 1] = 3
_CLASSES[[9, 10, 11, 12, 13, 32]] = 4
_CLASSES[[b for b in range(33, 127) if _CLASSES[b] == 0]] = 5
_CLASSES[128:] = 6
FEATURES = 24


def features(text: str) -> list[float]:
    """Numbers that describe a whole text; all finite, and small for long texts too."""
    data = text.encode()
    kinds = np.bincount(_CLASSES[np.frombuffer(data, np.uint8)], minlength=7) / max(len(data), 1)
    words = text.split()
    n = len(words)
    lower = text.lower().split()
    distinct = set(lower)
    pairs = set(zip(lower, lower[1:]))
    triples = set(zip(lower, lower[1:], lower[2:]))
    lines = text.split("\n")
    twice = sum(a == b for a, b in zip(lower, lower[1:]))
    lengths = np.fromiter(map(len, lower), np.float64, len(lower)) if lower else np.zeros(1)
    upper = sum(map(str.isupper, words))
    marks = [text.count(m) / max(n, 1) for m in ("!", "?", ".", ",")]
    return [
        *kinds.tolist(),
        math.log1p(n) / 10,
        len(distinct) / max(n, 1),
        len(pairs) / max(n - 1, 1),
        len(triples) / max(n - 2, 1),
        math.log1p(len(distinct)) / 10,
        twice / max(n - 1, 1),
        float(min(lengths.mean(), 50)) / 10,
        float(min(lengths.std(), 50)) / 10,
        upper / max(n, 1),
        len(set(lines)) / len(lines),
        sum(not any(map(str.isalnum, w)) for w in words) / max(n, 1),  # words of marks alone
        sum(len(w) == 1 for w in words) / max(n, 1),
        *(min(m, 2.0) for m in marks),
        min(len(lines) / max(n, 1), 1.0),
    ]


@dataclass
class Net:
    """One hidden layer over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    parts: list[np.ndarray]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log odds."""
        return self._forward((x - self.mean) / self.scale)[1]

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w1, b1, w2, b2 = self.parts
        hidden = np.tanh(x @ w1 + b1)
        return hidden, hidden @ w2 + b2[0]

    def gradient(self, x: np.ndarray, hidden: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        _, _, w2, _ = self.parts
        back = slope[:, None] * w2 * (1 - hidden**2)
        return [x.T @ back, back.sum(axis=0), hidden.T @ slope, np.array([slope.sum()])]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def fit_network(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, epochs: int = EPOCHS, seed: int = 3) -> Net:
    """With a prior: minimise the non-negative unbiased risk of the logistic loss. Without: tell the two
    sets apart (each with half the weight)."""
    rng = np.random.default_rng(seed)
    every = np.concatenate([positive, unlabelled])
    net = Net(
        every.mean(axis=0),
        np.maximum(every.std(axis=0), 1e-3),
        [
            rng.normal(0, 1 / math.sqrt(FEATURES), (FEATURES, HIDDEN)),
            np.zeros(HIDDEN),
            rng.normal(0, 1 / math.sqrt(HIDDEN), HIDDEN),
            np.zeros(1),
        ],
    )
    p, u = (positive - net.mean) / net.scale, (unlabelled - net.mean) / net.scale
    first = [np.zeros_like(w) for w in net.parts]
    second = [np.zeros_like(w) for w in net.parts]
    rounds = max(1, -(-max(len(p), len(u)) // _BATCH))
    step = 0
    for _ in range(epochs):
        for _ in range(rounds):
            x = p[rng.integers(0, len(p), min(_BATCH, len(p)))]
            y = u[rng.integers(0, len(u), min(_BATCH, len(u)))]
            hx, zx = net._forward(x)
            hy, zy = net._forward(y)
            good_p = -_sigmoid(-zx) / len(x)  # slopes of the losses' means
            bad_p, bad_u = _sigmoid(zx) / len(x), _sigmoid(zy) / len(y)
            if prior is None:
                slopes = 0.5 * good_p, 0.5 * bad_u
            elif _softplus(zy).mean() - prior * _softplus(zx).mean() >= 0:
                slopes = prior * (good_p - bad_p), bad_u
            else:  # the negative part has gone below zero: step back from it
                slopes = prior * bad_p, -bad_u
            gradients = [a + b for a, b in zip(net.gradient(x, hx, slopes[0]), net.gradient(y, hy, slopes[1]))]
            step += 1
            rate = _RATE * (1 - step / (epochs * rounds + 1))
            for w, g, m, v in zip(net.parts, gradients, first, second):
                g = g + 1e-4 * w
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> float:
    """Share of positives among the unlabelled, from scores on the half of each set not trained on.

    The ratio of shares above a threshold is at most by chance below the prior, so both shares get a margin
    that shrinks with the number of texts; few texts make the estimate cautious (larger)."""
    net = fit_network(positive[::2], unlabelled[::2], None, epochs, seed)
    p, u = np.sort(net.scores(positive[1::2])), np.sort(net.scores(unlabelled[1::2]))
    if not len(p) or not len(u):
        return 0.5
    cuts = np.unique(np.concatenate([p, u]))
    above_p = 1 - np.searchsorted(p, cuts, "left") / len(p)
    above_u = 1 - np.searchsorted(u, cuts, "left") / len(u)
    margin = math.sqrt(math.log(20) / (2 * len(u))) + math.sqrt(math.log(20) / (2 * len(p)))
    use = above_p > margin
    if not use.any():  # too few texts to tell
        return 0.5
    at = np.argmin((above_u[use] + margin) / above_p[use])
    return float(np.clip(above_u[use][at] / above_p[use][at], 0.01, 0.99))


@dataclass
class Model:
    net: Net
    prior: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.net.scores(x))


def fit(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 3) -> Model | None:
    """None if there are fewer than two texts of either kind."""
    if len(positive) < 2 or len(unlabelled) < 2:
        return None
    prior = class_prior(positive, unlabelled, seed=seed)
    return Model(fit_network(positive, unlabelled, prior, seed=seed), prior)


def _described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: features of each different text that a task meets."""
    seen = set()
    for part in small(batches):
        digests = part.column("digest").to_pylist()
        fresh = [at for at, digest in enumerate(digests) if not (digest in seen or seen.add(digest))]
        part = part.take(pa.array(fresh, pa.int64()))
        found = [features(t) for t in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array(found, pa.list_(pa.float64()))], ["digest", "x"])


def _sampled(keys: DataFrame, texts: DataFrame, most: int) -> np.ndarray:
    """Features of at most ``most`` different texts, those whose digests in ``keys`` have the least hashes,
    in an order of their own."""
    chosen = stage(keys.select("digest").distinct().orderBy(F.xxhash64("digest"), "digest").limit(most))
    drawn = texts.select("digest", "text").join(F.broadcast(chosen), "digest")
    # Features, not texts, are brought together.
    rows = drawn.mapInArrow(_described, "digest binary, x array<double>").distinct().toArrow()
    release(chosen)
    found = np.array(rows.column("x").to_pylist(), float).reshape(-1, FEATURES)
    return found[np.lexsort(found.T)][np.random.default_rng(11).permutation(len(found))]


def learn(
    docs: DataFrame,
    labels: DataFrame,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    id: str = "doc_id",
    text: str = "text",
    label_id: str = "doc_id",
    label: str = "quality",
) -> Model | None:
    """Learn from the texts of ``docs`` and the ids that ``labels`` marks as good (1 in every row of the
    id). Ids marked otherwise serve as unmarked texts, like all others. At most ``positives`` and
    ``unlabelled`` different texts are used, however many rows repeat one or share an id. Null texts count as
    empty. None if there are too few."""
    texts = picked(docs, doc_id=id, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    texts = texts.withColumn("digest", F.unhex(F.sha2("text", 256)))
    keys = stage(texts.select("doc_id", "digest").distinct())
    marked = picked(labels, doc_id=label_id, label=label).groupBy("doc_id").agg(F.min("label").alias("label"))
    good = marked.filter("label = 1").select("doc_id")
    p = _sampled(keys.join(good, "doc_id", "left_semi"), texts, positives)
    u = _sampled(keys, texts, unlabelled)
    release(keys)
    return fit(p, u)


def score(docs: DataFrame, model: Model | None, threshold: float = 0.3, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` for every row, from the whole text.

    A null text counts as empty; an empty text has features, and a score, like any other. Without a model
    (nothing to learn from) every score is 0.5. Rows given twice give two rows; an empty table none;
    further columns play no part."""
    rows = picked(docs, doc_id=id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            if not len(part):
                continue
            x = np.array([features(t or "") for t in part.column("text").to_pylist()])
            # Rounded, since the last bits depend on the rows that a product is worked out with.
            p = np.full(len(x), 0.5) if model is None else np.round(model.probability(x), 9)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``, learnt from ids that are not held out (CRC-32 of the id as
    text, modulo 5, not 0)."""
    held_out = in_fold(F.col("doc_id"), 5, 0)
    model = learn(docs.filter(~held_out), labels.filter(~held_out))
    return score(docs, model).withColumn("held_out", held_out)
