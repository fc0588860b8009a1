"""Language identification by a convolutional network over bytes.

Bytes of lower-cased text are embedded, filters of several widths run over windows of fixed length, each
filter's largest response in the window is kept, and a softmax layer turns these into probabilities. A
text is cut into windows to its end, and its probabilities are the mean over its windows, weighted by the
bytes in them. The network is trained in numpy on windows of a bounded sample of labelled texts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tankwise.llm.bpe import small
from tankwise.llm.common import picked
from tankwise.session import release, stage

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 10
EMBEDDING = 6
#: Different texts that the network learns from at most, of one language and in all, and windows of each.
TEXTS_PER_LANGUAGE = 2_000
TEXTS = 10_000
WINDOWS_PER_TEXT = 3
UNKNOWN = "und"
EPOCHS = 12
_BATCH = 128
_RATE = 0.01


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING; byte 0, the padding, stays zero
    filters: np.ndarray  # (widest * EMBEDDING) x all filters
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Largest response of each filter, where it is, and the unrolled input."""
        widest = max(WIDTHS)
        embedded = self.embedding[windows]
        n, length, width = embedded.shape
        s = embedded.strides
        unrolled = np.lib.stride_tricks.as_strided(
            embedded, (n, length - widest + 1, widest * width), (s[0], s[1], s[2])
        )
        responses = (unrolled.reshape(-1, widest * width) @ self.filters).reshape(n, length - widest + 1, -1)
        return responses, unrolled, embedded

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        best = self.pooled(windows)[0].max(axis=1)
        return _softmax(np.maximum(best + self.bias, 0) @ self.dense + self.offset)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 5) -> Network:
    """Fit by Adam on the cross entropy, classes weighted alike."""
    rng = np.random.default_rng(seed)
    widest, total = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((widest * EMBEDDING, total), np.float32)
    for k, width in enumerate(WIDTHS):  # narrower filters have zeros at the end
        mask[: width * EMBEDDING, k * FILTERS : (k + 1) * FILTERS] = 1
    draw = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
    net = Network(
        languages,
        draw(256, EMBEDDING) * np.float32(0.3),
        draw(widest * EMBEDDING, total) * mask * np.float32(0.3),
        np.zeros(total, np.float32),
        draw(total, len(languages)) * np.float32(0.3),
        np.zeros(len(languages), np.float32),
    )
    net.embedding[0] = 0
    weights = 1 / np.maximum(np.bincount(labels, minlength=len(languages)), 1)
    weights = (weights / weights[labels].mean()).astype(np.float32)
    parts = [net.embedding, net.filters, net.bias, net.dense, net.offset]
    first = [np.zeros_like(p) for p in parts]
    second = [np.zeros_like(p) for p in parts]
    step, steps = 0, epochs * -(-len(windows) // _BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for start in range(0, len(order), _BATCH):
            rows = order[start : start + _BATCH]
            gradients = _gradients(net, windows[rows], labels[rows], weights[labels[rows]], mask)
            step += 1
            rate = _RATE * (1 - step / (steps + 1))
            for p, g, m, v in zip(parts, gradients, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            net.embedding[0] = 0
    return net


def _gradients(net: Network, windows, labels, weights, mask) -> list[np.ndarray]:
    responses, unrolled, _ = net.pooled(windows)
    n, _, total = responses.shape
    at = responses.argmax(axis=1)
    raw = np.take_along_axis(responses, at[:, None, :], 1)[:, 0] + net.bias
    hidden = np.maximum(raw, 0)
    error = _softmax(hidden @ net.dense + net.offset)
    error[np.arange(n), labels] -= 1
    error *= weights[:, None] / n
    back = (error @ net.dense.T) * (raw > 0)  # n x filters
    inputs = unrolled[np.arange(n)[:, None], at]  # n x filters x unrolled
    filters = np.einsum("nf,nfk->kf", back, inputs) * mask
    into = np.einsum("nf,kf->nfk", back, net.filters).reshape(-1, EMBEDDING)
    places = at[:, :, None] + np.arange(max(WIDTHS))
    letters = windows[np.arange(n)[:, None, None], places].ravel()
    embedding = np.zeros_like(net.embedding)
    np.add.at(embedding, letters, into)
    return [embedding, filters, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]


def windowed(texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts, the text each belongs to, and the number of bytes in it."""
    texts = list(texts)
    counts = np.array([max(1, -(-len(t) // WINDOW)) for t in texts])
    flat = np.zeros(int(counts.sum()) * WINDOW, np.uint8)
    sizes = []
    at = 0
    for text, count in zip(texts, counts.tolist()):
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
        sizes += [WINDOW] * (count - 1) + [len(text) - (count - 1) * WINDOW]
        at += count * WINDOW
    return flat.reshape(-1, WINDOW), np.repeat(np.arange(len(texts)), counts), np.array(sizes)


def predict(net: Network, texts: list[bytes], step: int = 256) -> tuple[list[str], list[float]]:
    """Likeliest language of each text and its mean probability."""
    sums = np.zeros((len(texts), len(net.languages)))
    weight = np.zeros(len(texts))
    group: list[bytes] = []
    start = 0

    def settle() -> None:
        windows, owner, sizes = windowed(group)
        for k in range(0, len(windows), step):
            p = net.probabilities(windows[k : k + step]) * sizes[k : k + step, None]
            np.add.at(sums, start + owner[k : k + step], p)
            np.add.at(weight, start + owner[k : k + step], sizes[k : k + step])

    held = 0
    for text in texts:
        group.append(text)
        held += len(text)
        if held > 1 << 20:
            settle()
            start += len(group)
            group, held = [], 0
    if group:
        settle()
    mean = sums / np.maximum(weight, 1)[:, None]
    best = mean.argmax(axis=1)
    return [net.languages[k] for k in best], np.clip(mean[np.arange(len(texts)), best], 0, 1).tolist()


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _sample_windows(seed: int):
    """Task function: some windows of each different text that a task meets, the same wherever it is met."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in small(batches):
            fresh = []
            for at, pair in enumerate(zip(batch.column("lang").to_pylist(), batch.column("digest").to_pylist())):
                if pair not in seen:
                    seen.add(pair)
                    fresh.append(at)
            languages, cut = [], []
            part = batch.take(pa.array(fresh, pa.int64()))
            for lang, text, digest in zip(*(part.column(c).to_pylist() for c in ("lang", "text", "digest"))):
                data = text.lower().encode()
                rng = np.random.default_rng([seed, int.from_bytes(digest[:4], "little")])
                for _ in range(WINDOWS_PER_TEXT if len(data) > WINDOW else 1):
                    at = int(rng.integers(0, max(1, len(data) - WINDOW + 1)))
                    languages.append(lang)
                    cut.append(data[at : at + WINDOW])
            yield pa.RecordBatch.from_arrays([pa.array(languages, pa.string()), pa.array(cut, pa.binary())], ["lang", "data"])

    return run


def _examples(usable: DataFrame, per_language: int, most: int) -> DataFrame:
    """Staged ``lang, digest`` of the different texts to learn from: of each language those of least hash, as
    many as there is room for, so that copies of one text count once and none is left out by chance. With
    more languages than ``most``, those with the most texts."""
    distinct = stage(usable.select("lang", "digest").distinct())
    counts = distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    chosen = counts.orderBy(F.desc("n"), "lang").limit(most)
    quota = max(1, min(per_language, most // max(1, chosen.count())))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("digest"), "digest"))
    # Every task passes on at most ``quota`` texts of a language.
    first = distinct.withColumn("place", place).filter(F.col("place") <= quota)
    kept = stage(first.join(F.broadcast(chosen.select("lang")), "lang").select("lang", "digest"))
    release(distinct)
    return kept


def learn(labelled: DataFrame, per_language: int = TEXTS_PER_LANGUAGE, seed: int = 5, most: int = TEXTS) -> Network | None:
    """Train on ``lang, text`` rows; at most ``per_language`` different texts of a language are used, and
    ``most`` in all, which any number of languages share. Rows without a language or without a letter are
    passed over. None if nothing is left to learn from."""
    usable = labelled.filter(F.col("lang").isNotNull() & has_letter(F.col("text")))
    usable = usable.withColumn("digest", F.unhex(F.sha2("text", 256)))
    chosen = _examples(usable, per_language, most)  # at most ``most`` rows
    sample = usable.join(F.broadcast(chosen), ["lang", "digest"]).select("lang", "digest", "text")
    # Windows, not texts, are brought together.
    found = sample.mapInArrow(_sample_windows(seed), "lang string, data binary").distinct().sort("lang", "data").toArrow()
    windows = np.zeros((found.num_rows, WINDOW), np.uint8)
    for row, data in enumerate(found.column("data").to_pylist()):
        windows[row, : len(data)] = np.frombuffer(data, np.uint8)
    release(chosen)
    languages = sorted(set(found.column("lang").to_pylist()))
    number = {lang: k for k, lang in enumerate(languages)}
    labels = np.array([number[lang] for lang in found.column("lang").to_pylist()])
    if not len(labels):
        return None
    return train(windows, labels, languages, seed=seed)


def annotate(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``row`` (all columns of the input as a struct), ``lang_pred`` and ``score`` for each row.

    A null text, an empty one or one without letters is ``und`` with score 0; so is every text where there
    was nothing to learn from. Whole texts are read, however long."""
    whole = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")
    rows = docs.select(whole, has_letter(F.col(f"`{text}`")).alias("known"))
    if net is None:
        return rows.select("row", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    place = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            at = np.flatnonzero(batch.column("known").to_numpy(zero_copy_only=False))
            texts = batch.column("row").field(place).take(pa.array(at)).to_pylist()
            found = [UNKNOWN] * len(batch)
            scores = [0.0] * len(batch)
            for k, lang, score in zip(at, *predict(net, [t.lower().encode() for t in texts])):
                found[k], scores[k] = lang, score
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                ["row", "lang_pred", "score"],
            )

    schema = T.StructType(
        [rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return rows.mapInArrow(run, schema)


def in_fold(id: Column, folds: int, fold: int) -> Column:
    """Whether the CRC-32 of an id, written as text, has a remainder (null ids: remainder of no text)."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def identify(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row, learnt from the rows that are not held out.

    Null and empty texts, and those without a letter, are ``und``; whole texts are read, however long. Rows
    given twice give two rows, an empty table none; further columns play no part."""
    rows = picked(docs, doc_id=id, text=text, lang=lang).withColumn("held_out", in_fold(F.col("doc_id"), 4, 2))
    net = learn(rows.filter(~F.col("held_out")).select("lang", "text"))
    found = annotate(rows.select("doc_id", "text", "held_out"), net)
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score")


def keep_known(docs: DataFrame, net: Network | None) -> DataFrame:
    """The documents whose language can be told: not ``und``, whatever the score, as its size depends on the
    number of languages; all columns as they were. Where there was nothing to learn from, all documents with
    a letter."""
    if net is None:
        return docs.filter(has_letter(F.col("text")))
    return annotate(docs, net).filter(F.col("lang_pred") != UNKNOWN).select("row.*")
