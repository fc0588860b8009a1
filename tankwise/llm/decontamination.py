"""Benchmark passages in documents, by a prefix-filtered join of word shingles.

A window is ``window`` consecutive words of a benchmark item (a shorter item is one window). To contain a
window a text must contain every shingle of the window, so it is enough to look for one of them: the
prefix of a containment of all shingles is a single shingle. Shingles are ordered by how often they occur
in all documents, and each window is filed under its rarest one with the place it has in the window.
Where a document has that shingle, the place fixes where the window would have to start; it must start
and end inside the document (the bounds by position and length), and is then compared word by word over
exactly its own length."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tankwise.llm.bytewords import ALPHANUMERIC, Chunk, chunks
from tankwise.llm.common import fresh, picked, text_digest
from tankwise.session import release, stage

WINDOW = 10
SHINGLE = 3
#: Bytes of benchmark text that one broadcast index may cover; more text is handled in several passes.
BLOCK_BYTES = 4_000_000

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_SLOTS = 1 << 16


def item_words(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode().lower())


@dataclass
class Index:
    """Windows of one block of the benchmark, filed under their rarest shingle."""

    items: list[str]
    windows: list[bytes]
    lengths: np.ndarray
    owners: list[list[int]]
    #: By shingle size: sorted distinct shingle hashes, and for each the (window, place) pairs under it.
    prefixes: dict[int, tuple[np.ndarray, list[list[tuple[int, int]]]]]


def windows_of(items: Iterable[tuple[str, str]], window: int) -> dict[tuple[bytes, ...], list[int]]:
    """Distinct windows with the numbers of the items that have them."""
    found: dict[tuple[bytes, ...], list[int]] = {}
    for number, (_, text) in enumerate(items):
        words = item_words(text)
        for start in range(max(1, len(words) - window + 1) if words else 0):
            owners = found.setdefault(tuple(words[start : start + window]), [])
            if not owners or owners[-1] != number:
                owners.append(number)
    return found


def _window_shingles(windows: Iterable[tuple[bytes, ...]], shingle: int) -> list[tuple[int, np.ndarray]]:
    """Per window: size of its shingles and their hashes."""
    windows = list(windows)
    texts = pa.array([b" ".join(w).decode() for w in windows], pa.large_string())
    made = []
    for chunk in chunks(texts, ALPHANUMERIC):
        by_size = {size: chunk.shingles(size) for size in range(1, shingle + 1)}
        for i in range(chunk.texts):
            first, end = chunk.first[i], chunk.first[i + 1]
            size = min(shingle, end - first)
            made.append((size, by_size[size][first : end - size + 1]))
    return made


class _Lookup:
    """Places of a chunk whose shingle is one of a sorted set: a small table first, then a search."""

    def __init__(self, wanted: np.ndarray) -> None:
        self.wanted = wanted
        self.slots = np.zeros(_SLOTS, bool)
        self.slots[(wanted >> np.uint64(48)).astype(np.int64)] = True

    def __call__(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.slots[(shingles >> np.uint64(48)).astype(np.int64)])
        rank = np.minimum(np.searchsorted(self.wanted, shingles[at]), max(len(self.wanted) - 1, 0))
        right = self.wanted[rank] == shingles[at]
        return at[right], rank[right]


def shingle_counts(docs: DataFrame, wanted: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """How often each of the wanted shingles (by size, sorted) occurs in all documents.

    Occurrences across the border of two texts that lie next to each other in memory may be counted too;
    counts only order shingles, so that doesn't matter."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookups = {size: _Lookup(values) for size, values in wanted.items() if len(values)}
        totals = {size: np.zeros(len(wanted[size]), np.int64) for size in lookups}
        for batch in batches:
            for chunk in chunks(batch.column(0), ALPHANUMERIC):
                for size, lookup in lookups.items():
                    _, rank = lookup(chunk.shingles(size))
                    totals[size] += np.bincount(rank, minlength=len(totals[size]))
        for size, counted in totals.items():
            seen = np.flatnonzero(counted)
            yield pa.RecordBatch.from_pydict(
                {"size": pa.array(np.full(len(seen), size, np.int32)), "at": seen, "n": counted[seen]}
            )

    counted = docs.select("text").mapInArrow(run, "size int, at long, n long")
    totals = {size: np.zeros(len(values), np.int64) for size, values in wanted.items()}
    for row in counted.groupBy("size", "at").agg(F.sum("n").alias("n")).collect():  # at most one per shingle
        totals[row["size"]][row["at"]] = row["n"]
    return totals


def build_index(docs: DataFrame, items: list[tuple[str, str]], window: int, shingle: int) -> Index:
    found = windows_of(items, window)
    shingles = _window_shingles(found, shingle)
    wanted = {
        size: np.unique(np.concatenate([h for s, h in shingles if s == size] or [np.zeros(0, np.uint64)]))
        for size in range(1, shingle + 1)
    }
    wanted = {size: values for size, values in wanted.items() if len(values)}
    counts = shingle_counts(docs, wanted) if wanted else {}
    filed: dict[int, dict[int, list[tuple[int, int]]]] = {size: {} for size in wanted}
    for number, (size, hashes) in enumerate(shingles):
        times = counts[size][np.searchsorted(wanted[size], hashes)]
        place = min(range(len(hashes)), key=lambda i: (times[i], int(hashes[i])))
        filed[size].setdefault(int(hashes[place]), []).append((number, place))
    return Index(
        items=[name for name, _ in items],
        windows=[b" ".join(words) for words in found],
        lengths=np.array([len(words) for words in found], np.int64),
        owners=list(found.values()),
        prefixes={
            size: (np.array(sorted(under), np.uint64), [under[h] for h in sorted(under)])
            for size, under in filed.items()
        },
    )


def _occurrences(chunk: Chunk, index: Index, lookups: dict[int, _Lookup]) -> Iterator[tuple[int, int, int, int]]:
    """(text, first word, length, window) of every verified occurrence."""
    for size, lookup in lookups.items():
        at, rank = lookup(chunk.shingles(size))
        text = np.searchsorted(chunk.first, at, "right") - 1
        under = index.prefixes[size][1]
        for where, which, i in zip(at.tolist(), rank.tolist(), text.tolist()):
            low, high = chunk.first[i], chunk.first[i + 1]
            for number, place in under[which]:
                start, length = where - place, int(index.lengths[number])
                if low <= start and start + length <= high and chunk.words(start, length) == index.windows[number]:
                    yield i, start, length, number


def _matcher(index: Index):
    """Per document: number of words, hit words as flat [start, end) pairs, items found."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookups = {size: _Lookup(values) for size, (values, _) in index.prefixes.items()}
        for batch in batches:
            n_words = np.zeros(len(batch), np.int64)
            spans: list[list[int]] = [[] for _ in range(len(batch))]
            items: list[set[str]] = [set() for _ in range(len(batch))]
            for chunk in chunks(batch.column("text"), ALPHANUMERIC):
                n_words[chunk.row : chunk.row + chunk.texts] = np.diff(chunk.first)
                hits: dict[int, set[tuple[int, int]]] = {}
                for i, start, length, number in _occurrences(chunk, index, lookups):
                    first = int(chunk.first[i])
                    hits.setdefault(i, set()).add((start - first, start - first + length))
                    items[chunk.row + i].update(index.items[owner] for owner in index.owners[number])
                for i, found in hits.items():
                    spans[chunk.row + i] = _merged(found)
            columns = [c for name, c in zip(batch.schema.names, batch.columns) if name != "text"]
            names = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *columns,
                    pa.array(n_words),
                    pa.array(spans, pa.list_(pa.int64())),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                ],
                [*names, "n_words", "spans", "items"],
            )

    return run


def _merged(spans: Iterable[tuple[int, int]]) -> list[int]:
    """Union of [start, end) spans, flattened."""
    flat: list[int] = []
    for start, end in sorted(spans):
        if flat and start <= flat[-1]:
            flat[-1] = max(flat[-1], end)
        else:
            flat += [start, end]
    return flat


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``spans`` (hit words as flat [start, end) pairs of
    word numbers) and ``items`` (ids, as strings, of the items with windows in it, sorted).

    Letters A-Z count as lower case. A null or empty text has no words and no hits, and a null or empty
    item no windows. A null item id counts as the empty string; rows that repeat an item id count as one
    item. Rows that repeat a document give a row each. The benchmark is read in blocks of at most about
    ``block_bytes`` of text (one item is never cut), each broadcast and matched in a pass of its own, so
    that its size is bounded whatever the benchmark's is."""
    texts = picked(docs, doc_id=id, text=text)
    found = _passages(texts, benchmark, item_id, item_text, window, shingle, block_bytes)
    return found.select("doc_id", "n_words", "spans", "items")


def _passages(
    texts: DataFrame,
    benchmark: DataFrame,
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """:func:`find_passages` of ``doc_id, text`` and perhaps ``digest``, which is kept; of several blocks
    there is a digest in any case."""
    bench = picked(benchmark, item_id=item_id, text=item_text).select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    size = bench.agg(F.sum(F.octet_length("text") + F.octet_length("item_id"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    if blocks > 1 and "digest" not in texts.columns:
        texts = texts.withColumn("digest", text_digest("text"))
    parts, number = [], F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for block in range(blocks):
        rows = bench.filter(number == block).distinct().sort("item_id", "text").collect()
        index = build_index(texts, [(r["item_id"], r["text"]) for r in rows], window, shingle)
        parts.append(_matched(texts, index))
    if blocks == 1:
        return parts[0]
    return _combined(parts)


def _matched(texts: DataFrame, index: Index) -> DataFrame:
    kept = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in texts.drop("text").schema)
    return texts.mapInArrow(_matcher(index), f"{kept}n_words long, spans array<long>, items array<string>")


def _combined(parts: list[DataFrame]) -> DataFrame:
    """Hits of several passes together. Rows of equal id and digest have equal texts, and so equal hits."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    pairs = F.expr("transform(sequence(0, size(spans) - 2, 2), i -> struct(spans[i] AS a, spans[i + 1] AS b))")
    hit = every.filter(F.size("spans") > 0).select(
        "doc_id", "digest", F.explode(pairs).alias("span"), "items"
    )
    gathered = hit.groupBy("doc_id", "digest").agg(
        F.array_sort(F.collect_set("span")).alias("all_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("all_items"),
    )
    merged = F.expr(
        "aggregate(all_spans, array(), (acc, s) -> if(size(acc) > 0 AND s.a <= element_at(acc, -1),"
        " concat(slice(acc, 1, size(acc) - 1), array(greatest(element_at(acc, -1), s.b))),"
        " concat(acc, array(s.a, s.b))))".replace("array()", "cast(array() AS array<long>)")
    )
    gathered = gathered.select(
        F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), merged.alias("_spans"), "all_items"
    )
    return (
        parts[0]
        .join(gathered, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
        .select(
            "doc_id",
            "digest",
            "n_words",
            F.coalesce("_spans", F.expr("cast(array() AS array<long>)")).alias("spans"),
            F.coalesce("all_items", F.expr("cast(array() AS array<string>)")).alias("items"),
        )
    )


def contamination(found: DataFrame) -> DataFrame:
    """Counts and digest of what :func:`find_passages` found."""
    hit = F.expr(
        "aggregate(sequence(0, size(spans) - 1), 0L, (sum, i) -> sum + if(i % 2 = 1, spans[i], -spans[i]))"
    )
    n_hit = F.when(F.size("spans") > 0, hit).otherwise(F.lit(0).cast("long"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents in which no benchmark window occurs, all columns as they were.

    Rows are told apart by id and text, so that rows with a null or shared id stay or go by their own texts."""
    digest, found, hit = fresh(docs, "digest", "found", "hit")
    texts = picked(docs, doc_id=id, text=text).withColumn("digest", text_digest("text"))
    hits = stage(
        _passages(texts, benchmark)
        .filter(F.size("spans") > 0)
        .select(F.col("doc_id").alias(found), F.col("digest").alias(hit))
        .distinct()
    )
    same = F.col(f"`{id}`").eqNullSafe(F.col(found)) & (F.col(digest) == F.col(hit))
    return docs.withColumn(digest, text_digest(text)).join(hits, same, "left_anti").drop(digest)
