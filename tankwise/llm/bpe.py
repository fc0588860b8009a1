"""Byte-pair encoding with word ends, and decoding.

The merges of a piece run by a priority queue of (rank, place) over a doubly linked list of symbols:
taking the best entry joins its two symbols, unlinks the right one, and queues the new neighbours; an
entry whose symbols have changed since it was queued is stale and skipped. Decoding joins vocabulary
strings. A file that names no decoder has them joined by a space.

White space never takes part in a token, so a text is a sequence of space-separated chunks whose ids do
not depend on each other. Ids of chunks are kept by the process in a cache of bounded size."""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from tankwise.llm.common import fresh, picked

#: Chunks or pieces that one cache generation holds; two generations are kept.
CACHE = 100_000

# What counts as white space in the tokenizer's patterns.
_SPACE = r"\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Characters below this one are Latin, without combining marks.
_LATIN = "\u0180"
_BEYOND = re.compile(f"[{_LATIN}-\U0010ffff]")
_SPACES = regex.compile(f"[{_SPACE}]+")
#: str.split() also splits at these, which the tokenizer takes for ordinary characters.
_NOT_SPACE = regex.compile("[\x1c-\x1f]")


@functools.lru_cache(maxsize=None)
def _members(kind: str) -> str:
    """The characters of a general category (L or N) as a character class, as the tokenizers library knows
    them: Python and the regex module follow other Unicode versions, with fewer or more letters."""
    known = regex.findall(f"[\\p{{{kind}}}]", "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000)))))
    older = {c for c in known if unicodedata.category(c)[0] == kind}
    doubtful = [c for c in known if c not in older]
    split = pre_tokenizers.Split(tokenizers.Regex(f"[\\p{{{kind}}}]"), "removed", invert=True)
    members = older | {c for piece, _ in split.pre_tokenize_str(" ".join(doubtful)) for c in piece}
    points = sorted(map(ord, members))
    ranges, start = [], points[0]
    for last, following in zip(points, points[1:] + [-1]):
        if following != last + 1:
            ranges.append(f"\\U{start:08x}-\\U{last:08x}")
            start = following
    return "".join(ranges)


def piece_pattern(written: str) -> regex.Pattern:
    """A splitting pattern with its letters and numbers spelled out."""
    for kind in "LN":
        members = _members(kind)
        written = written.replace(f"[\\p{{{kind}}}]", f"[{members}]").replace(f"\\p{{{kind}}}", members)
    return regex.compile(written.replace("\\s", _SPACE))


def latin_pattern(written: str) -> re.Pattern:
    """The same for lower-cased texts of Latin characters, for the faster engine."""
    every = [chr(p) for p in range(ord(_LATIN))]
    for kind in "LN":
        members = "".join(re.escape(c) for c in every if unicodedata.category(c)[0] == kind)
        written = written.replace(f"[\\p{{{kind}}}]", f"[{members}]").replace(f"\\p{{{kind}}}", members)
    return re.compile(written.replace("\\s", _SPACE))


class Cache(dict):
    """A mapping that works out missing values. When a generation is full it becomes the old one, and
    what is asked for again moves to the new one; so memory is bounded and frequent keys stay."""

    def __init__(self, make: Callable, size: int = CACHE) -> None:
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def knows(self, key) -> bool:
        return key in self or key in self.old

    def put(self, key, value) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself for visible Latin-1, else the next of
    those from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(rest)) for b in range(256)]


def chunks_of(text: str) -> list[str]:
    """The parts of a text between white space."""
    if _NOT_SPACE.search(text):
        return [chunk for chunk in _SPACES.split(text) if chunk]
    return text.split()


class Tokenizer:
    """An encoder and decoder read from a tokenizer file (byte-level BPE with an end-of-word mark)."""

    def __init__(self, written: str) -> None:
        definition = json.loads(written)
        # Unicode normalisation and case: what Python does differs in a few hundred characters.
        self.normalize = tokenizers.Tokenizer.from_str(written).normalizer.normalize_str
        model = definition["model"]
        vocabulary = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        added = {t["content"]: t["id"] for t in definition["added_tokens"]}
        self.strings = {number: string for string, number in {**vocabulary, **added}.items()}
        self.added = added
        #: Rank of a pair of ids, and the id that each rank makes.
        self.ranks, self.made = {}, []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocabulary[left] << 32 | vocabulary[right]] = rank
            self.made.append(vocabulary[left + right])
        letters = byte_letters()
        self.inner = [vocabulary.get(letter) for letter in letters]
        self.final = [vocabulary.get(letter + self.end) for letter in letters]
        written = definition["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.piece, self.latin = piece_pattern(written), latin_pattern(written)
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")")
        self.pieces = Cache(self._merged)
        self.chunks = Cache(self._chunk)

    def merge(self, symbols: list[int]) -> list[int]:
        """Apply the merges to a sequence of ids."""
        n, ranks = len(symbols), self.ranks
        symbols = list(symbols)
        queue = [
            rank << 32 | at
            for at in range(n - 1)
            if (rank := ranks.get(symbols[at] << 32 | symbols[at + 1])) is not None
        ]
        heapq.heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            entry = heapq.heappop(queue)
            at, rank = entry & 0xFFFFFFFF, entry >> 32
            right = after[at]
            # Stale: the left symbol is gone (-1), or one of the two has changed since.
            if right >= n or symbols[at] < 0 or ranks.get(symbols[at] << 32 | symbols[right]) != rank:
                continue
            symbols[at] = now = self.made[rank]
            symbols[right] = -1
            after[at] = following = after[right]
            if following < n:
                before[following] = at
                rank = ranks.get(now << 32 | symbols[following])
                if rank is not None:
                    heapq.heappush(queue, rank << 32 | at)
            previous = before[at]
            if previous >= 0:
                rank = ranks.get(symbols[previous] << 32 | now)
                if rank is not None:
                    heapq.heappush(queue, rank << 32 | previous)
        return [symbol for symbol in symbols if symbol >= 0]

    def _merged(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        symbols = [self.inner[b] for b in data]
        symbols[-1] = self.final[data[-1]]
        return tuple(self.merge(symbols))

    def split(self, chunk: str) -> list[str]:
        """The pieces of a text without white space and special tokens."""
        if chunk.isascii() or not _BEYOND.search(chunk):  # nothing to compose, and all Unicode versions agree on the letters
            lower = chunk.lower()
            return [lower] if lower.isalpha() else self.latin.findall(lower)
        return self.piece.findall(self.normalize(chunk))

    def pieces_of(self, text: str) -> list[str]:
        """The pieces of a whole text without special tokens."""
        if text.isascii() or not _BEYOND.search(text):
            return self.latin.findall(text.lower())
        return [piece for chunk in chunks_of(text) for piece in self.split(chunk)]

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        found: list[int] = []
        for piece in self.split(chunk):
            found += self.pieces[piece]
        return tuple(found)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, without truncation, padding or added marks."""
        found: list[int] = []
        if "<|" in text:
            for part in self.special.split(text):
                if part in self.added:
                    found.append(self.added[part])
                elif part:
                    self._plain(part, found)
        else:
            self._plain(text, found)
        return found

    def _plain(self, text: str, found: list[int]) -> None:
        for ids in map(self.chunks.__getitem__, chunks_of(text)):
            found += ids

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join(map(self.strings.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    """The tokenizer of a file, once per process."""
    return Tokenizer(Path(path).read_text(encoding="utf-8"))


def little_endian(ids: list[int]) -> bytes:
    import numpy as np

    return np.array(ids, "<u4").tobytes()


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``ids`` (array of int) and ``decoded`` (text of these ids).

    A null or empty text has no ids and decodes to an empty text. Rows given twice give two rows; further
    columns of the input play no part. ``path`` names a tokenizer file that every executor has."""
    rows = picked(docs, doc_id=id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for part in small(batches):
            ids = [tokenizer.encode(t or "") for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array([tokenizer.decode(x) for x in ids], pa.string()),
                ],
                ["doc_id", "ids", "decoded"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def fingerprints(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the number of ids and digests of the ids and of the decoded text.

    The same encoding and decoding as :func:`encode`, digested where they are made."""
    rows = picked(docs, doc_id=id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for part in small(batches):
            n, ids_digest, text_digest = [], [], []
            for t in part.column("text").to_pylist():
                ids = tokenizer.encode(t or "")
                n.append(len(ids))
                ids_digest.append(hashlib.sha256(little_endian(ids)).hexdigest())
                text_digest.append(hashlib.sha256(tokenizer.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_digest), pa.array(text_digest)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def small(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Slices of batches, so that few texts exist as Python objects at a time."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.slice(start, rows)


def with_counts(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of the input, and ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    An input column of one of these names is replaced."""
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    keep = docs.drop(*names)
    (holder,) = fresh(keep, "row")
    struct = F.struct(*(F.col(f"`{name}`") for name in keep.columns)).alias("doc_id")
    coded = fingerprints(keep.select(struct, F.col(f"`{text}`").alias(holder)), path, "doc_id", holder)
    return coded.select("doc_id.*", *names)
