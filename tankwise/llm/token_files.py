"""Token ids in binary files.

A shard holds the ids of consecutive documents back to back, as 16-bit numbers where the vocabulary
allows it and 32-bit ones otherwise, then two Elias-Fano sequences: document ids (less the smallest) and
the boundaries of documents in the id array, and a fixed footer. Reading a document takes two selects.

Texts are dealt to shards by ranges of the document id, so shard numbers follow the id order, and the
position of a shard in the whole is the running sum of one number per shard."""

from __future__ import annotations

import functools
import itertools
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tankwise.llm import files
from tankwise.llm.bpe import load, small
from tankwise.llm.common import picked
from tankwise.llm.elias_fano import EliasFano, encode
from tankwise.session import stage

MAGIC = b"TOKSHRD1"
#: magic, bytes of an id, ids, null document ids, smallest document id, bytes of the two sequences
FOOTER = struct.Struct("<8sBQQqQQ")
#: Ids that a reader holds at a time (one document is never cut).
READ_IDS = 1 << 21
#: Bytes of pieces and ids that a cache generation of the library's encoder holds.
CACHE_BYTES = 32 << 20
#: Pieces longer than this are encoded anew each time.
_LONGEST = 1 << 12


class LibraryEncoder:
    """Ids of whole texts by the tokenizers library.

    No token goes beyond a piece of the tokenizer's pattern. Pieces that are not in a cache of bounded bytes
    are given to the library many at a time with spaces between; the last id of each is one with an
    end-of-word mark. Texts in which a special token's string may occur are encoded as they are."""

    def __init__(self, path: str) -> None:
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.width = self.kind.itemsize
        self.own = load(path)
        self.final = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.final[[number for number, string in self.own.strings.items() if string.endswith(self.own.end)]] = True
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def packed(self, ids: Iterable[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        special = ["<|" in text for text in texts]
        parts = [[] if odd else self.own.pieces_of(text) for odd, text in zip(special, texts)]
        known = self._known(set().union(*parts))
        return [
            self.packed(self.whole(text)) if odd else b"".join(map(known.__getitem__, part))
            for odd, text, part in zip(special, texts, parts)
        ]

    def _known(self, pieces: set[str]) -> dict[str, bytes]:
        """Packed ids of all these pieces. When a generation is full it becomes the old one, and what is
        asked for again moves to the new one."""
        found, missing = {}, []
        new, old = self.new.get, self.old.get
        for piece in pieces:
            ids = new(piece)
            if ids is None:
                ids = old(piece)
                if ids is None:
                    missing.append(piece)
                    continue
                self._put(piece, ids)
                new, old = self.new.get, self.old.get
            found[piece] = ids
        for piece, ids in self._encoded(missing):
            found[piece] = ids
            if len(piece) <= _LONGEST:
                self._put(piece, ids)
        return found

    def _put(self, piece: str, ids: bytes) -> None:
        size = len(piece) + len(ids) + 150  # with what Python adds
        if self.held + size > CACHE_BYTES:
            self.old, self.new, self.held = self.new, {}, 0
        self.new[piece] = ids
        self.held += size

    def _encoded(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        if not pieces:
            return iter(())
        ids = np.array(self.whole(" ".join(pieces)), self.kind)
        ends = (np.flatnonzero(self.final[ids]) + 1) * self.width
        if len(ends) != len(pieces):
            raise ValueError("the library cut a piece of the tokenizer's pattern")
        data, cuts = ids.tobytes(), ends.tolist()
        return zip(pieces, map(data.__getitem__, map(slice, [0, *cuts], cuts)))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def _write_shard(out, parts: Iterable[pa.RecordBatch], coder: LibraryEncoder, end_id: int) -> dict:
    """Write one shard of rows in ascending order (null ids first)."""
    end = coder.packed([end_id])
    bounds, ids, nulls, total = [0], [], 0, 0
    rows = (
        pair
        for part in parts
        for pair in zip(
            part.column("doc_id").to_pylist(), coder.encode([t or "" for t in part.column("text").to_pylist()])
        )
    )
    for number, coded in rows:
        coded += end
        out.write(coded)
        total += len(coded) // coder.width
        bounds.append(total)
        if number is None:
            nulls += 1
        else:
            ids.append(number)
    base = ids[0] if ids else 0
    # Unsigned, as ids may be further apart than 2**63.
    offsets = np.array(ids, np.int64).view(np.uint64) - np.array([base], np.int64).view(np.uint64)
    names, borders = encode(offsets), encode(np.array(bounds, np.int64))
    out.write(names)
    out.write(borders)
    out.write(FOOTER.pack(MAGIC, coder.width, total, nulls, base, len(names), len(borders)))
    return {"documents": len(bounds) - 1, "ids": total}


class Shard:
    """A shard file opened for reading: only the footer and the two sequences are held."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        source.seek(size - FOOTER.size)
        magic, self.width, self.ids, self.nulls, self.base, names, borders = FOOTER.unpack(source.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        source.seek(size - FOOTER.size - names - borders)
        self.names = EliasFano(source.read(names))
        self.borders = EliasFano(source.read(borders))

    @property
    def documents(self) -> int:
        return len(self.borders) - 1

    def doc_ids(self, start: int, end: int) -> list[int | None]:
        nulls = max(0, min(end, self.nulls) - start)
        named = self.names.slice(max(start, self.nulls) - self.nulls, max(end, self.nulls) - self.nulls)
        return [None] * nulls + (named + self.base).tolist()

    def read(self, start: int, end: int) -> np.ndarray:
        """Ids at places ``start`` to ``end`` of the id array."""
        self.source.seek(start * self.width)
        return np.frombuffer(self.source.read((end - start) * self.width), f"<u{self.width}")

    def document(self, i: int) -> np.ndarray:
        a, b = self.borders.slice(i, i + 2).tolist()
        return self.read(a, b)


def write(docs: DataFrame, path: str, end_id: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents as shards; returns the list of shards: ``shard, folder, file, documents, ids``
    and ``base``, the number of ids in the shards before.

    A null or empty text has the end id alone. Null document ids come first. Rows given twice are written
    twice, rows that share an id next to each other. No rows, no shards. Ids have to be whole numbers of at
    most 64 bits; others are refused before any work. A file has a name of its own for
    each attempt at a task, and only those of the attempts that counted are listed."""
    spark = docs.sparkSession
    if not isinstance(docs.schema[id].dataType, T.IntegralType):
        raise ValueError(f"document ids have to be whole numbers, not {docs.schema[id].dataType.simpleString()}")
    target = files.folder(spark, "tokens")
    rows = picked(docs, doc_id=id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    dealt = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = small(batches)
        first = next(parts, None)
        if first is None:
            return
        system, where = files.created(target)
        shard = TaskContext.get().partitionId()
        name = f"{shard:06d}-{uuid.uuid4().hex}.tok"
        with system.open_output_stream(f"{where}/{name}") as out:
            made = _write_shard(out, itertools.chain([first], parts), encoder(path), end_id)
        yield pa.RecordBatch.from_pylist([{"shard": shard, "folder": target, "file": name, **made}])

    shards = stage(dealt.mapInArrow(run, "shard long, folder string, file string, documents long, ids long"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return shards.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read(shards: DataFrame) -> DataFrame:
    """One row per document from the files: ``doc_id, start, n_tokens, ids`` (``array<int>``)."""
    schema = "doc_id long, start long, n_tokens long, ids array<int>"
    return _over_shards(shards, schema, lambda ids: pa.array(ids.astype(np.int32)), "ids", pa.list_(pa.int32()))


def checksums(shards: DataFrame) -> DataFrame:
    """As :func:`read`, with the CRC-32 of the ids as 32-bit numbers in place of them."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return _over_shards(shards, schema, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), "ids_crc32", pa.int64())


def _over_shards(shards: DataFrame, schema: str, of, name: str, kind: pa.DataType) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, where = files.opened(row["folder"])
                with system.open_input_file(f"{where}/{row['file']}") as source:
                    yield from _documents(Shard(source), row["base"])

    def _documents(shard: Shard, base: int) -> Iterator[pa.RecordBatch]:
        step = 1024
        for first in range(0, shard.documents, step):
            last = min(first + step, shard.documents)
            bounds = shard.borders.slice(first, last + 1)
            names = shard.doc_ids(first, last)
            i = 0
            while i < last - first:
                j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + READ_IDS, "right")) - 1)
                ids = shard.read(int(bounds[i]), int(bounds[j]))
                cuts = (bounds[i : j + 1] - bounds[i]).tolist()
                made = [of(ids[a:b]) for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[i:j], pa.int64()),
                        pa.array(bounds[i:j] + base),
                        pa.array(np.diff(bounds[i : j + 1])),
                        pa.array([x.to_pylist() if isinstance(x, pa.Array) else x for x in made], kind),
                    ],
                    ["doc_id", "start", "n_tokens", name],
                )
                i = j

    spread = shards.repartition(int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return spread.mapInArrow(run, schema)
