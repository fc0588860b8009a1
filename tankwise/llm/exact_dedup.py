"""Exact duplicates by a heavy-hitter split.

Every text becomes a SHA-256 digest. Misra-Gries summaries, one per task and merged by adding counters,
name every digest that can hold more than ``1 / heavy`` of the rows. Their exact counts and winners are
verified in one aggregate that combines on the map side, and go to all tasks as a broadcast of at most
``2 * heavy`` rows, so that rows of frequent digests are settled where they are read. All other digests
hold less than ``1 / heavy`` of the rows each and are dealt by an ordinary shuffle."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tankwise.llm.common import fresh, picked
from tankwise.session import stage

HEAVY = 1_000


def misra_gries(counters: int):
    """Summaries of a task's digests: any value held by more than ``1 / (counters + 1)`` of its rows is
    among them, with a count too low by at most that share."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: Counter = Counter()
        for batch in batches:
            kept.update(batch.column(0).to_pylist())
            if len(kept) > counters:
                cut = sorted(kept.values(), reverse=True)[counters]
                kept = Counter({k: n - cut for k, n in kept.items() if n > cut})
        yield pa.RecordBatch.from_pydict(
            {"digest": pa.array(kept.keys(), pa.binary()), "n": pa.array(kept.values(), pa.int64())}
        )

    return run


def heavy_digests(slim: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """Exact ``digest, keep_id, group_size`` of all digests with more than ``1 / heavy`` of the rows;
    never more than ``heavy`` rows, from at most ``2 * heavy`` candidates.

    A task's counter is too low by less than ``1 / (2 * heavy)`` of its rows, and so is their sum."""
    total = slim.count()
    candidates = (
        slim.select("digest")
        .mapInArrow(misra_gries(2 * heavy), "digest binary, n long")
        .groupBy("digest")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") * (2 * heavy) > total)
        .select("digest")
    )
    sizes = _winners(slim.join(F.broadcast(candidates), "digest"))
    return sizes.filter(F.col("group_size") * heavy > total)


def _winners(slim: DataFrame) -> DataFrame:
    return slim.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )


def _digests(docs: DataFrame, id: str, text: str) -> DataFrame:
    return picked(docs, doc_id=id, text=text).select(
        "doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest")
    )


def duplicate_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", heavy: int = HEAVY
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    A null text counts as empty, empty texts equal each other, and the largest id of a group stays. A
    null id is less than all others, so it stays only where a group has no other. A row given twice, id
    and all, counts twice and is marked as kept twice: the marks say which ids stay. An empty table gives
    no rows; further columns of the input play no part."""
    slim = stage(_digests(docs, id, text))
    frequent = stage(heavy_digests(slim, heavy))
    known = slim.join(F.broadcast(frequent), "digest")
    others = slim.join(F.broadcast(frequent.select("digest")), "digest", "left_anti")
    rest = others.join(_winners(others), "digest")
    return known.unionByName(rest).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, id: str = "doc_id", text: str = "text", heavy: int = HEAVY) -> DataFrame:
    """The input with one row of each group of equal texts, all columns as they were.

    The rules are those of :func:`duplicate_groups`; of rows that repeat both id and text one stays."""
    digest, won, key, copies = fresh(docs, "digest", "won", "key", "copies")
    groups = duplicate_groups(docs, id, text, heavy).filter("kept")
    winners = groups.groupBy(F.unhex("text_sha256").alias(won), F.col("doc_id").alias(key)).agg(
        F.count(F.lit(1)).alias(copies)
    )
    named = docs.withColumn(digest, F.unhex(F.sha2(F.coalesce(f"`{text}`", F.lit("")), 256)))
    kept = named.join(
        winners,
        (F.col(digest) == F.col(won)) & F.col(f"`{id}`").eqNullSafe(F.col(key)),
    )
    once = kept.filter(F.col(copies) == 1)
    repeated = kept.filter(F.col(copies) > 1).dropDuplicates([digest])
    return once.unionByName(repeated).select(*(F.col(f"`{name}`") for name in docs.columns))
