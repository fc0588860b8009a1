"""Texts that share most of their word shingles: an exact Jaccard join with a count-vector R-tree.

A text is the set of its distinct ``size``-word shingles, each a 64-bit hash. Hashes fall into ``GROUPS``
groups; the numbers of hashes per group are the text's point. Two sets have at most the sum of the
coordinate minima of their points in common, and two boxes of an R-tree at most the sum of the minima of
their upper corners; a pair is followed only while that can still reach the threshold.

Points of unrelated texts of like length lie close together, so a tree over all points would have to open
almost every pair of boxes. Points are therefore dealt to buckets first, so that no linked pair is lost:
under one order of all hashes, sets with the required overlap share a hash among the first
``n - ceil(threshold * n) + 1`` of each (their prefix). The order puts hashes that are frequent in the
corpus last, by counts over all documents in a fixed number of cells; any order gives right results.

1. Equal sets are one node. Prefix hashes that more than one node has are buckets; of buckets with the
   same members one stays.
2. In buckets of more than ``CROWD`` nodes every member is first compared with the bucket's leader, the one
   with the most shared hashes in its prefix, and linked nodes are joined into components. This thins out
   groups of near copies without looking at their pairs.
3. Every bucket whose members are in different components, so every smaller one too, is split into blocks
   of bounded size; the R-tree of a block, or of two, gives the pairs of different components that the
   bounds let through. What has been compared before is not compared again. Links join the components for
   good.

Equality of 64-bit hashes stands for equality: among ten billion different sets about three wrong pairs
are to be expected."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tankwise.llm.bytewords import NOT_SPACE, chunks, join_hashes, mix
from tankwise.llm.common import fresh, picked, small_batches, text_digest
from tankwise.llm.components import components
from tankwise.session import release, stage

SIZE = 5
PERCENT = 75
GROUPS = 512
#: Nodes of a bucket that one task compares with each other, or with as many others.
BLOCK = 2_000
#: Nodes of a bucket beyond which its leader is compared with all first.
CROWD = 16
LEAF = 8
_CELL_BITS = 18
_FILTER_BITS = 26
_ROWS = 4_096
#: Buckets of a node that its rows know of, to give each pair once.
_FIRSTS = 32


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text that has words."""
    for chunk in chunks(column, NOT_SPACE):
        hashes = chunk.shingles(size)
        for i in range(chunk.texts):
            first, end = int(chunk.first[i]), int(chunk.first[i + 1])
            if end - first >= size:
                yield chunk.row + i, np.unique(hashes[first : end - size + 1])
            elif end > first:
                yield chunk.row + i, join_hashes([chunk.hashes[k : k + 1] for k in range(first, end)])


def node_of(hashes: np.ndarray) -> int:
    """A number for a set: a sum of mixed hashes, and its size."""
    total = mix(hashes + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mix(np.array([total], np.uint64) + np.uint64(len(hashes)))[0].astype(np.int64))


def point_of(hashes: np.ndarray) -> np.ndarray:
    """Hashes per group, in the smallest of 8, 16 or 32 bits that holds them."""
    counts = np.bincount((hashes & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
    return counts.astype(np.min_scalar_type(int(counts.max())))


def prefix_length(n: int, percent: int) -> int:
    return n + 1 - -(-percent * n // 100)


def enough(overlap, total, percent: int):
    """Whether an overlap reaches the threshold for two sets of ``total`` elements together."""
    return (100 + percent) * overlap >= percent * total


def _described(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.zeros(len(batch), np.int64)
            nodes: list[int | None] = [None] * len(batch)
            points: list[bytes | None] = [None] * len(batch)
            for row, hashes in shingle_sets(batch.column("text"), size):
                n[row], nodes[row], points[row] = len(hashes), node_of(hashes), point_of(hashes).tobytes()
            kept = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in kept),
                    pa.array(n),
                    pa.array(nodes, pa.int64()),
                    pa.array(points, pa.binary()),
                ],
                [*kept, "n_shingles", "node", "point"],
            )

    return run


def cell_counts(texts: DataFrame, size: int) -> np.ndarray:
    """How many documents have a shingle in each of ``2 ** _CELL_BITS`` cells, over all documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(1 << _CELL_BITS, np.int64)
        for batch in batches:
            for _, hashes in shingle_sets(batch.column(0), size):
                np.add.at(totals, (hashes >> np.uint64(64 - _CELL_BITS)).astype(np.int64), 1)
        for start in range(0, len(totals), 1 << 16):
            seen = start + np.flatnonzero(totals[start : start + (1 << 16)])
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(totals[seen])], ["cell", "n"])

    counted = texts.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # at most one row per cell
    totals = np.zeros(1 << _CELL_BITS, np.int64)
    totals[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return totals


def frequency_classes(counts: np.ndarray) -> np.ndarray:
    """Cells by size on a scale of half powers of two, so that small differences don't count."""
    return np.floor(2 * np.log2(np.maximum(counts, 1))).astype(np.uint8)


def prefix(hashes: np.ndarray, classes: np.ndarray, percent: int) -> np.ndarray:
    """The first hashes under the order by class of cell, then hash."""
    keep = prefix_length(len(hashes), percent)
    kind = classes[(hashes >> np.uint64(64 - _CELL_BITS)).astype(np.int64)]
    return hashes[np.argsort(kind, kind="stable")[:keep]]  # the hashes are sorted already


def _bit(values: np.ndarray) -> np.ndarray:
    return (values.view(np.uint64) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


def membership(values: DataFrame, name: str) -> np.ndarray:
    """A filter of fixed size for a column of hashes: true for all of them, and for some others."""
    words = (
        values.select(F.shiftrightunsigned(name, 64 - _FILTER_BITS).alias("place"))
        .selectExpr("shiftright(place, 6) AS word", "shiftleft(1L, cast(place % 64 AS int)) AS bit")
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()  # at most 2 ** (_FILTER_BITS - 6) rows
    )
    packed = np.zeros(1 << (_FILTER_BITS - 6), np.int64)
    packed[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return packed


def _passes(packed: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = _bit(values)
    return (packed[at >> 6] >> (at & 63)) & 1 == 1


def _prefix_rows(size: int, percent: int, classes):
    """Task function: (token, node) for the prefix of every document. Of a token that several nodes of some
    documents read together have, the smallest and the largest node are enough to tell that it is shared."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = classes.value
        for batch in batches:
            tokens, nodes, held = [], [], 0
            for _, hashes in shingle_sets(batch.column(0), size):
                first = prefix(hashes, order, percent).astype(np.int64)
                tokens.append(first)
                nodes.append(np.full(len(first), node_of(hashes), np.int64))
                held += len(first)
                if held > 200_000:
                    yield _ends(np.concatenate(tokens), np.concatenate(nodes))
                    tokens, nodes, held = [], [], 0
            if held:
                yield _ends(np.concatenate(tokens), np.concatenate(nodes))

    return run


def _ends(tokens: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
    """The rows of the smallest and of the largest node of every token."""
    order = np.lexsort((nodes, tokens))
    tokens, nodes = tokens[order], nodes[order]
    border = tokens[1:] != tokens[:-1]
    first, last = np.flatnonzero(np.append(True, border)), np.flatnonzero(np.append(border, True))
    keep = np.concatenate([first, last[nodes[last] != nodes[first]]])
    return pa.RecordBatch.from_arrays([pa.array(tokens[keep]), pa.array(nodes[keep])], ["token", "node"])


def _shared_rows(size: int, percent: int, classes, allowed):
    """Task function: (token, node, weight) for the tokens of every document's prefix that the filter
    allows. The weight ranks nodes by the number of these, ties by node."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, packed = classes.value, allowed.value
        for batch in batches:
            tokens, nodes, weights, held = [], [], [], 0
            for _, hashes in shingle_sets(batch.column(0), size):
                first = prefix(hashes, order, percent).astype(np.int64)
                first = first[_passes(packed, first)]
                node = node_of(hashes)
                tokens.append(first)
                nodes.append(np.full(len(first), node, np.int64))
                weights.append(np.full(len(first), min(len(first), (1 << 23) - 1) << 40 | (node >> 24 & (1 << 40) - 1), np.int64))
                held += len(first)
                if held > 100_000:
                    yield _member_rows(tokens, nodes, weights)
                    tokens, nodes, weights, held = [], [], [], 0
            if held:
                yield _member_rows(tokens, nodes, weights)

    return run


def _member_rows(*columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["token", "node", "weight"])


def _buckets(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Staged ``token, node, leader, members``: the buckets of at least two nodes, one of each kind."""
    context = texts.sparkSession.sparkContext
    classes = context.broadcast(frequency_classes(cell_counts(texts, size)))
    # The tasks have combined what they could; rows of two numbers are dealt out, not the aggregate's three.
    every = texts.select("text").mapInArrow(_prefix_rows(size, percent, classes), "token long, node long")
    ends = every.repartition("token").groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    shared = stage(ends.filter(F.col("low") != F.col("high")).select("token"))
    allowed = context.broadcast(membership(shared, "token"))
    kind = "token long, node long, weight long"
    again = texts.select("text").mapInArrow(_shared_rows(size, percent, classes, allowed), kind)
    members = stage(again.join(shared, "token").distinct())
    # The text from which near copies were made has more shared hashes in its prefix than they have, whose
    # prefixes begin with what is new in them. So it leads its buckets.
    signed = members.groupBy("token").agg(
        F.bit_xor("node").alias("x"),
        F.bit_xor(F.xxhash64("node")).alias("y"),
        F.count(F.lit(1)).alias("members"),
        F.max_by("node", "weight").alias("leader"),
    )
    kinds = signed.groupBy("x", "y", "members").agg(F.min("token").alias("token"), F.min("leader").alias("leader"))
    found = stage(members.select("token", "node").join(kinds.select("token", "members", "leader"), "token"))
    release(shared, members)
    return found


def _pair_filter(percent: int):
    """Task function: of pairs with both points, those that the bound lets through."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x, y = (_points(batch.column(name)) for name in ("x", "y"))
            overlap = np.minimum(x, y).sum(axis=1, dtype=np.int64)
            total = x.sum(axis=1, dtype=np.int64) + y.sum(axis=1, dtype=np.int64)
            yield batch.select(["a", "b"]).filter(pa.array(enough(overlap, total, percent)))

    return run


def _points(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    if all(len(row) == GROUPS for row in rows):
        return np.frombuffer(b"".join(rows), np.uint8).reshape(-1, GROUPS)
    return np.array([np.frombuffer(row, f"u{len(row) // GROUPS}") for row in rows], np.uint32)


def _bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    x = points.select(F.col("node").alias("a"), F.col("point").alias("x"))
    y = points.select(F.col("node").alias("b"), F.col("point").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_pair_filter(percent), "a long, b long")


def _wanted_sets(size: int, docs, nodes):
    """Task function: the sets of the wanted nodes, from the documents that stand for them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(_passes(docs.value, batch.column("h").to_numpy())))
            found, sets, held = [], [], 0
            for _, hashes in shingle_sets(batch.column("text"), size):
                node = node_of(hashes)
                if not _passes(nodes.value, np.array([node], np.int64))[0]:
                    continue
                found.append(node)
                sets.append(hashes.tobytes())
                held += len(hashes)
                if held > 500_000:
                    yield _set_rows(found, sets)
                    found, sets, held = [], [], 0
            if found:
                yield _set_rows(found, sets)

    return run


def _set_rows(nodes: list[int], sets: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], ["node", "hashes"])


def _verifier(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), _ROWS):
                part = batch.slice(start, _ROWS)
                kept = []
                for x, y in zip(part.column("x"), part.column("y")):
                    x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    both = np.concatenate([x, y])
                    both.sort()
                    overlap = int((both[1:] == both[:-1]).sum())
                    kept.append(bool(enough(overlap, len(both), percent)))
                yield part.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return run


def _verified(texts: DataFrame, base: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Staged: those of the (staged) pairs that are links.

    Sets are worked out again for one document of each node in the pairs; filters of fixed size keep other
    documents from being split into words, and the joins drop what the filters let through."""
    context = texts.sparkSession.sparkContext
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    stand_ins = base.join(ends, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    hashed = stand_ins.select("node", F.xxhash64("doc_id").alias("h"))
    docs, nodes = (context.broadcast(membership(hashed, name)) for name in ("h", "node"))
    sets = texts.select(F.xxhash64("doc_id").alias("h"), "text").mapInArrow(
        _wanted_sets(size, docs, nodes), "node long, hashes binary"
    )
    sets = stage(sets.join(ends, "node", "left_semi").dropDuplicates(["node"]))
    x = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    links = stage(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verifier(percent), "a long, b long"))
    release(sets)
    return links


class Tree:
    """An R-tree over points, packed by halving along the coordinate with the widest range.

    ``low_total`` and ``label`` of a node: the smallest sum of a point below it, and the component that all
    of them belong to, if they do."""

    def __init__(self, points: np.ndarray, labels: np.ndarray, rows: np.ndarray | None = None) -> None:
        rows = np.arange(len(points)) if rows is None else rows
        mine = points[rows]
        self.rows, self.upper = rows, mine.max(axis=0)
        self.low_total = int(mine.sum(axis=1, dtype=np.int64).min())
        self.label = int(labels[rows[0]]) if (labels[rows] == labels[rows[0]]).all() else None
        self.parts: list[Tree] = []
        if len(rows) > LEAF:
            axis = int((mine.max(axis=0) - mine.min(axis=0)).argmax())
            order = rows[np.argsort(mine[:, axis], kind="stable")]
            half = len(order) // 2
            self.parts = [Tree(points, labels, order[:half]), Tree(points, labels, order[half:])]


def tree_join(x: Tree, y: Tree, points: np.ndarray, labels: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of different components whose bound reaches the threshold, each once.

    ``x`` and ``y`` are the same tree or trees over different rows."""
    todo = [(x, y)]
    while todo:
        x, y = todo.pop()
        if x.label is not None and x.label == y.label:
            continue
        if not enough(int(np.minimum(x.upper, y.upper).sum(dtype=np.int64)), x.low_total + y.low_total, percent):
            continue
        if x is y and x.parts:
            left, right = x.parts
            todo += [(left, left), (right, right), (left, right)]
        elif x.parts and (len(x.rows) >= len(y.rows) or not y.parts):
            todo += [(part, y) for part in x.parts]
        elif y.parts:
            todo += [(x, part) for part in y.parts]
        else:
            a, b = points[x.rows], points[y.rows]
            overlap = np.minimum(a[:, None, :], b[None, :, :]).sum(axis=2, dtype=np.int64)
            total = a.sum(axis=1, dtype=np.int64)[:, None] + b.sum(axis=1, dtype=np.int64)[None, :]
            good = enough(overlap, total, percent) & (labels[x.rows][:, None] != labels[y.rows][None, :])
            if x is y:
                good = np.triu(good, 1)
            i, j = np.nonzero(good)
            if len(i):
                yield x.rows[i], y.rows[j]


def _tree_pairs(percent: int):
    """Task function over rows sorted by (token, i, j): candidate pairs of each block or pair of blocks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            keys = list(zip(*(batch.column(name).to_pylist() for name in ("token", "i", "j"))))
            start = 0
            for at in range(1, len(keys) + 1):
                if at < len(keys) and keys[at] == keys[start]:
                    continue
                if current is not None and keys[start] != current:
                    yield from joined(held)
                    held = []
                current = keys[start]
                held.append(batch.slice(start, at - start))
                start = at
        if held:
            yield from joined(held)

    def joined(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        nodes = rows.column("node").to_numpy()
        labels = rows.column("root").to_numpy()
        points = _points(rows.column("point"))
        block = rows.column("block").to_numpy()
        i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
        token = rows.column("token")[0].as_py()
        tokens = rows.column("tokens").to_pylist()
        before: dict[int, set[int]] = {}

        def new(a: int, b: int) -> bool:
            """Whether no earlier bucket is known that has both."""
            for k in (a, b):
                if k not in before:
                    before[k] = {t for t in tokens[k] if t < token}
            return before[a].isdisjoint(before[b])

        if i == j:
            x = y = Tree(points, labels)
        else:
            sides = [np.flatnonzero(block == k) for k in (i, j)]
            if not all(len(side) for side in sides):
                return
            x, y = (Tree(points, labels, side) for side in sides)
        for a, b in tree_join(x, y, points, labels, percent):
            kept = [new(*pair) for pair in zip(a.tolist(), b.tolist())]
            a, b = nodes[a[kept]], nodes[b[kept]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"]
            )

    return run


def _open_pairs(buckets: DataFrame, roots: DataFrame, points: DataFrame, percent: int, block: int) -> DataFrame:
    """Pairs of nodes that share a bucket, are in different components, and that the bounds let through."""
    labelled = buckets.select("token", "node", "members").join(roots, "node", "left").select(
        "token", "node", "members", F.coalesce("root", "node").alias("root")
    )
    ends = labelled.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = ends.filter(F.col("low") != F.col("high")).select("token")
    blocks = F.ceil(F.col("members") / F.lit(block)).cast("int")
    numbered = (
        labelled.join(mixed, "token")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("token", "node", "root", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    )
    # A pair comes from the first of its buckets, as far as the first ones of its nodes tell; that bucket
    # has both, so it is open too.
    firsts = buckets.groupBy("node").agg(F.slice(F.array_sort(F.collect_set("token")), 1, _FIRSTS).alias("tokens"))
    placed = numbered.join(points, "node").join(firsts, "node")
    placed = placed.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    columns = ["token", "i", "j", "block", "node", "root", "point", "tokens"]
    return placed.select(*columns).mapInArrow(_tree_pairs(percent), "a long, b long").distinct()


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: only those that the links touch are worked out again."""
    named = roots.select("node", F.col("root").alias("r"))
    for side in ("a", "b"):
        links = links.join(named.withColumnRenamed("node", side), side, "left")
        links = links.withColumn(side, F.coalesce("r", side)).drop("r")
    merged = stage(components(links))
    moved = roots.join(merged.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
    alone = merged.join(roots, "node", "left_anti").select("node", "root")
    return moved.select("node", F.coalesce("to", "root").alias("root")).unionByName(alone)


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    percent: int = PERCENT,
    block: int = BLOCK,
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    Words are runs of anything but white space, with A-Z in lower case. A text with fewer than ``size``
    words is one shingle of them all; null, empty and blank texts have no shingles, are linked with
    nothing, and form a component each. Texts are linked where 100 times the size of the intersection is
    at least ``percent`` times that of the union; ``component_id`` is the smallest id that links reach.
    Null ids are passed over in that (a component of null ids only has a null id). Rows given twice are
    two rows of one component. An empty table gives no rows; further columns play no part."""
    texts = picked(docs, doc_id=id, text=text)
    placed = _placed(texts, size, percent, block)
    least = (
        placed.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("component_id"))
    )
    return placed.join(least, "root", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _placed(texts: DataFrame, size: int = SIZE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """The columns of ``texts`` but the text, ``n_shingles``, ``node`` and ``root``: the component, null for
    a text without shingles."""
    with small_batches(texts.sparkSession):
        base, found = _linked(texts, size, percent, block)
    return base.drop("point").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _linked(texts: DataFrame, size: int, percent: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Staged: the columns but the text, ``n_shingles, node, point`` of every document, and ``node, root``
    of linked nodes."""
    kept = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in texts.drop("text").schema)
    base = stage(texts.mapInArrow(_described(size), f"{kept}n_shingles long, node long, point binary"))
    points = base.filter(F.col("node").isNotNull()).select("node", "point").dropDuplicates(["node"])
    points = stage(points)
    buckets = _buckets(texts, size, percent)

    led = buckets.filter((F.col("members") > CROWD) & (F.col("node") != F.col("leader")))
    led = led.select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")).distinct()
    first = stage(_bounded(led, points, percent))
    links = _verified(texts, base, first, size, percent)
    roots = stage(components(links))

    second = _open_pairs(buckets, roots, points, percent, block).join(first, ["a", "b"], "left_anti")
    second = stage(second)
    more = _verified(texts, base, second, size, percent)
    found = roots if more.isEmpty() else stage(_joined(roots, more))
    release(buckets, first, second, points)
    return base, found


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The input with one row of each component, that of the smallest id, all columns as they were.

    Rows are told apart by id and text. A null id comes after all others, of rows that share the smallest id
    the one with the least digest of its text stays, and of rows that repeat both one stays. Texts without
    shingles are linked with nothing and stay, repeated or not."""
    digest, key, form = fresh(docs, "digest", "key", "form")
    texts = picked(docs, doc_id=id, text=text).withColumn("digest", text_digest("text"))
    placed = _placed(texts).filter(F.col("root").isNotNull())
    rows = stage(placed.groupBy("root", "doc_id", "digest").agg(F.count(F.lit(1)).alias("copies")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("digest"))).alias("first")
    winners = rows.groupBy("root").agg(first).select(F.col("first.doc_id").alias(key), F.col("first.digest").alias(form))
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.col("digest") == F.col(form))
    named = [F.col("doc_id").alias(key), F.col("digest").alias(form)]
    gone = stage(rows.join(winners, same, "left_anti").select(*named))
    repeated = stage(rows.filter(F.col("copies") > 1).select(*named))

    same = F.col(f"`{id}`").eqNullSafe(F.col(key)) & (F.col(digest) == F.col(form))
    named = docs.withColumn(digest, text_digest(text))
    plain, kept = _told_apart(named, digest, gone.select(form).union(repeated.select(form)), form)
    kept = kept.join(gone, same, "left_anti")
    if not repeated.isEmpty():
        once = kept.join(repeated, same, "left_anti")
        kept = once.unionByName(kept.join(repeated, same, "left_semi").dropDuplicates([id, digest]))
    return plain.unionByName(kept).drop(digest)


def _told_apart(docs: DataFrame, digest: str, named: DataFrame, form: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose digest is certainly none of the named ones, and all others.

    A filter of fixed size tells them apart where they are read, so that joins against the named digests deal
    out the texts of the others only. Once more digests are named than it has bits, more rows are others."""
    hashed = named.select(F.xxhash64(form).alias("h"))
    allowed = docs.sparkSession.sparkContext.broadcast(membership(hashed, "h"))

    @F.arrow_udf("boolean")
    def maybe(hashes: pa.Array) -> pa.Array:
        return pa.array(_passes(allowed.value, hashes.to_numpy()))

    found = maybe(F.xxhash64(digest))
    return docs.filter(~found), docs.filter(found)
