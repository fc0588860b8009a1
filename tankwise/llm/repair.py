"""Cheapest repair of conversations to the form: a system turn or none, then pairs of user and assistant.

Every row is kept, given another role or deleted, and empty turns may be put in; the audit is the string of
edits, the least in ASCII order among the cheapest. The costs of completing a conversation from each of four
states (nothing yet, after a system, a user, an assistant turn) are a vector that, less its least entry, can
take only a few values. Four-Russians tables hold, for each of these and every block of ``BLOCK`` symbols, the
vector in front of the block, the cost added, and the state in which each state leaves the block. Blocks are
looked up from the last to the first; then each is expanded backward into the vectors between its rows, and
the least edit that keeps to the cheapest cost is taken row by row.

Rows lie in slices of one range partition over conversation and order, so a conversation may be any share of
the table. What a slice does to vectors and states is one small row for each conversation that crosses a
border; these are chained on the driver, and then all slices are edited independently."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tankwise.llm.common import picked
from tankwise.session import release, stage

BLOCK = 4
SPACE = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: States: nothing yet, after a system, a user, an assistant turn. An insertion leads on from each.
_INSERTED = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}  # of a turn that leads to the state
_KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_END = (0, 4, 2, 0)  # costs at the end: missing turns are put in
_LETTERS = "sua?"
#: Symbols of rows that need not go: initial of the role, and whether the text is truncated.
SYMBOLS = len(_LETTERS) * 2
_PAIRS = ("su", "ua", "au")
_CHUNK = 1 << 20
_ROW_BITS = 33


def _choices(symbol: int, state: int, after: tuple[int, ...]) -> list[tuple[str, int, int]]:
    """(edit, cost to the end, state behind) of a row's own edits, in ASCII order."""
    letter, cut = _LETTERS[symbol % 4], symbol // 4 * TRUNCATED
    found = [("D", DELETE + after[state], state)]
    to = _KEPT.get((state, letter))
    if to is not None:
        found.append(("K", cut + after[to], to))
    to = _INSERTED[state]
    found.append(("R", REROLE + cut + after[to], to))
    return found


def _before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs in front of a row, from those behind it."""
    own = [min(cost for _, cost, _ in _choices(symbol, state, after)) for state in range(4)]
    for _ in range(3):
        own = [min(own[state], INSERT + own[_INSERTED[state]]) for state in range(4)]
    return tuple(own)


def _step(symbol: int, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    """The least edits of a row that keep to the cheapest cost, insertions in front of it included, and the
    state behind it."""
    before, edits = _before(symbol, after), ""
    while True:
        delete, *others = _choices(symbol, state, after)
        if delete[1] == before[state]:
            return edits + "D", state
        if INSERT + before[_INSERTED[state]] == before[state]:
            edits, state = edits + "I", _INSERTED[state]
            continue
        for edit, cost, to in others:
            if cost == before[state]:
                return edits + edit, to


class Tables:
    """Vectors, and what blocks of 1, 2, 4, ... up to ``BLOCK`` symbols do to them; symbol k of a block
    counts ``SYMBOLS ** k`` times in its number."""

    def __init__(self) -> None:
        self.vectors = [_END]
        steps = []
        for vector in self.vectors:  # grows while it is read
            for symbol in range(SYMBOLS):
                before = _before(symbol, vector)
                low = min(before)
                normal = tuple(cost - low for cost in before)
                if normal not in self.vectors:
                    self.vectors.append(normal)
                steps.append((self.vectors.index(normal), low, *(_step(symbol, state, vector)[1] for state in range(4))))
        found = np.array(steps, np.int64).reshape(len(self.vectors), SYMBOLS, 6)
        self.one = found[..., 0], found[..., 1], found[..., 2:]
        table, size = self.one, 1
        while size < BLOCK:
            table, size = self._doubled(*table), size * 2
        self.block = table
        self.next = table[0].tolist()
        self.single = self.one[0].tolist()

    @staticmethod
    def _doubled(following: np.ndarray, added: np.ndarray, leaves: np.ndarray) -> tuple[np.ndarray, ...]:
        n, codes = following.shape
        rows = np.arange(n)[:, None, None]
        last, first = np.arange(codes)[None, :, None], np.arange(codes)[None, None, :]
        between = following[rows, last]  # the vector between both halves
        to = following[between, first]
        cost = added[rows, last] + added[between, first]
        out = leaves[rows[..., None], last[..., None], leaves[between, first]]
        return to.reshape(n, -1), cost.reshape(n, -1), out.reshape(n, -1, 4)

    def composed(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every vector behind the rows: the vector in front, the cost added, and the state behind them
        for each state in front."""
        at = np.arange(len(self.vectors))
        cost = np.zeros(len(at), np.int64)
        leaves = np.tile(np.arange(4), (len(at), 1))
        whole = len(symbols) // BLOCK * BLOCK
        codes = symbols[:whole].reshape(-1, BLOCK) @ SYMBOLS ** np.arange(BLOCK)
        parts = [(self.block, codes), (self.one, symbols[whole:])]
        for (following, added, out), numbers in reversed(parts):
            for number in numbers[::-1].tolist():
                leaves = np.take_along_axis(leaves, out[at, number], axis=1)
                cost += added[at, number]
                at = following[at, number]
        return at, cost, leaves

    def traced(self, symbols: list[int], behind: int, state: int) -> tuple[list[str], int]:
        """The edits of each row, and the state behind them all."""
        whole = len(symbols) // BLOCK * BLOCK
        edits: list[str] = []
        for at in range(len(symbols) - 1, whole - 1, -1):
            behind = self.single[behind][symbols[at]]
        ends, codes = [], []
        for at in range(whole - BLOCK, -1, -BLOCK):
            code = 0
            for symbol in reversed(symbols[at : at + BLOCK]):
                code = code * SYMBOLS + symbol
            ends.append(behind)
            codes.append(code)
            behind = self.next[behind][code]
        for end, code in zip(reversed(ends), reversed(codes)):
            found, state = _expanded(end, code, state)
            edits += found
        return edits, state

    def tail(self, symbols: list[int], behind: int, state: int) -> tuple[list[str], int]:
        """As :meth:`traced`, for fewer rows than a block has."""
        ends = []
        for symbol in reversed(symbols):
            ends.append(behind)
            behind = self.single[behind][symbol]
        edits = []
        for symbol, end in zip(symbols, reversed(ends)):
            found, state = _step(symbol, state, self.vectors[end])
            edits.append(found)
        return edits, state

    def edits(self, symbols: list[int], behind: int, state: int) -> tuple[list[str], int]:
        rest = symbols[len(symbols) // BLOCK * BLOCK :]
        found, state = self.traced(symbols, behind, state)
        last, state = self.tail(rest, behind, state)
        return found + last, state


@lru_cache(1)
def tables() -> Tables:
    return Tables()


@lru_cache(1 << 16)
def _expanded(end: int, code: int, state: int) -> tuple[list[str], int]:
    """A block's edits: its inner vectors from the last row to the first, then the least edits forward."""
    symbols = [code // SYMBOLS**k % SYMBOLS for k in range(BLOCK)]
    return tables().tail(symbols, end, state)


def closing(state: int) -> int:
    """Insertions that a conversation still needs at its end."""
    return _END[state] // INSERT


@dataclass
class Segment:
    """Where a conversation's part in a slice stands: state in front, vector behind, whether it is the
    last part, and initial and turn number of the rows before it."""

    state: int = 0
    behind: int = 0
    last: bool = True
    initial: str | None = None
    turn: int | None = None
    shared: bool = False


def _arranged(rows: DataFrame) -> DataFrame:
    """Staged different rows in order: ``slice, at, conv_id, turn, role, text, n, symbol, fault``.

    Equal rows are one row with their number ``n``, so that no number of copies makes a group. ``symbol`` is
    null where all of them have to go. Of equal texts of one role in a conversation only those of the first
    turn number can be no duplicates; narrow aggregates tell that, and only pairs met at several turn
    numbers are joined."""
    digest = F.unhex(F.sha2("text", 256))
    told = rows.withColumn("digest", digest)
    spread = told.groupBy("conv_id", "role", "digest").agg(
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.max(F.col("turn").isNull().cast("int")).alias("bare")
    )
    again = stage(spread.filter("low < high OR (bare = 1 AND low IS NOT NULL)").drop("high"))
    same = told.groupBy("conv_id", "turn", "role", "digest", "text").agg(F.sum("n").alias("n")).alias("r")
    both = F.expr("r.conv_id <=> s.conv_id AND r.role = s.role AND r.digest = s.digest")
    joined = same.join(again.alias("s"), both, "left").select("r.*", "s.low", "s.bare")

    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    later = F.coalesce(F.col("turn").isNotNull() & ((F.col("bare") == 1) | (F.col("turn") > F.col("low"))), F.lit(False))
    cut = ~F.right(bare, F.lit(1)).isin(".", "!", "?")
    fault = F.when(bare == "", "blank").when(later, "duplicate").when(cut, "truncated").otherwise("")
    first = F.substring("role", 1, 1)
    letter = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    named = joined.withColumn("fault", fault).withColumn(
        "symbol", F.when(F.col("fault").isin("", "truncated"), letter + F.when(F.col("fault") == "", 0).otherwise(4)).cast("int")
    )
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]
    dealt = named.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    columns = ["at", "conv_id", "turn", "role", "text", "n", "symbol", "fault"]
    staged = stage(dealt.select(F.shiftright("at", _ROW_BITS).alias("slice"), *columns))
    release(again)
    return staged


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple[pa.RecordBatch, int, int]]]]:
    """((slice, conversation), parts of batches) for rows that lie together."""
    held: list[tuple[pa.RecordBatch, int, int]] = []
    current = None
    for batch in batches:
        keys = list(zip(batch.column("slice").to_pylist(), batch.column("conv_id").to_pylist()))
        start = 0
        for at in range(1, len(keys) + 1):
            if at < len(keys) and keys[at] == keys[start]:
                continue
            if held and keys[start] != current:
                yield current, held
                held = []
            current = keys[start]
            held.append((batch, start, at))
            start = at
    if held:
        yield current, held


def _symbols(parts: list[tuple[pa.RecordBatch, int, int]]) -> np.ndarray:
    found = [batch.column("symbol").slice(a, b - a).drop_null().to_numpy() for batch, a, b in parts]
    return np.concatenate(found).astype(np.int64)


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (part, conv), parts in _groups(batches):
        following, added, leaves = tables().composed(_symbols(parts))
        batch, a, b = parts[-1]
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "slice": part,
                    "conv_id": conv,
                    "following": following.tolist(),
                    "leaves": leaves.reshape(-1).tolist(),
                    "initial": batch.column("role")[b - 1].as_py()[:1],
                    "turn": batch.column("turn")[b - 1].as_py(),
                }
            ],
            schema=pa.schema(
                [
                    ("slice", pa.int64()),
                    ("conv_id", batch.schema.field("conv_id").type),
                    ("following", pa.list_(pa.int32())),
                    ("leaves", pa.list_(pa.int32())),
                    ("initial", pa.string()),
                    ("turn", pa.int64()),
                ]
            ),
        )


def _segments(rows: DataFrame, spanning: DataFrame, kind: str) -> dict[tuple, Segment]:
    """The standing of every part of the conversations that cross a border of slices: at most two parts a
    slice, so the driver chains as many rows as twice the number of slices."""
    same = F.col("r.conv_id").eqNullSafe(F.col("s.conv_id"))
    parts = rows.alias("r").join(F.broadcast(spanning).alias("s"), same).select("r.slice", "r.at", "r.conv_id", "r.turn", "r.role", "r.symbol")
    dealt = parts.repartition("slice").sortWithinPartitions("at")
    schema = f"slice long, conv_id {kind}, following array<int>, leaves array<int>, initial string, turn long"
    chains: dict = {}
    for row in sorted(dealt.mapInArrow(_summaries, schema).collect(), key=lambda r: r["slice"]):
        chains.setdefault(row["conv_id"], []).append(row)
    found: dict[tuple, Segment] = {}
    for conv, chain in chains.items():
        behind, ends = 0, []
        for row in reversed(chain):
            ends.append(behind)
            behind = row["following"][behind]
        state, initial, turn = 0, None, None
        for row, end in zip(chain, reversed(ends)):
            found[row["slice"], conv] = Segment(state, end, row is chain[-1], initial, turn, True)
            state = row["leaves"][4 * end + state]
            initial, turn = row["initial"], row["turn"]
    return found


_EDIT = ("slice", "conv_id", "at", "edit", "n", "fault", "turn", "was", "role", "text")


def _edited(segments):
    """Task function over the rows of slices in order: their edits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = 0
        lists: tuple = (None, None)
        schema = None
        for (part, conv), parts in _groups(batches):
            where = segments.value.get((part, conv)) or Segment()
            edits, state = tables().edits(_symbols(parts).tolist(), where.behind, where.state)
            following = iter(edits)
            state = where.state
            for batch, a, b in parts:
                if lists[0] is not batch:
                    lists = batch, [batch.column(name).to_pylist() for name in ("at", "turn", "role", "text", "n", "symbol", "fault")]
                if schema is None:
                    types = batch.schema.field("conv_id").type
                    schema = pa.schema(
                        [("slice", pa.int64()), ("conv_id", types), ("at", pa.int64()), ("edit", pa.string()), ("n", pa.int64())]
                        + [("fault", pa.string()), ("turn", pa.int64()), ("was", pa.string()), ("role", pa.string()), ("text", pa.string())]
                    )
                for at, turn, role, text, n, symbol, fault in zip(*(values[a:b] for values in lists[1])):
                    if symbol is None:
                        out.append((part, conv, at, "D", n, fault, turn, role, None, None))
                        continue
                    for edit in next(following):
                        if edit == "D":
                            out.append((part, conv, at, "D", 1, fault, turn, role, None, None))
                        elif edit == "I":
                            state = _INSERTED[state]
                            out.append((part, conv, at, "I", 1, "", None, None, _ROLE[state], ""))
                        else:
                            state = _KEPT[state, role[:1]] if edit == "K" else _INSERTED[state]
                            out.append((part, conv, at, edit, 1, fault, turn, role, role if edit == "K" else _ROLE[state], text))
                    if n > 1:
                        out.append((part, conv, at, "D", n - 1, "duplicate", turn, role, None, None))
                    held += len(text)
                    if len(out) > 2_000 or held > _CHUNK:
                        yield _rows(out, schema)
                        out, held = [], 0
            if where.last:
                for _ in range(closing(state)):
                    state = _INSERTED[state]
                    out.append((part, conv, at, "I", 1, "", None, None, _ROLE[state], ""))
        if out:
            yield _rows(out, schema)

    return run


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def _reported(segments):
    """Task function over edits in order: one row per conversation and slice with its counts, and for
    conversations that cross a border the repaired lines in chunks in place of their digest."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, conv), parts in _groups(batches):
            where = segments.value.get((part, conv)) or Segment()
            counts = dict.fromkeys(_COUNTS, 0)
            low = high = None
            turns, number = 0, 0
            initial, turn = where.initial, where.turn
            audit: list[str] = []
            lines: list[str] = []
            held, any_line = 0, False
            digest = hashlib.sha256()
            kind = parts[0][0].schema.field("conv_id").type
            for batch, a, b in parts:
                columns = (batch.column(name).slice(a, b - a).to_pylist() for name in ("edit", "n", "fault", "turn", "was", "role", "text"))
                for edit, n, fault, at, was, role, text in zip(*columns):
                    audit.append(edit * n)
                    counts["cost"] += {"D": DELETE * n, "I": INSERT, "R": REROLE, "K": 0}[edit]
                    if edit != "I":
                        if fault:
                            counts[fault] += n
                        counts["cost"] += TRUNCATED * (edit != "D" and fault == "truncated")
                        counts["illegal"] += n - 1 + (initial is not None and initial + was[:1] not in _PAIRS)
                        initial = was[:1]
                        if at is not None:
                            turns += at != turn
                            low, high, turn = at if low is None else low, at, at
                    if edit != "D":
                        lines.append(f"{role}:{text}")
                        held += len(lines[-1])
                        if held > _CHUNK:
                            block = "\n".join(lines).encode("utf-8", "surrogatepass")
                            if where.shared:
                                yield _report(kind, (conv, part, number, None, block, low, high, 0, *(0 for _ in _COUNTS), ""))
                                number += 1
                            else:
                                digest.update(b"\n" * any_line + block)
                            lines, held, any_line = [], 0, True
            block = "\n".join(lines).encode("utf-8", "surrogatepass")
            if not where.shared and lines:
                digest.update(b"\n" * any_line + block)
            sha, rest = (None, block if lines else None) if where.shared else (digest.hexdigest(), None)
            yield _report(kind, (conv, part, number, sha, rest, low, high, turns, *counts.values(), "".join(audit)))

    return _gathered(run)


def _report(kind: pa.DataType, row: tuple) -> tuple[pa.DataType, tuple]:
    return kind, row


def _gathered(run):
    """Rows of a task function as batches of bounded size."""

    def batched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held, schema = 0, None
        for kind, row in run(batches):
            if schema is None:
                schema = pa.schema(
                    [("conv_id", kind), ("slice", pa.int64()), ("part", pa.int64()), ("sha", pa.string()), ("lines", pa.binary())]
                    + [(name, pa.int64()) for name in ("low", "high", "turns", *_COUNTS)]
                    + [("audit", pa.string())]
                )
            rows.append(row)
            held += len(row[4] or b"") + len(row[-1])
            if len(rows) >= 1_000 or held > _CHUNK:
                yield _rows(rows, schema)
                rows, held = [], 0
        if rows:
            yield _rows(rows, schema)

    return batched


def _streamed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function over chunks sorted by conversation and order: the digest of each conversation. SHA-256
    is a serial function, so one stream per conversation, of which one chunk is held at a time."""
    current, digest = None, None
    for batch in batches:
        for conv, block in zip(batch.column("conv_id").to_pylist(), batch.column("lines").to_pylist()):
            if digest is None or conv != current:
                if digest is not None:
                    yield _digest_row(batch, current, digest)
                current, digest, started = conv, hashlib.sha256(), False
            if block is not None:
                digest.update(b"\n" * started + block)
                started = True
    if digest is not None:
        yield _digest_row(batch, current, digest)


def _digest_row(batch: pa.RecordBatch, conv, digest) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([conv], batch.schema.field("conv_id").type), pa.array([digest.hexdigest()])], ["conv_id", "sha"]
    )


@dataclass
class Repair:
    """``edits``: one row per edit in order of (``slice``, ``at``, own order) with ``edit`` (K, R, D or I),
    ``n`` (equal rows deleted together), ``fault``, ``turn`` and role (``was``) of the row, and ``role`` and
    ``text`` of the repaired turn, null where it was deleted."""

    edits: DataFrame
    kind: str
    segments: object

    def report(self) -> DataFrame:
        """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
        repaired_sha256``."""
        names = "".join(f", {name} long" for name in ("low", "high", "turns", *_COUNTS))
        schema = f"conv_id {self.kind}, slice long, part long, sha string, lines binary{names}, audit string"
        parts = stage(self.edits.mapInArrow(_reported(self.segments), schema))
        whole = parts.filter("sha IS NOT NULL")
        cut = parts.filter("sha IS NULL")
        pieces = F.array_sort(F.collect_list(F.struct("slice", "part", "audit")))
        joined = cut.groupBy("conv_id").agg(
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            *(F.sum(name).alias(name) for name in ("turns", *_COUNTS)),
            F.array_join(F.transform(pieces, lambda p: p["audit"]), "").alias("audit"),
        )
        lines = cut.select("conv_id", "slice", "part", "lines").repartition("conv_id").sortWithinPartitions("conv_id", "slice", "part")
        digests = lines.mapInArrow(_streamed, f"conv_id {self.kind}, sha string").withColumnRenamed("conv_id", "id")
        joined = joined.join(digests, F.col("conv_id").eqNullSafe(F.col("id")))
        columns = ["conv_id", "low", "high", "turns", *_COUNTS, "audit", "sha"]
        every = whole.select(*columns).unionByName(joined.select(*columns))
        span = F.col("high").cast("decimal(38,0)") - F.col("low") + 1 - F.col("turns")
        gaps = F.least(F.coalesce(span, F.lit(0)), F.lit((1 << 63) - 1)).cast("long")
        return every.select("conv_id", gaps.alias("gaps"), *_COUNTS, "audit", F.col("sha").alias("repaired_sha256"))


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", n: str | None = None) -> Repair:
    """Repair all conversations of ``turns``; ``n`` names a column that says how often a row counts.

    Rows are taken by turn number, those without one first, then by role and digest of the text. A null
    role or text counts as one space, so a null text is blank. A row is blank (nothing but white space), else a
    duplicate (same role and text seen earlier in the conversation), else truncated (its last character but
    white space is none of ``.!?``). Blank rows and duplicates go. A role that begins with none of s, u and a
    can't be kept. Rows of a null conversation are a conversation. An empty table gives no rows; further
    columns play no part. An audit is one string, so a conversation can have some two billion edits."""
    rows = picked(turns, conv_id=conv, turn=turn, role=role, text=text, **({"n": n} if n else {}))
    rows = rows.withColumns(
        {
            "turn": F.col("turn").cast("long"),
            "role": F.coalesce("role", F.lit(" ")),
            "text": F.coalesce("text", F.lit(" ")),
            "n": F.col("n").cast("long") if n else F.lit(1).cast("long"),
        }
    )
    kind = rows.schema["conv_id"].dataType.simpleString()
    arranged = _arranged(rows)
    places = arranged.groupBy("conv_id").agg(F.min("slice").alias("low"), F.max("slice").alias("high"))
    spanning = stage(places.filter("low < high").select("conv_id"))  # fewer rows than slices
    segments = rows.sparkSession.sparkContext.broadcast(_segments(arranged, spanning, kind))
    dealt = arranged.repartitionByRange("slice").sortWithinPartitions("at")
    schema = (
        f"slice long, conv_id {kind}, at long, edit string, n long, fault string, turn long, was string, role string, text string"
    )
    return Repair(dealt.mapInArrow(_edited(segments), schema), kind, segments)


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, n`` after faults chosen by CRC-32 of ``conv_id:turn`` modulo 20: 0 drops
    the row, 1 empties its text, 2 takes its ``.!?`` out, 3 doubles it (``n`` is 2), 4 makes it a user's.
    Nulls count as one space."""
    rows = picked(turns, conv_id="conv_id", turn="turn", role="role", text="text")
    rows = rows.withColumns({name: F.coalesce(name, F.lit(" ")) for name in ("role", "text")})
    key = F.concat_ws(":", *(F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")))
    marked = rows.withColumn("fault", F.crc32(key.cast("binary")) % 20).filter("fault <> 0")
    fault = F.col("fault")
    return marked.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(fault == 3, 2).otherwise(1).alias("n"),
    )


def damage_and_repair(turns: DataFrame) -> DataFrame:
    """The report of all conversations of ``turns`` after :func:`damaged`; those of which no row is left have
    zeros, an empty audit and the digest of nothing."""
    found = repair(damaged(turns), n="n").report().withColumnRenamed("conv_id", "id")
    every = turns.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left").drop("id")
    nothing = hashlib.sha256().hexdigest()
    return joined.select(
        "conv_id",
        *(F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("gaps", *_COUNTS)),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
