"""Conversation repair against a plain search over all edits."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

from tankwise.llm import repair

SPACE = " \t\n\x0b\x0c\r"
INSERTED = {"": "u", "s": "u", "u": "a", "a": "u"}  # role that may follow the last one
NAMES = {"s": "system", "u": "user", "a": "assistant"}
EMPTY = hashlib.sha256().hexdigest()


def cheapest(rows):
    """Least (cost, audit) and the repaired lines: a search from the front that keeps one way per last role."""
    ways = {"": (0, "", ())}

    def inserted(ways):
        for _ in range(3):
            for last, (cost, audit, lines) in list(ways.items()):
                to = INSERTED[last]
                found = (cost + 2, audit + "I", (*lines, NAMES[to] + ":"))
                ways[to] = min(ways.get(to, found), found)
        return ways

    for role, text, fault in rows:
        following = {}
        for last, (cost, audit, lines) in inserted(ways).items():
            options = [(last, (cost + 3, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                letter = role[:1]
                if letter == INSERTED[last] or (letter == "s" and last == ""):
                    options.append((letter, (cost + cut, audit + "K", (*lines, f"{role}:{text}"))))
                to = INSERTED[last]
                options.append((to, (cost + 2 + cut, audit + "R", (*lines, f"{NAMES[to]}:{text}"))))
            for to, found in options:
                following[to] = min(following.get(to, found), found)
        ways = following
    ends = inserted(ways)
    return min(ends[last] for last in ("", "a") if last in ends)


def expected(turns, damage=True):
    """The whole report by brute force; turns are (conv_id, turn, role, text)."""
    report = []
    for conv in {t[0] for t in turns}:
        rows = []
        for _, turn, role, text in (t for t in turns if t[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            fault = zlib.crc32(key.encode()) % 20 if damage else 19
            if fault == 0:
                continue
            text = "" if fault == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if fault == 2 else text
            rows += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, marked = set(), []
        for _, role, text in rows:
            bare = text.strip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        turns_told = {r[0] for r in rows if r[0] is not None}
        gaps = max(turns_told) - min(turns_told) + 1 - len(turns_told) if turns_told else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit, lines = cheapest(marked)
        faults = [sum(f == name for *_, f in marked) for name in ("blank", "duplicate", "truncated")]
        report.append((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(report, key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, n int, slice string, at string, symbol string, fault string, digest string"


def frame(spark, turns):
    return spark.createDataFrame([(*t, 7, "x", "x", "x", "x", "x") for t in turns], SCHEMA)


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_turns(seed, conversations, length):
    rng = random.Random(seed)
    turns = []
    for conv in range(conversations):
        for turn in range(rng.randrange(length)):
            turns.append(
                (
                    conv if conv % 9 else None,
                    rng.choice([None, turn, turn, turn, turn + 3, -turn]),
                    rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "ubuntu"]),
                    rng.choice(["Yes.", "no", " ", "", None, "Done! ", "é?\x0b", "long " * 200, f"turn {turn}.", f"turn {turn}"]),
                )
            )
    return turns


def test_tables_equal_the_search():
    tables, rng = repair.tables(), random.Random(5)
    assert len(tables.vectors) < 40
    for _ in range(1_500):
        symbols = [rng.randrange(repair.SYMBOLS) for _ in range(rng.randrange(14))]
        rows = [({"s": "system", "u": "user", "a": "assistant", "?": "tool"}["sua?"[k % 4]], "t", "truncated" if k >= 4 else "") for k in symbols]
        cost, audit, _ = cheapest(rows)
        edits, state = tables.edits(symbols, 0, 0)
        assert "".join(edits) + "I" * repair.closing(state) == audit
        following, added, leaves = tables.composed(np.array(symbols, np.int64))
        assert added[0] + tables.vectors[following[0]][0] == cost and leaves[0, 0] == state


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    turns = random_turns(seed, 60, 14)
    turns += turns[:5]  # rows given twice
    assert got(repair.damage_and_repair(frame(spark, turns))) == expected(turns)


def test_one_conversation_over_all_slices(spark):
    rng = random.Random(8)
    turns = [(5, k // 2, rng.choice(["user", "assistant", "system"]), rng.choice([f"Text {k}.", f"text {k}", "Same."])) for k in range(3_000)]
    turns += [(k, t, "user", "Hello.") for k in range(10, 40) for t in range(2)]
    turns += [(4, 1, "user", "copy.")] * 900  # a third of the rows are one row
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fixed = repair.repair(frame(spark, turns).repartition(7))
        assert fixed.segments.value and fixed.edits.select("slice").distinct().count() > 2
        assert got(fixed.report()) == expected(turns, damage=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_edits_give_the_repaired_turns(spark):
    turns = [(1, 0, "user", "Hi."), (1, 1, "user", "Hello?"), (1, 2, "tool", "x."), (1, 3, "user", "Hi.")]
    edits = repair.repair(frame(spark, turns)).edits.collect()
    assert "".join(e["edit"] for e in edits) == "KIKRD"
    assert [(e["role"], e["text"]) for e in edits if e["edit"] != "D"] == [
        ("user", "Hi."),
        ("assistant", ""),
        ("user", "Hello?"),
        ("assistant", "x."),
    ]


def test_extreme_turn_numbers(spark):
    turns = [(1, -(1 << 63), "user", "a."), (1, (1 << 63) - 1, "assistant", "b.")]
    (row,) = repair.repair(frame(spark, turns)).report().collect()
    assert row["gaps"] == (1 << 63) - 1 and row["audit"] == "KK"


def test_conversation_ids_as_text(spark):
    turns = spark.createDataFrame([("x", 0, "user", "a."), (None, 0, "user", "a.")], "conv_id string, turn int, role string, text string")
    assert sorted((r["conv_id"] or "", r["audit"]) for r in repair.repair(turns).report().collect()) == [("", "KI"), ("x", "KI")]


def test_all_rows_dropped_and_empty_table(spark):
    turn = next(t for t in range(1_000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    assert got(repair.damage_and_repair(frame(spark, [(1, turn, "user", "a.")]))) == [(1, 0, 0, 0, 0, 0, 0, "", EMPTY)]
    assert got(repair.damage_and_repair(frame(spark, [(1, turn, "user", "a.")]).limit(0))) == []
    assert got(repair.repair(frame(spark, [(1, 2, "user", " ")])).report()) == [(1, 0, 1, 0, 0, 0, 3, "D", EMPTY)]
