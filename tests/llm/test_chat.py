from pyspark.sql import functions as F

from tankwise.llm.chat import aligned, preference_segments, repeated_replies, turns
from tests.llm.frames import found

COLUMNS = ("pair_id", "part", "turn", "sub", "role", "rendered", "train")


def pairs(spark, rows):
    return spark.createDataFrame(rows, "pair_id long, side string, turn long, sub long, role string, text string")


def both(pair, chosen, rejected):
    return [(pair, side, k, 1, *t) for side, ts in (("chosen", chosen), ("rejected", rejected)) for k, t in enumerate(ts)]


def brute(chosen, rejected):
    same = 0
    while same < min(len(chosen), len(rejected)) and chosen[same] == rejected[same]:
        same += 1
    made = [("prompt", k, t, False) for k, t in enumerate(chosen[:same])]
    for part, side in (("chosen", chosen), ("rejected", rejected)):
        made += [(part, k, t, t[0] == "assistant") for k, t in enumerate(side) if k >= same]
    return made


CASES = [
    ([("user", "hi"), ("assistant", "a")], [("user", "hi"), ("assistant", "b")]),
    ([("system", "s"), ("user", "hi"), ("assistant", "a"), ("user", "more")], [("system", "s"), ("user", "hi")]),
    ([("user", "hi")], [("user", "hi")]),
    ([("user", "x")], [("assistant", "x")]),
    ([("user", "a"), ("assistant", "b"), ("user", "c")], [("user", "a"), ("assistant", "z"), ("user", "c")]),
    ([("user", "alone")], []),
    ([("user", "<|end|>\n"), ("assistant", "")], [("user", "<|end|>\n"), ("assistant", "é" * 50_000)]),
]


def test_longest_common_prefix(spark):
    rows = [r for n, case in enumerate(CASES) for r in both(n, *case)]
    want = sorted(
        (
            (n, part, k, 1, role, f"<|{role}|>\n{text}<|end|>\n", train)
            for n, case in enumerate(CASES)
            for part, k, (role, text), train in brute(*case)
        ),
        key=repr,
    )
    assert found(preference_segments(aligned(pairs(spark, rows))), *COLUMNS) == want


def test_turns_and_repeated_replies(spark):
    rows = [
        (1, 0, "user", "q1"),
        (1, 1, "assistant", "r1"),
        (1, 1, "assistant", "r1"),  # given twice
        (1, 2, "user", "bye"),  # after the last reply
        (2, 0, "user", None),
        (2, 1, "assistant", "r2"),
        (2, 2, None, "no role"),
        (2, 3, "assistant", "later"),
        (3, None, "system", "s"),
        (3, 0, "user", "b"),
        (3, 0, "user", "a"),  # two turns with one number
        (4, 0, "user", "nobody answers"),
        (None, 0, "user", "lost"),
        ((1 << 63) - 1, 0, "assistant", "r5"),
    ]
    frame = spark.createDataFrame([(*r, "x", "x") for r in rows], "conv_id long, turn int, role string, text string, last string, sub string")
    made = turns(frame)
    assert sorted(r[:1] + r[2:] for r in found(made.filter("conv_id = 3"), "turn", "sub", "role", "text")) == [(-1, "system", "s"), (0, "user", "a"), (0, "user", "b")]
    got = found(preference_segments(repeated_replies(made)), "pair_id", "part", "turn", "role", "rendered", "train")
    assert got == [
        (1, "chosen", 1, "assistant", "<|assistant|>\nr1<|end|>\n", True),
        (1, "chosen", 2, "user", "<|user|>\nbye<|end|>\n", False),
        (1, "prompt", 0, "user", "<|user|>\nq1<|end|>\n", False),
        (1, "rejected", 1, "assistant", "<|assistant|>\n<|end|>\n", True),
        (2, "chosen", 3, "assistant", "<|assistant|>\nlater<|end|>\n", True),
        (2, "prompt", 0, "user", "<|user|>\n<|end|>\n", False),
        (2, "prompt", 1, "assistant", "<|assistant|>\nr2<|end|>\n", False),
        (2, "prompt", 2, "", "<||>\nno role<|end|>\n", False),
        (2, "rejected", 3, "assistant", "<|assistant|>\nr2<|end|>\n", True),
        (3, "prompt", -1, "system", "<|system|>\ns<|end|>\n", False),
        (3, "prompt", 0, "user", "<|user|>\na<|end|>\n", False),
        (3, "prompt", 0, "user", "<|user|>\nb<|end|>\n", False),
        (4, "prompt", 0, "user", "<|user|>\nnobody answers<|end|>\n", False),
        ((1 << 63) - 1, "chosen", 0, "assistant", "<|assistant|>\nr5<|end|>\n", True),
        ((1 << 63) - 1, "rejected", 0, "assistant", "<|assistant|>\n<|end|>\n", True),
    ]


def test_every_turn_comes_out(spark):
    """All turns and conversations of a table, and ids that are no numbers."""
    frame = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").withColumn("conv_id", F.concat(F.lit("c"), "conv_id"))
    made = turns(frame)
    segments = preference_segments(repeated_replies(made))
    kept = segments.filter("part <> 'rejected'").select(F.col("pair_id").alias("conv_id"), "turn", "sub", "role")
    assert kept.count() == made.count() and kept.exceptAll(made.select("conv_id", "turn", "sub", "role")).isEmpty()
    assert segments.filter("part = 'rejected'").count() > 0


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert preference_segments(repeated_replies(turns(none))).collect() == []
