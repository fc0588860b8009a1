"""Small corpora with the cases every operator has to cope with."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    # columns that clash with names the operators use
    " digest string, node string, h string, row string, hashes string, spans string, kept string, score string, _digest string"
)
WORDS = "the and of river stone light over under green house walks slowly tomorrow winter summer field".split()


def text(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(words))


def changed(of: str, every: int, seed: int = 0) -> str:
    """A near copy: every n-th word is another one."""
    words = of.split(" ")
    return " ".join(f"other{seed}x{k}" if k % every == every - 1 else w for k, w in enumerate(words))


def rows() -> list[tuple[int | None, str | None]]:
    base, long = text(1, 120), text(2, 30_000)
    return [
        (1, base),
        (2, base),  # an exact copy
        (3, changed(base, 60)),  # a near copy
        (4, changed(changed(base, 60), 55, 1)),  # near 3
        (5, None),
        (6, ""),
        (7, ""),
        (8, "   \n\t "),
        (9, "Ab,c dé 123!"),
        (10, "one two"),
        (11, "One TWO"),
        (12, long),
        (13, long + " and a bit more"),
        (None, "a text without an id of its own"),
        (None, base),
        (14, text(3, 200)),
        (14, text(3, 200)),  # a row given twice
        (15, "\x1f\x8b\x08 <|endoftext|> ΑΣ İ ﬁ 👍🏽 é"),
        (16, "12 345 !!"),
        (-17, text(4, 5)),
    ]


def docs(spark, pairs=None):
    filler = ("x",) * 9
    made = [(i, t, None if i is None or i % 5 == 0 else ("en" if i % 2 else "de"), "s", 1, *filler) for i, t in (rows() if pairs is None else pairs)]
    return spark.createDataFrame(made, SCHEMA)


def found(df, *columns: str) -> list[tuple]:
    """Collected rows in an order of their own."""
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
