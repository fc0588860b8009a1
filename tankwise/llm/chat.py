"""Preference pairs as prompt and masked completions.

The two conversations of a pair are compared turn by turn. The turns before the first difference are the
prompt, which is rendered once; the rest of either side is its completion, in which only the assistant's
turns are to be trained on. Turns stay rows: nothing gathers a conversation in one place, so one with very
many turns is as good as many short ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tankwise.llm.common import picked

ASSISTANT = "assistant"


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, sub, role, text`` in canonical form.

    A null role or text is empty, a null turn number comes first (-1), rows without a conversation are no
    turns. A row given twice is one turn. Different rows with one turn number are told apart and ordered by
    ``sub``, 60 bits of a digest of role and text, so that no group of rows has to be numbered."""
    rows = picked(conversations, conv_id=conv_id, turn=turn, role=role, text=text).select(
        "conv_id",
        F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    digest = F.substring(F.sha2(F.concat_ws(":", "role", "text"), 256), 1, 15)
    return rows.filter(F.col("conv_id").isNotNull()).distinct().withColumn("sub", F.conv(digest, 16, 10).cast("long"))


def repeated_replies(turns: DataFrame) -> DataFrame:
    """Pairs from single conversations, one row per turn of the longer side: ``pair_id, turn, sub,
    chosen_role, chosen_text, rejected_role, rejected_text``.

    ``chosen`` is the whole conversation. ``rejected`` ends with the last assistant turn and says the first
    reply again in place of every later one; a single reply becomes empty. So sides differ in any number of
    turns and in length. A conversation without an assistant has equal sides. Ids may be of any type."""
    reply = F.col("role") == ASSISTANT
    at = turns.filter(reply).groupBy("conv_id", "turn").agg(F.min("sub").alias("low"), F.max("sub").alias("high"), F.count(F.lit(1)).alias("n"))
    ends = at.groupBy("conv_id").agg(
        F.min("turn").alias("first_turn"),
        F.min_by("low", "turn").alias("first_sub"),
        F.max("turn").alias("last_turn"),
        F.max_by("high", "turn").alias("last_sub"),
        F.sum("n").alias("replies"),
    )
    known = turns.join(ends, "conv_id", "left")
    is_first = (F.col("turn") == F.col("first_turn")) & (F.col("sub") == F.col("first_sub"))
    said = known.filter(is_first).select("conv_id", F.col("text").alias("said"))
    joined = known.join(said, "conv_id", "left")
    behind = (F.col("turn") > F.col("last_turn")) | ((F.col("turn") == F.col("last_turn")) & (F.col("sub") > F.col("last_sub")))
    behind = F.coalesce(behind, F.lit(False))
    again = F.when(~reply, F.col("text")).when(F.col("replies") == 1, "").otherwise(F.col("said"))
    return joined.select(
        F.col("conv_id").alias("pair_id"),
        "turn",
        "sub",
        F.col("role").alias("chosen_role"),
        F.col("text").alias("chosen_text"),
        F.when(~behind, F.col("role")).alias("rejected_role"),
        F.when(~behind, again).alias("rejected_text"),
    )


def rendered(role: Column, text: Column) -> Column:
    """One turn as text."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def aligned(pairs: DataFrame) -> DataFrame:
    """One row per turn number of a pair from ``pair_id, side, turn, sub, role, text``, in the form of
    :func:`repeated_replies`; a side that has no such turn has nulls."""
    sides = {
        side: pairs.filter(F.col("side") == side).select(
            "pair_id", "turn", "sub", F.col("role").alias(f"{side}_role"), F.col("text").alias(f"{side}_text")
        )
        for side in ("chosen", "rejected")
    }
    return sides["chosen"].join(sides["rejected"], ["pair_id", "turn", "sub"], "full_outer")


def preference_segments(both: DataFrame) -> DataFrame:
    """One row per rendered turn: ``pair_id, part`` (prompt, chosen or rejected), ``turn, sub, role,
    rendered, train``.

    ``both`` has the sides of each pair turn by turn (:func:`aligned`). Turns are the same if role and text
    are. Sides that are equal throughout have a prompt and no completions; sides that differ at once have no
    prompt; if one side goes on where the other ends, the other's completion is empty. A pair with one side
    only has that side as completion. Concatenating a part's rows by ``turn, sub`` gives its text."""
    same = F.col("chosen_role").eqNullSafe(F.col("rejected_role")) & F.col("chosen_text").eqNullSafe(
        F.col("rejected_text")
    )
    # The first difference of each pair: the least sub of every turn number, then the least number.
    differ = both.filter(~same).groupBy("pair_id", "turn").agg(F.min("sub").alias("sub"))
    first = differ.groupBy("pair_id").agg(F.min("turn").alias("at"), F.min_by("sub", "turn").alias("at_sub"))
    placed = both.join(first, "pair_id", "left")
    in_prompt = (
        F.col("at").isNull()
        | (F.col("turn") < F.col("at"))
        | ((F.col("turn") == F.col("at")) & (F.col("sub") < F.col("at_sub")))
    )

    def part(name: Column, side: str, train: Column) -> Column:
        role, text = F.col(f"{side}_role"), F.col(f"{side}_text")
        made = F.struct(
            name.alias("part"), role.alias("role"), rendered(role, text).alias("rendered"), train.alias("train")
        )
        return F.when(role.isNotNull(), made)

    prompt = F.array(part(F.lit("prompt"), "chosen", F.lit(False)))
    completions = F.array(
        *(part(F.lit(side), side, F.col(f"{side}_role") == ASSISTANT) for side in ("chosen", "rejected"))
    )
    parts = F.when(in_prompt, prompt).otherwise(completions)
    return (
        placed.select("pair_id", "turn", "sub", F.explode(parts).alias("made"))
        .filter(F.col("made").isNotNull())
        .select("pair_id", "made.part", "turn", "sub", "made.role", "made.rendered", "made.train")
    )
