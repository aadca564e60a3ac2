"""Preference formatting of chosen and rejected conversations.

The turns of a pair's two sides are compared from the start; the longest common prefix is
rendered once as ``prompt``, the rest of each side as its completion.  A completion's mask
lists the character spans a model is trained on: the texts and end marks of assistant turns.

A pair is one result row, so its turns meet in one group, which is as long as that row; no
other grouping takes place.

Defined results: turns are ordered by turn, role and text, so ties and repeated rows have
one order.  A null role or text is rendered as empty and equals only null.  Rows without a
pair id or side are no turns of a pair.  A pair with one side has an empty other one.  Equal sides give
a prompt and two empty completions, with ``tie`` true.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>\n"


def _rendered(turn: Column) -> Column:
    return F.concat(
        F.lit("<|"), F.coalesce(turn["role"], F.lit("")), F.lit("|>\n"),
        F.coalesce(turn["text"], F.lit("")), F.lit(END),
    )


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _spans(turns: Column) -> Column:
    """Spans (start, end) of what the assistant says, counted from the completion's start."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        after = state["at"] + F.length(_rendered(turn))
        head = state["at"] + F.length(F.coalesce(turn["role"], F.lit(""))) + 5
        span = F.array(F.struct(head.alias("start"), (after - 1).alias("end")))
        spans = F.when(turn["role"] == "assistant", F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(after.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def preference_pairs(turns: DataFrame) -> DataFrame:
    """From (pair_id, side, turn, role, text), side being chosen or rejected, a row per pair:
    pair_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask, tie.
    """
    turn = F.struct("turn", "role", "text")
    side = lambda name: F.transform(
        F.array_sort(F.collect_list(F.when(F.col("side") == name, turn))),
        lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")),
    )
    pairs = turns.where(F.col("pair_id").isNotNull() & F.col("side").isin("chosen", "rejected"))
    sides = pairs.groupBy("pair_id").agg(side("chosen").alias("_c"), side("rejected").alias("_r"))
    shorter = F.least(F.size("_c"), F.size("_r"))
    differ = F.array_position(
        F.zip_with("_c", "_r", lambda a, b: a.eqNullSafe(b)), F.lit(False)
    ).cast("int")
    cut = sides.withColumn(
        "n_common", F.least(shorter, F.when(differ > 0, differ - 1).otherwise(shorter))
    )
    rest = lambda name: F.slice(name, F.col("n_common") + 1, F.greatest(F.size(name), F.lit(1)))
    cut = cut.withColumns({
        "_p": F.slice("_c", F.lit(1), F.col("n_common")), "_c": rest("_c"), "_r": rest("_r"),
    })
    return cut.select(
        "pair_id", F.col("n_common").cast("long").alias("n_common"), _joined(F.col("_p")).alias("prompt"),
        _joined(F.col("_c")).alias("chosen"), _joined(F.col("_r")).alias("rejected"),
        _spans(F.col("_c")).alias("chosen_mask"), _spans(F.col("_r")).alias("rejected_mask"),
        ((F.size("_c") == 0) & (F.size("_r") == 0)).alias("tie"),
    )


def swapped_answers(conversations: DataFrame) -> DataFrame:
    """Preference turns from plain conversations: off-topic answers as the rejected side.

    Each conversation is the chosen side of a pair of its own.  Its rejected side has the
    same turns but for its last assistant turn, which is the one of the conversation beside
    it (ids 2k and 2k + 1), and ends there; without such a neighbour it ends before it.
    """
    turns = conversations.select("conv_id", "turn", "role", "text")
    last = turns.where("role = 'assistant'").groupBy("conv_id").agg(
        F.max("turn").alias("_at"),
        F.max_by("text", F.struct("turn", "text")).alias("_answer"),
    )
    other = last.select(
        F.when(F.col("conv_id") % 2 == 0, F.col("conv_id") + 1).otherwise(F.col("conv_id") - 1).alias("conv_id"),
        F.col("_answer").alias("text"),
    )
    chosen = turns.select(F.col("conv_id").alias("pair_id"), F.lit("chosen").alias("side"), "turn", "role", "text")
    before = (
        turns.join(last.select("conv_id", "_at"), "conv_id", "left")
        .where(F.col("_at").isNull() | (F.col("turn") < F.col("_at")))
        .select(F.col("conv_id").alias("pair_id"), F.lit("rejected").alias("side"), "turn", "role", "text")
    )
    answers = last.select("conv_id", "_at").join(other, "conv_id").select(
        F.col("conv_id").alias("pair_id"), F.lit("rejected").alias("side"),
        F.col("_at").alias("turn"), F.lit("assistant").alias("role"), "text",
    )
    return chosen.unionByName(before).unionByName(answers)
