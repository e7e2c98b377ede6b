"""Preference formatting: chosen and rejected conversations as one prompt and two completions.

The longest common prefix of turns is rendered once as the prompt; the turns after it become the
completions of the two sides, in which only the assistant's turns carry loss. Everything is a table
of turns: a conversation of any length is spread over rows and never gathered in one.

Conversations that open alike are paired two by two, in the order of their ids. The tables name no
preference, so each of the others is paired with itself up to its last reply, given another
conversation's last reply: of the next one in the order of ids that has no partner either, the last
one taking that of the one before.

Defined cases: rows without ``conv_id`` belong to no conversation; a null turn comes first, a null
role or text counts as empty; repeated rows count once, other rows of one turn follow each other by
role and text; equal conversations give a prompt and no completion; a single conversation gives
nothing, nor one without an assistant's turn; empty tables give an empty result; other columns are ignored. Only built-in functions are
used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coppice.llm.ranks import with_rank
from coppice.llm.text import stored

ASSISTANT = "assistant"


def clean_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, part, role, text)`` without repeats; ``part`` orders rows of one turn."""
    plain = turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    within = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    return plain.distinct().withColumn("part", F.row_number().over(within))


def pairs_by_opening(turns: DataFrame) -> DataFrame:
    """``(pair_id, chosen_id, rejected_id)``: conversations with the same first turn, two by two.

    They are numbered by id within their opening; the first of two is chosen and names the pair. The
    numbers come from a rank over all conversations, so an opening that very many share is spread out,
    and other openings change nothing.
    """
    first = turns.groupBy("conv_id").agg(F.min(F.struct("turn", "part", "role", "text")).alias("_o"))
    opening = F.sha2(F.concat_ws("\x00", "_o.role", "_o.text"), 256).alias("_opening")
    ranked = stored(
        with_rank(
            first.select("conv_id", opening), [F.col("_opening"), F.col("conv_id")], "_rank"
        ),
        "openings",
    )
    starts = (
        ranked.groupBy("_opening")
        .agg(F.min("_rank").alias("_start"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
    )
    placed = ranked.join(stored(starts, "shared-openings"), "_opening")
    return (
        placed.groupBy("_opening", F.floor((F.col("_rank") - F.col("_start")) / 2).alias("_k"))
        .agg(
            F.min("conv_id").alias("chosen_id"),
            F.max("conv_id").alias("rejected_id"),
            F.count(F.lit(1)).alias("_of"),
        )
        .filter("_of = 2")
        .select(F.col("chosen_id").alias("pair_id"), "chosen_id", "rejected_id")
    )


def other_replies(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(pair_id, chosen_id, rejected_id, side, turn, part, role, text)`` of derived pairs.

    They are made from the conversations that are in none of ``pairs``; ``rejected_id`` is the one
    whose reply was taken.
    """
    taken = pairs.select(F.explode(F.array("chosen_id", "rejected_id")).alias("conv_id"))
    last = (
        turns.filter(F.col("role") == ASSISTANT)
        .groupBy("conv_id")
        .agg(F.max(F.struct("turn", "part", "text")).alias("_last"))
        .join(taken, "conv_id", "left_anti")
    )
    ranked = stored(with_rank(last, [F.col("conv_id")], "_rank"), "last-replies")
    count = ranked.count()
    for_ranks = F.array(F.col("_rank") - 1)
    for_last = F.array(F.col("_rank") - 1, F.col("_rank") + 1)
    following = ranked.select(
        F.explode(F.when(F.col("_rank") == count - 2, for_last).otherwise(for_ranks)).alias("_rank"),
        F.col("conv_id").alias("rejected_id"),
        F.col("_last.text").alias("_reply"),
    )
    both = stored(
        ranked.join(following, "_rank").select("conv_id", "rejected_id", "_last", "_reply"),
        "reply-pairs",
    )
    at, end = F.struct("turn", "part"), F.struct("_last.turn", "_last.part")
    columns = ["turn", "part", "role", "text"]
    own = turns.join(both.select("conv_id", "rejected_id", "_last"), "conv_id").filter(at <= end)
    sides = F.when(at == end, F.array(F.lit("chosen"))).otherwise(F.array(F.lit("chosen"), F.lit("rejected")))
    shared = own.select("conv_id", "rejected_id", F.explode(sides).alias("side"), *columns)
    given = both.select(
        "conv_id", "rejected_id", F.lit("rejected").alias("side"), "_last.turn", "_last.part",
        F.lit(ASSISTANT).alias("role"), F.col("_reply").alias("text"),
    )
    names = [F.col("conv_id").alias("pair_id"), F.col("conv_id").alias("chosen_id"), "rejected_id"]
    return shared.unionByName(given).select(*names, "side", *columns)


def paired_rows(turns: DataFrame) -> DataFrame:
    """:func:`preference_rows` of all conversations, those that open alike first."""
    pairs = stored(pairs_by_opening(turns), "pairs")
    return _formatted(_sides(turns, pairs).unionByName(other_replies(turns, pairs)))


def preference_rows(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(pair_id, chosen_id, rejected_id, segment, turn, part, rendered, loss)``.

    ``segment`` is ``prompt``, ``chosen`` or ``rejected``; rows of one segment follow each other by
    ``(turn, part)``. ``turns`` comes from :func:`clean_turns`.
    """
    return _formatted(_sides(turns, pairs))


def _sides(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """The turns of both sides of pairs of whole conversations."""
    sides = F.explode(
        F.array(
            F.struct(F.lit("chosen").alias("side"), F.col("chosen_id").alias("conv_id")),
            F.struct(F.lit("rejected").alias("side"), F.col("rejected_id").alias("conv_id")),
        )
    )
    members = pairs.select("pair_id", "chosen_id", "rejected_id", sides.alias("_s")).select(
        "pair_id", "chosen_id", "rejected_id", "_s.side", "_s.conv_id"
    )
    return turns.join(members, "conv_id").drop("conv_id")


def _formatted(sides: DataFrame) -> DataFrame:
    rendered = F.concat(
        F.lit("<|im_start|>"), F.col("role"), F.lit("\n"), F.col("text"), F.lit("<|im_end|>\n")
    )
    placed = stored(
        sides.select(
            "pair_id",
            "chosen_id",
            "rejected_id",
            "side",
            F.struct("turn", "part").alias("at"),
            "role",
            rendered.alias("rendered"),
            F.sha2(F.concat_ws("\x00", "role", "text"), 256).alias("_same"),
        ),
        "preference",
    )
    differs = (F.col("_n") < 2) | (F.col("_low") != F.col("_high"))
    forks = (
        placed.groupBy("pair_id", "at")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min("_same").alias("_low"),
            F.max("_same").alias("_high"),
        )
        .filter(differs)
        .groupBy("pair_id")
        .agg(F.min("at").alias("_fork"))
    )
    common = F.col("_fork").isNull() | (F.col("at") < F.col("_fork"))
    return (
        placed.join(forks, "pair_id", "left")
        .filter(~common | (F.col("side") == "chosen"))
        .select(
            "pair_id",
            "chosen_id",
            "rejected_id",
            F.when(common, F.lit("prompt")).otherwise(F.col("side")).alias("segment"),
            F.col("at.turn").alias("turn"),
            F.col("at.part").alias("part"),
            "rendered",
            (~common & (F.col("role") == ASSISTANT)).alias("loss"),
        )
    )
