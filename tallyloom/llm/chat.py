"""Preference formatting, in DataFrame functions only.

A chosen and a rejected conversation share their first turns. The longest common
prefix of turns is rendered once as the prompt; what follows in each is a
completion, with a mask of the characters to train on: what the assistant says and
the end mark behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.texts import let, only

#: The marks around a turn.
HEAD, MIDDLE, END = "<|", "|>\n", "<|end|>\n"
TRAINED = "assistant"

TURNS = "array<struct<role:string,text:string>>"


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, turns)``: the turns of each conversation in order, as ``(role, text)``.

    A null role is ``unknown``, a null text empty. Turns of equal or null number are ordered by role and text (null
    numbers first); repeated rows are turns like any other. Rows without a conversation id take no part. A
    conversation is one cell, as its rendering is; it is gathered from partial lists.
    """
    rows = only(turns, conv_id=id_col, turn=turn_col, role=role_col, text=text_col).filter("conv_id IS NOT NULL")
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    said = F.transform(F.sort_array(F.collect_list(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return rows.groupBy("conv_id").agg(said.alias("turns"))


def common_turns(chosen: Column, rejected: Column) -> Column:
    """How many first turns agree in role and text."""
    same = F.transform(F.slice(chosen, F.lit(1), F.least(F.size(chosen), F.size(rejected))), lambda t, i: F.get(rejected, i).eqNullSafe(t))
    first_other = lambda s: F.when(F.array_contains(s, False), F.array_position(s, False).cast("int") - 1).otherwise(F.size(s))
    return let(same, first_other)


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(HEAD), turn["role"], F.lit(MIDDLE), turn["text"], F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def mask(turns: Column) -> Column:
    """``[start, stop)`` in code points of the rendering, for each turn of the assistant: its text and end mark."""
    size = lambda t: F.length(_rendered(t))
    body = lambda t: F.length(t["text"]) + len(END)
    none = F.array().cast("array<struct<start:int,stop:int>>")

    def step(state: Column, t: Column) -> Column:
        stop = state["at"] + size(t)
        span = F.struct((stop - body(t)).alias("start"), stop.alias("stop"))
        return F.struct(
            stop.alias("at"),
            F.when(t["role"] == TRAINED, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda s: s["spans"])


def format_preferences(pairs: DataFrame, id_col: str = "pair_id", chosen_col: str = "chosen", rejected_col: str = "rejected") -> DataFrame:
    """``(pair_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask)``, one row per pair.

    ``pairs`` holds both conversations as lists of ``(role, text)``. Where one is the beginning of the other, or
    both are equal, the shorter completion is empty, as is its mask. A null list counts as one without turns, a null
    turn or role as ``unknown``, a null text as empty. Repeated pairs stay; further columns are not read. Texts are
    rendered as they are, also where they hold marks like those of the rendering: spans are counted, not searched for.
    """
    clean = lambda c: F.transform(
        F.coalesce(F.col(c).cast(TURNS), F.array().cast(TURNS)),
        lambda t: F.struct(F.coalesce(t["role"], F.lit("unknown")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")),
    )
    rows = only(pairs, pair_id=id_col, chosen=chosen_col, rejected=rejected_col)
    rows = rows.select("pair_id", clean("chosen").alias("c"), clean("rejected").alias("r"))
    rows = rows.withColumn("n_common", common_turns(F.col("c"), F.col("r")))
    rest = lambda c: F.slice(c, F.col("n_common") + 1, F.greatest(F.size(c) - F.col("n_common"), F.lit(0)))
    parts = rows.select(
        "pair_id", "n_common", F.slice("c", F.lit(1), F.col("n_common")).alias("p"), rest("c").alias("c"), rest("r").alias("r")
    )
    return parts.select(
        "pair_id", "n_common", render(F.col("p")).alias("prompt"), render(F.col("c")).alias("chosen"), render(F.col("r")).alias("rejected"),
        mask(F.col("c")).alias("chosen_mask"), mask(F.col("r")).alias("rejected_mask"),
    )


def pairs_with_next(turns: DataFrame) -> DataFrame:
    """``(pair_id, chosen, rejected)`` from a table of single conversations.

    Chosen is a conversation up to its last answer. Rejected has the same turns, but the last answer of the
    conversation with the next id in place of its own (an empty answer if there is none): an answer to something
    else. Conversations without an answer make no pair.
    """
    told = conversations(turns)
    last = lambda t: F.size(t) - F.array_position(F.reverse(F.transform(t, lambda x: x["role"])), TRAINED).cast("int") + 1
    answered = told.filter(F.exists("turns", lambda t: t["role"] == TRAINED)).withColumn("turns", F.slice("turns", F.lit(1), last(F.col("turns"))))
    answers = answered.select((F.col("conv_id") - 1).alias("conv_id"), F.element_at("turns", -1)["text"].alias("other"))
    swapped = F.concat(
        F.slice("turns", F.lit(1), F.size("turns") - 1),
        F.array(F.struct(F.lit(TRAINED).alias("role"), F.coalesce("other", F.lit("")).alias("text"))),
    )
    return answered.join(answers, "conv_id", "left").select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"), swapped.alias("rejected"))
