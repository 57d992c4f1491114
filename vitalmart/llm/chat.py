"""Preference pairs as a shared prompt and two masked completions. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, AFTER = "<|", "|>\n", "<|end|>\n"


def render(turns: Column) -> Column:
    """Turns (array of role, text) as one string: role marker, text, end marker each."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(AFTER))), "")


def mask(turns: Column, role: str = "assistant") -> Column:
    """Spans (start, end) of the rendered turns that are trained on: text and end marker of the
    role's turns, in code points, end exclusive."""
    size = lambda t: F.length(t["role"]) + F.length(t["text"]) + len(OPEN) + len(CLOSE) + len(AFTER)
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(acc: Column, t: Column) -> Column:
        span = F.struct((acc["at"] + len(OPEN) + F.length(t["role"]) + len(CLOSE)).alias("start"), (acc["at"] + size(t)).alias("end"))
        return F.struct((acc["at"] + size(t)).alias("at"), F.when(t["role"] == role, F.array_append(acc["spans"], span)).otherwise(
            acc["spans"]).alias("spans"))

    return F.aggregate(turns, begin, add, lambda acc: acc["spans"])


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): one row per conversation, turns in order of number, role and text.

    Turns with NULL number or id cannot be placed and are left out; NULL role or text reads as
    empty; repeated rows of a turn are one. A conversation is rendered whole, so its turns meet
    in one row.
    """
    rows = turns.select(F.col(id_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t")).where("conv_id is not null and t.turn is not null")
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_set("t")).alias("turns"))


def preference_examples(turns: DataFrame, pairs: DataFrame, role: str = "assistant", **columns: str) -> DataFrame:
    """One row per row of ``pairs`` (pair_id, chosen_id, rejected_id): pair_id, n_prompt_turns, prompt,
    chosen, rejected, chosen_mask, rejected_mask.

    The longest common prefix of both conversations (same role and text turn by turn) is rendered
    once as prompt; what follows it is rendered as each side's completion, with the spans
    of its ``role`` turns. If one conversation is the other's beginning its completion is empty; a
    missing or NULL id is a conversation without turns. Repeated pairs stay.
    """
    whole = conversations(turns, **columns)
    side = lambda name: whole.select(F.col("conv_id").alias(f"{name}_id"), F.col("turns").alias(name))
    none = F.array().cast(whole.schema["turns"].dataType)
    rows = pairs.select("pair_id", "chosen_id", "rejected_id").join(side("chosen"), "chosen_id", "left").join(
        side("rejected"), "rejected_id", "left")
    rows = rows.select("pair_id", F.coalesce("chosen", none).alias("a"), F.coalesce("rejected", none).alias("b"))
    same = F.zip_with("a", "b", lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    shared = F.aggregate(same, F.struct(F.lit(0).alias("n"), F.lit(False).alias("over")), lambda acc, s: F.struct(
        (acc["n"] + F.when(s & ~acc["over"], 1).otherwise(0)).alias("n"), (acc["over"] | ~s).alias("over")), lambda acc: acc["n"])
    rows = rows.withColumn("n", shared)
    rest = lambda c: F.slice(c, F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0)))
    return rows.select("pair_id", F.col("n").alias("n_prompt_turns"), render(F.slice("a", 1, F.col("n"))).alias("prompt"),
                       render(rest("a")).alias("chosen"), render(rest("b")).alias("rejected"),
                       mask(rest("a"), role).alias("chosen_mask"), mask(rest("b"), role).alias("rejected_mask"))
