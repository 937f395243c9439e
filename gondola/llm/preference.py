"""Preference formatting of chosen and rejected conversations. DataFrame functions only.

The longest common turn prefix of a pair is rendered once, as the prompt; what follows it
on either side is a completion. A completion comes with a mask: the character spans that
a model learns from, which are the answers of the assistant and their end marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# the template of a turn: opening, role, newline, text, closing
OPEN, CLOSE = "<|turn|>", "<|end|>\n"
TURNS = "array<struct<role:string,text:string>>"


def conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): one row per conversation, turns in order.

    A conversation is one training example, so it has to fit a row. A null turn number
    sorts first, equal numbers by role and text; repeated rows are repeated turns.
    """
    item = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    ordered = F.sort_array(F.collect_list(item))
    return turns.groupBy(F.col(conv_id).alias("conv_id")).agg(F.transform(
        ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
        .alias("turns"))


def last_answer_pairs(convs: DataFrame) -> DataFrame:
    """(conv_id, chosen, rejected): the rejected side gives an earlier answer again.

    Both sides are the conversation up to its last assistant turn. The rejected side has
    the assistant turn before that in its place, or no answer if there is none. Without
    any assistant turn both sides are the whole conversation.
    """
    role = F.transform("turns", lambda t: F.coalesce(t["role"] == "assistant", F.lit(False)))
    out = convs.withColumn("_is", role).withColumn(
        "_at", F.filter(F.sequence(F.lit(1), F.size("_is")), lambda i: F.get("_is", i - 1)))
    n = F.size("_at")
    last = F.when(n > 0, F.get("_at", n - 1)).otherwise(F.size("turns"))
    before = F.slice("turns", F.lit(1), last - 1)
    again = F.when(n > 1, F.array(F.get("turns", F.get("_at", n - 2) - 1))).otherwise(
        F.array().cast(TURNS))
    whole = n == 0
    return out.select(
        "conv_id", F.slice("turns", F.lit(1), last).alias("chosen"),
        F.when(whole, F.col("turns")).otherwise(F.concat(before, again)).alias("rejected"))


def common_turns(a: str, b: str) -> Column:
    """Number of leading turns that are equal in role and text; nulls equal nulls."""
    same = F.zip_with(a, b, lambda x, y: x["role"].eqNullSafe(y["role"])
                      & x["text"].eqNullSafe(y["text"]))
    n = F.least(F.size(a), F.size(b))
    differs = F.array_position(F.slice(same, F.lit(1), n), False)
    return F.when(differs > 0, differs.cast("int") - 1).otherwise(n)


def rendered(turns: Column) -> Column:
    """Text of some turns; a null role or text is an empty one."""
    parts = F.transform(turns, lambda t: F.concat(
        F.lit(OPEN), F.coalesce(t["role"], F.lit("")), F.lit("\n"),
        F.coalesce(t["text"], F.lit("")), F.lit(CLOSE)))
    return F.array_join(parts, "")


def mask(turns: Column) -> Column:
    """(start, length) of what is learned: assistant text with its closing mark."""
    size = lambda t: (F.length(F.coalesce(t["role"], F.lit("")))
                      + F.length(F.coalesce(t["text"], F.lit(""))) + len(OPEN) + 1 + len(CLOSE))
    head = lambda t: F.length(F.coalesce(t["role"], F.lit(""))) + len(OPEN) + 1
    empty = F.array().cast("array<struct<start:int,length:int>>")
    walked = F.aggregate(
        turns, F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda a, t: F.struct(
            (a["at"] + size(t)).alias("at"),
            F.when(t["role"] == "assistant", F.concat(a["spans"], F.array(F.struct(
                (a["at"] + head(t)).alias("start"), (size(t) - head(t)).alias("length")))))
            .otherwise(a["spans"]).alias("spans")),
        lambda a: a["spans"])
    return walked


def format_pairs(pairs: DataFrame, key: str = "conv_id") -> DataFrame:
    """Per pair: prompt, both completions with their masks, and the turns they share.

    A null side counts as a conversation without turns. Equal sides give the whole
    conversation as prompt and two empty completions; sides that differ at once give an
    empty prompt. An empty table gives no rows. Other columns of ``pairs`` are ignored.
    """
    none = F.array().cast(TURNS)
    sides = pairs.select(F.col(key), F.coalesce("chosen", none).alias("_c"),
                         F.coalesce("rejected", none).alias("_r"))
    cut = sides.withColumn("n_shared", common_turns("_c", "_r"))
    rest = lambda side: F.slice(side, F.col("n_shared") + 1, F.size(side))
    parts = cut.select(key, "n_shared", F.slice("_c", F.lit(1), F.col("n_shared")).alias("_p"),
                       rest("_c").alias("_c"), rest("_r").alias("_r"))
    return parts.select(
        key, F.col("n_shared").cast("bigint").alias("n_shared"),
        rendered(F.col("_p")).alias("prompt"), rendered(F.col("_c")).alias("chosen"),
        rendered(F.col("_r")).alias("rejected"), mask(F.col("_c")).alias("chosen_mask"),
        mask(F.col("_r")).alias("rejected_mask"))
