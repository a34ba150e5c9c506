"""Operator 7: chat formatting of maximal conversations, in DataFrame operations only.

Logs hold cumulative snapshots: the same conversation again and again, each
time with more turns. Rolling hashes of every conversation's turns name all of
its prefixes; a conversation whose whole is a proper prefix of another, or
equals one with a smaller id, is dropped by anti-joins. What stays is rendered.

A turn's place is its rank in the conversation, by (turn, role, text). The hash
of a prefix is the running xor, in two 64-bit numbers, of hashes of (place,
role, text). Places and running values are found in blocks of ``BLOCK`` turns
and carried over from block to block, so a conversation with a third of all
turns spreads over many tasks. Likewise a rendered conversation comes in
segments of at most ``BLOCK`` turns: no task ever holds it whole.

Rows without a conversation id or turn number belong to no conversation and are
left out. Equal rows of a conversation count once. Null roles render as
``user``, null texts as empty. The last segment of a conversation ends with the
end of its last turn. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

BLOCK = 256
#: The marks of a turn's begin and end.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"


def _placed(turns: DataFrame) -> DataFrame:
    """Turns with their place in the conversation, from 0, and their block of turn numbers."""
    blocked = turns.withColumn("block", F.floor(F.col("turn") / BLOCK))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    sizes = blocked.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("conv_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return (blocked.withColumn("rank", F.row_number().over(inside) - 1).join(starts, ["conv_id", "block"])
            .select("conv_id", "turn", "role", "text", (F.col("start") + F.col("rank")).alias("place")))


def _prefixes(placed: DataFrame) -> DataFrame:
    """(conv_id, length, h1, h2): the hashes of every prefix of every conversation."""
    marks = [F.xxhash64(F.lit(seed), "place", "role", "text") for seed in (1, 2)]
    each = placed.select("conv_id", "place", F.floor(F.col("place") / BLOCK).alias("block"),
                         marks[0].alias("m1"), marks[1].alias("m2"))
    sums = each.groupBy("conv_id", "block").agg(F.bit_xor("m1").alias("s1"), F.bit_xor("m2").alias("s2"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("conv_id", "block", *[F.coalesce(F.bit_xor(f"s{i}").over(before), F.lit(0)).alias(f"c{i}")
                                                for i in (1, 2)])
    inside = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rolled = each.select("*", *[F.bit_xor(f"m{i}").over(inside).alias(f"r{i}") for i in (1, 2)])
    return rolled.join(carried, ["conv_id", "block"]).select(
        "conv_id", (F.col("place") + 1).alias("length"), F.col("r1").bitwiseXOR(F.col("c1")).alias("h1"),
        F.col("r2").bitwiseXOR(F.col("c2")).alias("h2"))


def maximal_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, place): the turns of the conversations that no other one extends or repeats."""
    turns = (conversations.where("conv_id IS NOT NULL AND turn IS NOT NULL")
             .select("conv_id", "turn", F.coalesce("role", F.lit("user")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text")).distinct())
    placed = materialise(_placed(turns), "chat-placed")
    prefixes = materialise(_prefixes(placed), "chat-prefixes")
    lengths = prefixes.groupBy("conv_id").agg(F.max("length").alias("length"))
    whole = prefixes.join(lengths, ["conv_id", "length"])
    # Of equal conversations the smallest id stays; the minimum combines before the shuffle.
    single = whole.groupBy("length", "h1", "h2").agg(F.min("conv_id").alias("conv_id"))
    proper = prefixes.join(lengths.withColumnRenamed("length", "whole"), "conv_id").where("length < whole")
    shorter = proper.select("length", "h1", "h2").distinct()
    stay = single.join(shorter, ["length", "h1", "h2"], "left_anti").select("conv_id")
    return placed.join(stay, "conv_id", "left_semi")


def render(turns: DataFrame) -> DataFrame:
    """(conv_id, segment, n_turns, text): conversations as chat text, ``BLOCK`` turns to a segment."""
    turn = F.concat(F.lit(TURN_START), F.col("role"), F.lit("\n"), F.col("text"), F.lit(TURN_END))
    parts = turns.select("conv_id", F.floor(F.col("place") / BLOCK).cast("bigint").alias("segment"), "place", turn.alias("t"))
    lines = F.array_sort(F.collect_list(F.struct("place", "t")))
    return (parts.groupBy("conv_id", "segment").agg(F.count(F.lit(1)).alias("n_turns"), lines.alias("l"))
            .select("conv_id", "segment", "n_turns", F.array_join(F.transform("l", lambda x: x["t"]), "").alias("text")))


def format_chats(conversations: DataFrame) -> DataFrame:
    """Maximal conversations of (conv_id, turn, role, text), rendered in segments."""
    return render(maximal_conversations(conversations))
