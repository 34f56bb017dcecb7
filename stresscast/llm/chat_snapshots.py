"""Cumulative-snapshot collapse of logged conversations, then rendering.

A chat logger that stores the whole conversation after every turn leaves rows that are prefixes of
longer ones. Each conversation gets a rolling hash per turn: the hash of the first k turns. A
conversation whose last hash is an inner hash of another one is a snapshot and goes (anti-join);
of equal conversations the smallest id stays. The rest is rendered.

Scale: the joins carry 64-hex-digit hashes and no texts. A hash shared by very many conversations (a
common first turn, copies of one log) is one row after the map-side distinct or minimum. A conversation
is one row of the result, so its own turns meet in one row; other conversations never do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stresscast.llm.common import staged


def turn_hashes(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turns, hashes)``: turns in order and the rolling hash after each.

    Turns are ordered by number, then role, then text; rows repeated in full count once. Null roles and
    texts differ from empty ones.
    """
    row = F.struct(*[F.col(c) for c in ("turn", "role", "text")])
    turns = (conversations.select("conv_id", row.alias("t")).groupBy("conv_id")
             .agg(F.array_sort(F.collect_set("t")).alias("turns")))
    one = lambda t: F.sha2(F.to_json(F.struct(t["role"].alias("role"), t["text"].alias("text")),
                                     {"ignoreNullFields": "false"}), 256)
    rolled = F.aggregate("turns", F.array().cast("array<string>"), lambda acc, t: F.concat(
        acc, F.array(F.sha2(F.concat(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit("")), one(t)), 256))))
    return turns.withColumn("hashes", rolled)


def maximal_conversations(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turns, n_turns)`` of conversations that are no proper prefix and no later copy of another."""
    hashed = staged(turn_hashes(conversations.select("conv_id", "turn", "role", "text")), "chats")
    last = F.element_at("hashes", -1)
    inner = hashed.select(F.explode(F.slice("hashes", F.lit(1), F.size("hashes") - 1)).alias("hash")).distinct()
    ends = hashed.groupBy(last.alias("hash")).agg(F.count("*").alias("n_equal"), F.min(F.struct(
        F.col("conv_id").isNull().alias("none"), F.col("conv_id"))).alias("first"))
    kept = ends.join(inner, "hash", "left_anti").select(F.col("first.conv_id").alias("keep"), "n_equal")
    return (hashed.join(kept, F.col("conv_id").eqNullSafe(F.col("keep")))
            .select("conv_id", "turns", F.size("turns").alias("n_turns"), "n_equal"))


def render_conversations(conversations: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, n_equal, text)``: the maximal conversations as role-tagged text.

    ``n_equal`` counts the logged copies that the row stands for. A null role renders as ``unknown``, a null
    text as empty. A null ``conv_id`` is a conversation of its own. Empty table: no rows.
    """
    line = lambda t: F.concat(F.lit("<|"), F.coalesce(t["role"], F.lit("unknown")), F.lit("|>\n"),
                              F.coalesce(t["text"], F.lit("")), F.lit("\n<|end|>\n"))
    return maximal_conversations(conversations).select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"), "n_equal",
        F.array_join(F.transform("turns", line), "").alias("text"))
