"""Chat formatting: cumulative snapshots of one conversation are collapsed, then the rest is rendered.

Each turn's place, role and text are hashed, and the hashes of a conversation's first turns are
combined into one 128-bit prefix hash per turn. A conversation whose last prefix hash is a proper
prefix of another one is a snapshot of it and goes, by an anti-join; of equal conversations the one
with the smallest id stays.

Defined results: turns are put in order by turn (NULL last), role and text. A NULL role is rendered as
`unknown`, a NULL text as an empty turn; NULL and empty differ when conversations are compared. Rows
without conv_id are one conversation. A repeated row is a repeated turn. An empty table gives no rows.
Other columns are not looked at. A conversation is one result row, so its turns must fit into one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: ChatML. Control words inside a text are taken out.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"


def _turn_hash(seed: int) -> Column:
    """xxhash64 passes over NULLs, so each value goes in with a mark whether it is there."""
    marked = [c for name in ("role", "text") for c in (F.col(name).isNull(), F.coalesce(name, F.lit("")))]
    return F.xxhash64(F.lit(seed), F.col("place"), *marked)


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """turns with place (from 1), n_turns, and prefix_a, prefix_b: the hash of all turns so far."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        turns.select("conv_id", "turn", "role", "text")
        .withColumn("place", F.row_number().over(order))
        .withColumn("prefix_a", F.bit_xor(_turn_hash(1)).over(so_far))
        .withColumn("prefix_b", F.bit_xor(_turn_hash(2)).over(so_far))
    )


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id of each conversation that no other one continues, n_turns, and n_equal: how many
    conversations are the same."""
    prefixes = prefix_hashes(turns).drop("role", "text", "turn")
    last = Window.partitionBy("conv_id")
    prefixes = prefixes.withColumn("n_turns", F.max("place").over(last))
    key = ["place", "prefix_a", "prefix_b"]
    whole = prefixes.where("place = n_turns").groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_equal"))
    proper = prefixes.where("place < n_turns").select(*key).distinct()
    return whole.join(proper, key, "left_anti").select("conv_id", F.col("place").alias("n_turns"), "n_equal")


def format_chats(turns: DataFrame) -> DataFrame:
    """Returns conv_id, n_turns, n_equal and text, the rendered conversation, of each maximal one."""
    kept = maximal_conversations(turns).withColumnRenamed("conv_id", "kept_id")
    control = r"<\|im_(start|end)\|>"
    said = F.regexp_replace(F.coalesce("text", F.lit("")), control, "")
    role = F.regexp_replace(F.coalesce("role", F.lit("unknown")), control, "")
    turn = F.struct(
        F.col("turn").isNull().alias("late"), "turn", "role", "text",
        F.concat(F.lit(TURN_START), role, F.lit("\n"), said, F.lit(f"{TURN_END}\n")).alias("shown"),
    )
    rows = turns.join(kept, turns["conv_id"].eqNullSafe(kept["kept_id"])).select("conv_id", "n_turns", "n_equal", turn.alias("said"))
    return (
        rows.groupBy("conv_id", "n_turns", "n_equal")
        .agg(F.sort_array(F.collect_list("said")).alias("said"))
        .select("conv_id", "n_turns", "n_equal", F.array_join("said.shown", "").alias("text"))
    )
