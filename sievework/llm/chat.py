"""Chat formatting: collapse cumulative snapshots of conversations, then render the maximal ones.

A logger that stores a conversation after every turn leaves logs that are prefixes of longer
logs.  A rolling hash over the turns gives every prefix a key; anti-joins on these keys keep
the logs that no longer log begins with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.session import through_storage

#: Distinct turn numbers in one slice; running sums work on slices, then on one row per slice.
SLICE = 1024


def _turn_sums(turns: DataFrame) -> DataFrame:
    """One row per (conv_id, turn): both hashes summed over the rows of the turn, and their number.

    Sums of 64-bit hashes are kept as decimals, which cannot overflow below 10^19 rows.
    """
    parts = [F.col("turn"), F.coalesce(F.col("role"), F.lit("\0null")), F.coalesce(F.col("text"), F.lit("\0null"))]
    hashed = turns.select("conv_id", "turn", F.xxhash64(*parts).cast("decimal(38,0)").alias("h1"),
                          F.xxhash64(F.lit("second"), *parts).cast("decimal(38,0)").alias("h2"))
    return hashed.groupBy("conv_id", "turn").agg(
        F.sum("h1").alias("h1"), F.sum("h2").alias("h2"), F.count(F.lit(1)).alias("rows"))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, rows, h1, h2, last): the rolling key of the conversation up to and with each turn.

    The key is (rows so far, two 64-bit sums of hashes of (turn, role, text)); the turn
    number is part of each hash, so the sums depend on the order of the turns and can be
    built in parallel.  Running sums go over slices of 1,024 turn numbers and then over one
    row per slice, so a conversation that holds a third of all rows is not summed in one task.
    """
    per_turn = through_storage(_turn_sums(turns).withColumn("slice", F.floor(F.col("turn") / SLICE)), "turn-sums")
    inner = Window.partitionBy("conv_id", "slice").orderBy("turn")
    outer = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = ("rows", "h1", "h2")
    slices = per_turn.groupBy("conv_id", "slice").agg(
        *[F.sum(c).cast("decimal(38,0)").alias(c) for c in sums], F.max("turn").alias("slice_last"))
    before = slices.select("conv_id", "slice",
                           *[F.coalesce(F.sum(c).over(outer), F.lit(0)).alias(f"b_{c}") for c in sums],
                           F.max("slice_last").over(Window.partitionBy("conv_id")).alias("last"))
    return (per_turn.join(before, ["conv_id", "slice"])
            .select("conv_id", "turn", "last",
                    *[(F.sum(c).over(inner) + F.col(f"b_{c}")).cast("decimal(38,0)").alias(c) for c in sums]))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies): conversations that are no proper prefix of another one.

    Of equal conversations the smallest conv_id stays, with their number in n_copies.
    """
    keys = ["rows", "h1", "h2"]
    prefixes = through_storage(prefix_hashes(turns), "turn-prefixes")
    whole = (prefixes.where("turn = last").groupBy(*keys)
             .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies")))
    proper = prefixes.where("turn < last").select(*keys).distinct()
    return whole.join(proper, keys, "left_anti").select("conv_id", F.col("rows").cast("long").alias("n_turns"), "n_copies")


def render(turns: DataFrame) -> DataFrame:
    """Maximal conversations, one row per turn row: conv_id, turn, position, n_turns, n_copies, segment.

    ``segment`` is the turn in chat markup; a conversation is its segments in the order of
    ``position``.  Needs conv_id, turn, role, text.

    NULL conv_id or turn: the row belongs to no conversation or has no place in it, and is left
    out.  NULL role is rendered as an empty role, NULL text as empty text (both differ from
    the empty string when prefixes are compared).  Rows that repeat (conv_id, turn) are all
    kept, in the order of role and text, and count as turns.  Extra columns are not read.  An
    empty table gives an empty result.
    """
    turns = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    turns = turns.where("conv_id is not null and turn is not null")
    kept = maximal_conversations(turns)
    rows = turns.join(kept, "conv_id").withColumn("slice", F.floor(F.col("turn") / SLICE))
    sizes = rows.groupBy("conv_id", "slice").agg(F.count(F.lit(1)).alias("n"))
    outer = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("conv_id", "slice", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("earlier"))
    order = Window.partitionBy("conv_id", "slice").orderBy("turn", "role", "text")
    markup = F.concat(F.lit("<|im_start|>"), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")),
                      F.lit("<|im_end|>\n"))
    return (rows.join(before, ["conv_id", "slice"])
            .select("conv_id", "turn", (F.col("earlier") + F.row_number().over(order) - 1).alias("position"),
                    "n_turns", "n_copies", markup.alias("segment")))
