"""Chat formatting: logged snapshots of a growing conversation collapse to the longest before rendering.

A turn's hash covers its number, role and text. The hash of a prefix is the XOR of its turns' hashes (two independent
64-bit ones) beside its number of rows, a running value that needs no row order beyond the turn number. A conversation
whose whole key is a proper prefix key of another is dropped by an anti-join; of equal ones the smallest id stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns in one window or one rendered part, so that no task holds an unbounded conversation.
PART_TURNS = 256

KEY = ["n", "x1", "x2"]


def _part(turn: Column, part_turns: int) -> Column:
    return F.coalesce(F.floor(turn / part_turns), F.lit(-1)).cast("long")


def _plain(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")


def maximal(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """conv_id, n_turns and copies of each conversation that no longer one continues.

    Rows repeated exactly count once. Rows that share a turn number are one step; a null turn comes first; null roles,
    texts and ids are values like any other.
    """
    content = [F.col("turn"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    rows = _plain(turns).select("conv_id", "turn", F.xxhash64(F.lit(1), *content).alias("x1"),
                                F.xxhash64(F.lit(2), *content).alias("x2")).distinct()
    sums = [F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2")]
    steps = rows.groupBy("conv_id", "turn").agg(F.count("*").alias("n"), *sums)
    steps = steps.withColumn("part", _part(F.col("turn"), part_turns))
    parts = steps.groupBy("conv_id", "part").agg(F.sum("n").alias("n"), *sums)
    whole = parts.groupBy("conv_id").agg(F.sum("n").alias("n"), *sums)

    def running(over, n):
        return [F.sum("n").over(over).alias(n[0]), F.bit_xor("x1").over(over).alias(n[1]),
                F.bit_xor("x2").over(over).alias(n[2])]

    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = parts.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), *running(before, ["n0", "a0", "b0"]))
    inside = Window.partitionBy("conv_id", "part").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    prefixes = (
        steps.select("conv_id", "part", *running(inside, ["n", "x1", "x2"]))
        .join(earlier, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")))
        .select("conv_id", (F.col("n") + F.coalesce("n0", F.lit(0))).alias("n"),
                F.col("x1").bitwiseXOR(F.coalesce("a0", F.lit(0))).alias("x1"),
                F.col("x2").bitwiseXOR(F.coalesce("b0", F.lit(0))).alias("x2"))
    )
    totals = whole.select(F.col("conv_id").alias("_whole"), F.col("n").alias("n_all"))
    proper = (
        prefixes.join(totals, F.col("conv_id").eqNullSafe(F.col("_whole")))
        .filter("n < n_all").select(*KEY).distinct()
    )
    return (
        whole.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
        .join(proper, KEY, "left_anti")
        .select("conv_id", F.col("n").alias("n_turns"), "copies")
    )


def _numbered(rows: DataFrame, part_turns: int) -> DataFrame:
    """The rows with their place in the conversation, from 0: by turn (nulls first), role and text.

    Rows are counted by stretches of turn numbers first, so that no window holds a whole long conversation.
    """
    rows = rows.withColumn("_stretch", F.floor(F.col("turn") / part_turns))
    counted = rows.groupBy("conv_id", "_stretch").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(F.col("conv_id").alias("_conv"), F.col("_stretch").alias("_at"),
                             F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("conv_id", "_stretch").orderBy("turn", "role", "text")
    placed = rows.withColumn("_rank", F.row_number().over(inside))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("_stretch").eqNullSafe(F.col("_at"))
    return placed.join(offsets, same).withColumn("place", F.col("_before") + F.col("_rank") - 1).drop("_stretch", "_conv", "_at", "_before", "_rank")


def render(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """conv_id, part, n_turns, copies and text of each maximal conversation.

    A turn becomes ``<|role|>``, a line feed, its text, ``<|end|>`` and a line feed; a null role is ``unknown``, a null
    text is empty. Turns stand in the order of turn number (nulls first), role, text; rows repeated exactly are one.
    Every ``part_turns`` of them, from the first, make a row, so conversations of up to so many are one row, and no row
    holds more; parts count from 0. An empty table gives no rows; other columns are not read.
    """
    keep = maximal(turns, part_turns).select(F.col("conv_id").alias("_keep"), "n_turns", "copies")
    kept = _plain(turns).distinct().join(keep, F.col("conv_id").eqNullSafe(F.col("_keep")))
    line = lambda x: F.concat(F.lit("<|"), F.coalesce(x["role"], F.lit("unknown")), F.lit("|>\n"),
                              F.coalesce(x["text"], F.lit("")), F.lit("<|end|>\n"))
    return (
        _numbered(kept, part_turns).groupBy("conv_id", F.floor(F.col("place") / part_turns).cast("long").alias("part"))
        .agg(F.max("n_turns").alias("n_turns"), F.max("copies").alias("copies"),
             F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
        .select("conv_id", "part", "n_turns", "copies", F.array_join(F.transform("turns", line), "").alias("text"))
    )
