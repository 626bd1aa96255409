"""Chat formatting of logged conversations, of which snapshots of longer ones are dropped first.

A log holds a conversation again each time it grows. The rolling hash of a conversation up to a turn is a sum
of the hashes of its turns, each with its place; a conversation whose whole hash is the hash of a
longer one up to some turn is a snapshot of that one, and an anti-join drops it. Of equal conversations
that of least id stays. As sums are merged in any order, a conversation of any length is summed where its rows
lie, in ranges of their order, and over the ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from guestbook.llm.common import scratch

#: Turns of a conversation that are rendered together.
BLOCK = 256
#: Characters of a text by which rows are dealt before they are sorted.
LEAD = 1024
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_SUMS = ["s0", "s1", "s2", "s3"]


def _hashes() -> list[Column]:
    """Four numbers of 32 bits, whose sums don't overflow, for a turn at its place."""
    what = [F.col("turn"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    out = []
    for seed in (11, 12):
        h = F.xxhash64(F.lit(seed), *what)
        out += [h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32)]
    return out


def turns(conversations: DataFrame) -> DataFrame:
    """``conv, turn, role, text`` with the hashes; a null turn comes before all others."""
    rows = conversations.select(
        F.col("conv_id").alias("conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63))).alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.withColumns(dict(zip(_SUMS, _hashes(), strict=True)))


def placed(rows: DataFrame) -> DataFrame:
    """Distinct ``rows`` with ``n, s0..s3``, the turns and rolling hash of the conversation up to the row, and ``last``.

    Rows stand in the order of turn, role and text. They are dealt by ranges of that order, numbered and summed where they lie, and the
    sums of a conversation's ranges before are added; so a long or crowded conversation is no one's window.
    """
    once = rows.dropDuplicates(["conv", "turn", *_SUMS])
    dealt = once.repartitionByRange("conv", "turn", "role", F.substring("text", 1, LEAD))
    dealt = scratch(dealt.withColumn("range", F.spark_partition_id()), "dealt-turns")
    sums = ["n", *_SUMS]
    each = dealt.groupBy("conv", "range").agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in _SUMS))
    before = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv")  # a row a range
    offsets = each.select(
        F.col("conv").alias("__conv"),
        F.col("range").alias("__range"),
        *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__{c}") for c in sums),
        F.sum("n").over(whole).alias("__all"),
    )
    inside = Window.partitionBy("conv", "range").orderBy("turn", "role", "text")
    running = dealt.select(
        "conv", "turn", "role", "text", "range", F.row_number().over(inside).alias("n"), *(F.sum(c).over(inside).alias(c) for c in _SUMS)
    )
    same = F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("range") == F.col("__range"))
    return (
        running.join(offsets, same)
        .select("conv", "turn", "role", "text", *((F.col(c) + F.col(f"__{c}")).alias(c) for c in sums), "__all")
        .withColumn("last", F.col("n") == F.col("__all"))
        .drop("__all")
    )


def maximal(marks: DataFrame) -> DataFrame:
    """``conv``: conversations that aren't the beginning of a longer one; of equal ones the first. ``marks`` is of ``placed``."""
    key = ["n", *_SUMS]
    whole = marks.where("last").groupBy(*key).agg(F.min("conv").alias("conv"))
    begun = marks.where("not last").select(*key).distinct()
    return whole.join(begun, key, "left_anti").select("conv")


def rendered(conversations: DataFrame) -> DataFrame:
    """Maximal conversations as chat text.

    Returns ``conv_id, part, first_turn, n_turns, text``: a row for each ``BLOCK`` turns of a conversation, so that
    long ones aren't gathered whole; its parts in order and put together are the conversation. Turns of one number are sorted by role
    and text, nulls first. Rows that repeat count once; a null role is rendered as an empty one, a null text as no text, and both
    differ from empty ones when conversations are compared; a null turn comes before all others; rows without ``conv_id`` are one
    conversation; extra columns are ignored; an empty table gives no rows.
    """
    marks = scratch(placed(turns(conversations)), "placed-turns")
    kept = scratch(maximal(marks), "maximal").select(F.col("conv").alias("__conv"))
    line = F.concat(
        F.lit(OPEN), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(CLOSE + "\n")
    )
    own = marks.join(kept, F.col("conv").eqNullSafe(F.col("__conv")), "left_semi")
    return (
        own.withColumn("part", F.floor((F.col("n") - 1) / BLOCK))
        .groupBy("conv", "part")
        .agg(
            F.min("turn").alias("first_turn"),
            F.count("*").alias("n_turns"),
            F.array_sort(F.collect_list(F.struct("n", line.alias("line")))).alias("lines"),
        )
        .select(
            F.col("conv").alias("conv_id"),
            "part",
            F.when(F.col("first_turn") > -(2**63), F.col("first_turn")).alias("first_turn"),
            "n_turns",
            F.array_join("lines.line", "").alias("text"),
        )
    )
