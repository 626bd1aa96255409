"""One row per key, chosen by a total order so that reruns agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from guestbook.functions.keys import natural_key
from guestbook.session import stage_spare

#: Marks for fingerprints of repeated rows, a power of two. A fuller table sends more rows through the shuffle, none astray.
MARKS = 1 << 24
_WORD = 64


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None = None) -> DataFrame:
    """Keep the first row of each key; by default in the order of all other columns, nulls last.

    ``row_number() = 1`` makes Spark cut every map task's rows to one per key before the
    shuffle, so a key that holds a third of the table does not gather in one task.
    """
    if order is None:
        order = [c for c in df.columns if c not in keys]
    if not order:
        return df.distinct()
    window = Window.partitionBy(*keys).orderBy(
        *[F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]
    )
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def distinct_keyed(df: DataFrame, key: str = "id", natural: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows with a surrogate key over ``natural`` (all columns by default)."""
    return df.distinct().withColumn(key, natural_key(*(natural or df.columns)))


def distinct_rows(df: DataFrame, marks: int = MARKS) -> DataFrame:
    """Distinct whole rows, of which those that stand once aren't shuffled.

    Eight bytes stand for a row and are counted. Those met twice or more set a mark each, in a table of at most ``marks`` bits that
    Spark broadcasts if its size allows. A row without a mark stands once and goes straight through; the others, among them all that
    repeat, are compared whole. Two rows that share a mark by chance therefore both stay. The frame is read three times, twice where
    nothing repeats, which costs less than moving its texts once.
    """
    names = df.columns
    fingerprint = F.xxhash64(*map(_quoted, names))
    place = F.pmod(fingerprint, F.lit(marks))
    counts = df.select(fingerprint.alias("f")).groupBy("f").agg(F.count("*").alias("n"))
    words = (
        counts.where("n > 1")
        .select(F.pmod("f", F.lit(marks)).alias("place"))
        .select(F.floor(F.col("place") / _WORD).alias("_word"), F.expr(f"shiftleft(1L, int(place % {_WORD}))").alias("bit"))
        .groupBy("_word")
        .agg(F.bit_or("bit").alias("_marks"))
    )
    words = stage_spare(words, "repeated-rows")
    if words.isEmpty():
        return df
    own, at = (unused_name(df, n) for n in ("_own_word", "_own_bit"))
    placed = df.withColumns({own: F.floor(place / _WORD), at: (place % _WORD).cast("int")})
    marked = F.expr(f"shiftright(_marks, `{at}`) & 1") == 1
    single = placed.join(words, F.col(own) == F.col("_word"), "left").where(~F.coalesce(marked, F.lit(False))).select(*map(_quoted, names))
    repeated = placed.join(words, F.col(own) == F.col("_word")).where(marked).select(*map(_quoted, names)).distinct()
    return single.unionByName(repeated)


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, drawn out until it isn't a column of ``df``."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name
