"""Equi-joins with optional null-safe keys, and the shapes that need care with hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from guestbook.session import stage

Pair = str | tuple[str, str]

_RIGHT = "_right_"
SPREAD = 32


def _pair(p: Pair) -> tuple[str, str]:
    return (p, p) if isinstance(p, str) else p


def join_on(
    left: DataFrame,
    right: DataFrame,
    equal: Sequence[Pair] = (),
    null_safe: Sequence[Pair] = (),
    how: str = "inner",
    when: Column | None = None,
) -> DataFrame:
    """Join on plain and null-safe keys; the right side's key columns are not kept.

    ``when`` is a further condition on left columns: a left row that fails it matches nothing.
    """
    equal, null_safe = [_pair(p) for p in equal], [_pair(p) for p in null_safe]
    keys = list(dict.fromkeys(r for _, r in [*equal, *null_safe]))
    tagged = right.withColumnsRenamed({k: _RIGHT + k for k in keys})
    terms = [F.col(a) == F.col(_RIGHT + b) for a, b in equal]
    terms += [F.col(a).eqNullSafe(F.col(_RIGHT + b)) for a, b in null_safe]
    if when is not None:
        terms.append(when)
    joined = left.join(tagged, reduce(lambda x, y: x & y, terms), how)
    return joined.drop(*[_RIGHT + k for k in keys])


def left_chain(root: DataFrame, steps: Sequence[tuple[DataFrame, Sequence[Pair]]]) -> DataFrame:
    """A chain of left joins, each step keyed on columns of what is already joined."""
    return reduce(lambda acc, step: join_on(acc, step[0], equal=step[1], how="left"), steps, root)


def full_outer(left: DataFrame, right: DataFrame, equal: Sequence[Pair]) -> DataFrame:
    """Full outer join as a left join plus the right rows nobody claimed.

    Spark cannot split a hot key of a full outer join, but it can split either half of this.
    Both sides keep their key columns, so their names must differ. The left side serves both
    halves and is staged, so that its own joins run once.
    """
    left = stage(left, "outer-left")
    pairs = [_pair(p) for p in equal]
    condition = reduce(lambda x, y: x & y, [F.col(a) == F.col(b) for a, b in pairs])
    claimed = left.select(*[a for a, _ in pairs]).dropna().distinct()
    unclaimed = right.join(claimed, condition, "left_anti")
    return left.join(right, condition, "left").unionByName(unclaimed, allowMissingColumns=True)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    equal: Sequence[Pair],
    hot: Column,
    how: str = "inner",
    ways: int = SPREAD,
) -> DataFrame:
    """Inner or left join in which rows that satisfy ``hot`` are known to share one key.

    Hot left rows are dealt over ``ways`` buckets and the few hot right rows copied into each,
    so the result is the plain join's. ``hot`` must read the same on both sides.
    """
    if how not in ("inner", "left"):
        raise ValueError("only the left side can be spread")
    pairs = [_pair(p) for p in equal]
    is_hot = F.coalesce(hot, F.lit(False))
    dealt = left.withColumn(
        "_bucket",
        F.when(is_hot, F.pmod(F.xxhash64(*left.columns), F.lit(ways)).cast("int")).otherwise(0),
    )
    buckets = F.when(is_hot, F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(F.array(F.lit(0)))
    copied = right.withColumn("_bucket", F.explode(buckets))
    return join_on(dealt, copied, equal=[*pairs, "_bucket"], how=how).drop("_bucket")


def lookup(
    left: DataFrame,
    right: DataFrame,
    equal: Sequence[Pair],
    value: str,
    alias: str,
    null_safe: bool = False,
) -> DataFrame:
    """Left join that takes one ``value`` per key, the least one, so it never adds rows.

    By default a null in any key means no match. Such rows have nothing to look for and go round the join.
    """
    pairs = [_pair(p) for p in equal]
    left_keys, right_keys = [a for a, _ in pairs], [b for _, b in pairs]
    if null_safe:
        one = right.groupBy(*right_keys).agg(F.min(value).alias(alias))
        return join_on(left, one, null_safe=pairs, how="left")
    one = right.dropna(subset=right_keys).groupBy(*right_keys).agg(F.min(value).alias(alias))
    complete = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in left_keys])
    incomplete = left.where(~complete).withColumn(alias, F.lit(None).cast(one.schema[alias].dataType))
    return join_on(left.where(complete), one, equal=pairs, how="left").unionByName(incomplete)


def longest_prefix(
    left: DataFrame,
    text: str,
    prefixes: DataFrame,
    prefix: str,
    values: Sequence[str],
    lengths: tuple[str, str] | None = None,
) -> DataFrame:
    """Left join on the longest ``prefix`` that ``text`` starts with; the prefix table holds one row per prefix.

    The rows are cut to their distinct leads, as many characters as the longest prefix has. Each lead is
    looked up at every length, and rows meet what their lead has found. ``lengths`` names the columns of the least and most
    characters that a text under a prefix may have: then the longest prefix counts whose lengths fit, rows are cut to leads
    and lengths, and a prefix may have several rows whose lengths don't overlap.
    """
    whole = F.length(text) if lengths else F.lit(0)
    reach = prefixes.agg(F.max(F.length(prefix))).first()[0] or 0
    lead = F.substring(F.col(text), 1, reach)
    leads = left.select(lead.alias("_lead"), whole.alias("_whole")).where("_lead <> ''").distinct()
    starts = leads.withColumn("_length", F.explode(F.sequence(F.lit(1), F.length("_lead"))))
    fit = [F.col(c).alias(n) for c, n in zip(lengths or (), ("_least", "_most"), strict=False)]
    table = prefixes.select(F.col(prefix).alias("_prefix"), F.struct(*[F.col(v) for v in values]).alias("_values"), *fit)
    found = (
        starts.join(table, F.expr("substring(_lead, 1, _length)") == F.col("_prefix"))
        .where(F.expr("_whole between _least and _most") if lengths else F.lit(True))
        .groupBy("_lead", "_whole")
        .agg(F.max_by("_values", "_length").alias("_values"))
    )
    met = (F.col("_of") == F.col("_lead")) & (F.col("_size") == F.col("_whole"))
    joined = left.withColumns({"_of": lead, "_size": whole}).join(found, met, "left")
    return joined.select(*left.columns, *[F.col("_values").getField(v).alias(v) for v in values])
