"""Interaction audit of filters: what each removes, alone and behind every prefix of the others.

Every filter is a relation of the ids that fail it, stored once. A prefix of an order keeps what none of its filters
removes, whatever their order, so ``n`` filters have ``2 ** n`` prefixes to look at rather than ``n!`` orders.
``survivors`` builds the relation ``(prefix, id)`` by one left-anti join a filter: what is there already stays, and what the
filter leaves of it stands for the prefixes with that filter. One left-semi join a filter then says which ids
it removes behind every prefix without it, and with them the labels that are lost. An id that fails a filter and isn't removed
there was removed earlier: the redundancies are the filter's own left-semi join with the documents less its removals.

Documents that fail no filter survive every prefix. They are counted once, by a left-anti join with all failing ids, and don't take part
in the rest. All joins are on ids, so no key is hot; counts are partial aggregates.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import reduce
from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestbook.llm.common import SPACE, scratch, text_key

MIN_WORDS = 100
#: Least percentage of words that are distinct, and largest percentage of capitals.
MIN_DISTINCT = 80
MAX_CAPITALS = 10
SYMBOLS = "[#$%&*|]"


def measured(docs: DataFrame, id_column: str = "doc_id", part: str = "lang") -> DataFrame:
    """``id, own, part, key`` and a flag for each filter on one text, stored once. ``id`` numbers the rows, ``own`` is the caller's id.

    Null texts are empty, a null part is the empty one.
    """
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")
    rows = docs.select(
        F.monotonically_increasing_id().alias("id"),
        F.col(id_column).alias("own"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        text_key(text).alias("key"),
        F.length(text).alias("chars"),
        (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))).alias("capitals"),
        text.rlike(SYMBOLS).alias("D"),
        F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")))[0].alias("w"),
    )
    return scratch(
        rows.select(
            "id",
            "own",
            "part",
            "key",
            (F.col("w.n") < MIN_WORDS).alias("A"),
            (100 * F.col("w.distinct").cast("long") < MIN_DISTINCT * F.col("w.n").cast("long")).alias("B"),
            (100 * F.col("capitals").cast("long") > MAX_CAPITALS * F.col("chars").cast("long")).alias("C"),
            "D",
        ),
        "measured",
    )


def copies(rows: DataFrame) -> DataFrame:
    """``id`` of the rows of ``measured`` whose text stands under a smaller id of the caller's too.

    Only the least id of a text is looked up, together with the text, so a text with many copies is no hot key.
    A row without an id is neither smaller nor greater than another.
    """
    firsts = rows.groupBy("key").agg(F.min("own").alias("own"))
    return rows.where("own is not null").join(firsts, ["key", "own"], "left_anti").select("id")


def failing(rows: DataFrame) -> dict[str, DataFrame]:
    """The relation of failing ids of each filter: A words, B distinct words, C capitals, D symbols, E copies."""
    found = {f: rows.where(f).select("id") for f in "ABCD"} | {"E": copies(rows)}
    return {f: scratch(ids, f"fails-{f}") for f, ids in found.items()}


def labelled(rows: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``id, part, good, toxic`` of the rows of ``measured``; of several labels of an id any one that says so counts."""
    known = labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("own")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    return rows.select("id", "own", "part").join(known, "own", "left").select(
        "id", "part", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")
    )


def _without(df: DataFrame, bit: int) -> DataFrame:
    return df.where(F.col("prefix").bitwiseAND(bit) == 0)


def survivors(rows: DataFrame, fails: Mapping[str, DataFrame]) -> DataFrame:
    """``prefix`` beside the columns of ``rows``, a row for each prefix that keeps it. A prefix is the sum of its filters' bits."""
    parts = [scratch(rows.withColumn("prefix", F.lit(0)), "survivors")]
    for i, ids in enumerate(fails.values()):
        left = reduce(DataFrame.unionByName, parts).join(ids, "id", "left_anti")
        parts.append(scratch(left.withColumn("prefix", F.col("prefix") + (1 << i)), "survivors"))
    return reduce(DataFrame.unionByName, parts)


def interactions(rows: DataFrame, fails: Mapping[str, DataFrame]) -> DataFrame:
    """A row for each part, order of the filters and step, from ``rows`` (``id, part, good, toxic``) and failing ids by filter.

    ``kept``: documents of the part after the step. ``removed``: by the step. ``redundant``: failing the step's filter, but removed
    earlier. ``unique_fails``: failing no other filter. ``good_lost``, ``toxic_lost``: labels among the removed. ``shapley``: the filter's
    ``removed``, summed over all orders. A part without rows has none here; all else is there, noughts included. No rows: no parts.
    """
    bits = {f: 1 << i for i, f in enumerate(fails)}
    n = len(bits)
    rows = scratch(rows, "rows")
    suspect = scratch(reduce(DataFrame.unionByName, fails.values()).distinct(), "suspect")
    clean = rows.join(suspect, "id", "left_anti").groupBy("part").agg(F.count("*").alias("clean"))
    alive = survivors(rows.join(suspect, "id", "left_semi"), fails)
    kept = scratch(alive.groupBy("part", "prefix").agg(F.count("*").alias("kept")), "kept")

    def per_filter(counts) -> DataFrame:
        return reduce(DataFrame.unionByName, [counts(f, ids).withColumn("filter", F.lit(f)) for f, ids in fails.items()])

    removed = scratch(
        per_filter(
            lambda f, ids: _without(alive, bits[f])
            .join(ids, "id", "left_semi")
            .groupBy("part", "prefix")
            .agg(F.count("*").alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost"))
        ),
        "removed",
    )
    failed = per_filter(lambda f, ids: rows.join(ids, "id", "left_semi").groupBy("part").agg(F.count("*").alias("failed")))

    def size(prefix: int) -> int:
        return prefix.bit_count()

    weights = [F.lit(math.factorial(size(p)) * math.factorial(max(0, n - 1 - size(p)))) for p in range(2**n)]
    whole = F.lit(2**n - 1)
    bit = F.element_at(F.create_map(*[F.lit(x) for f, b in bits.items() for x in (f, b)]), F.col("filter"))
    summed = removed.groupBy("part", "filter").agg(
        F.sum(F.col("removed") * F.element_at(F.array(*weights), F.col("prefix") + 1)).alias("shapley"),
        F.sum(F.when(F.col("prefix") + bit == whole, F.col("removed"))).alias("unique_fails"),
    )
    orders = F.array(*[F.array(*map(F.lit, order)) for order in permutations(bits)])
    steps = (
        rows.select("part")
        .distinct()
        .select("part", F.explode(orders).alias("order"))
        .select("part", "order", F.posexplode("order").alias("at", "filter"))
        .select(
            "part",
            F.array_join("order", "").alias("filter_order"),
            (F.col("at") + 1).alias("step"),
            "filter",
            reduce(
                lambda a, b: a + b,
                [F.when(F.array_position("order", f).between(1, F.col("at")), b).otherwise(0) for f, b in bits.items()],
            ).alias("prefix"),
        )
        .withColumn("after", F.col("prefix") + bit)
    )
    counts = [
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
    ]
    return (
        steps.join(clean, "part", "left")
        .join(kept.withColumnRenamed("prefix", "after"), ["part", "after"], "left")
        .join(removed, ["part", "filter", "prefix"], "left")
        .join(failed, ["part", "filter"], "left")
        .join(summed, ["part", "filter"], "left")
        .na.fill(0)
        .withColumn("kept", F.col("kept") + F.col("clean"))
        .withColumn("redundant", F.col("failed") - F.col("removed"))
        .select("part", "filter_order", "step", "filter", *(F.col(c).cast("long").alias(c) for c in counts))
    )


def audit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", part: str = "lang") -> DataFrame:
    """``interactions`` of the five filters of ``failing`` over whole documents.

    Null and empty texts have no words: they fail A alone, and E behind the first of them. Very long texts are measured whole. Repeated
    rows count each; none of equal id is a copy of the other. Extra columns are ignored, whatever their names. An empty table
    has no parts and gives no rows; without labels nothing is lost.
    """
    rows = measured(docs, id_column, part)
    return interactions(labelled(rows, labels, id_column), failing(rows))
