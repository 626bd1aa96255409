"""Ranked lexical search by accumulator-limited term-at-a-time evaluation.

Items ask for the documents that score best by their terms. The inverted lists of the items' terms are stored once: a row for
each document and term that may be an item's (a Bloom filter of fixed size is all that tasks know of the terms; the join decides).

Every item takes its terms rarest first, in blocks: the first holds lists of ``BLOCK`` postings together, each further one ``GROWTH`` times
as many as all before, so the rounds grow with the logarithm of the corpus. While an item may still create accumulators, every
document in its block's lists gets or raises one. Then the ``k`` best accumulators are completed, which gives a score that ``k``
documents reach: the threshold. It is at least the k-th partial score. Once the bounds of the terms that are left sum to less, no document
without an accumulator can reach it, and the item creates no more. Accumulators that cannot reach it either are
dropped; the survivors get the rest of their score exactly, from their own postings rather than from the long lists.

Sums are by (item, document), so a term that stands everywhere makes no hot group; all arithmetic is 64-bit.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from guestbook.llm.common import rows_of, scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same in UTF-8 after A-Z were lower-cased.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Bits of the filter of terms, a power of two. A fuller filter lets more foreign terms through, which the join then drops.
FILTER_BITS = 1 << 22
_SEED = 42  # of Spark's xxhash64
BLOCK = 4096
GROWTH = 4
#: Length normalisation in hundredths.
SLOPE = 75


def item_terms(items: DataFrame, id_column: str = "item_id") -> DataFrame:
    """``item, item_id, term, times``: the terms of each item. ``item`` numbers the rows, so items of equal id stay apart."""
    terms = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0))
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(id_column).alias("item_id"), terms.alias("terms"))
    each = rows.select("item", "item_id", F.explode("terms").alias("term"))
    return each.groupBy("item", "item_id", "term").agg(F.count("*").alias("times"))


def term_filter(terms: DataFrame) -> np.ndarray:
    """Bits of all terms: at most ``FILTER_BITS / 64`` numbers, whatever the terms."""
    place = F.xxhash64("term").bitwiseAND(FILTER_BITS - 1)
    words = (
        terms.select(F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, int(xxhash64(term) & {63}))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
    )
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    for word, found in words.collect():
        bits[word] = np.uint64(found & 0xFFFFFFFFFFFFFFFF)
    return bits


def _posted(bits: np.ndarray) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def posted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for doc, own, text in rows_of(batches, "doc", "own", "text"):
            counts = Counter(_TERM.findall((text or "").encode("utf-8", "surrogatepass").lower()))
            if not counts:
                continue
            terms = list(counts)
            h = np.fromiter((xxhash.xxh64_intdigest(t, _SEED) for t in terms), np.uint64, len(terms))
            at = h & np.uint64(FILTER_BITS - 1)
            known = np.flatnonzero(bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1))
            some = [terms[i] for i in known]
            yield pd.DataFrame(
                {
                    "doc": doc,
                    "own": [own] + [None] * len(some),
                    "term": [None] + [t.decode("utf-8", "surrogatepass") for t in some],
                    "tf": [0] + [counts[t] for t in some],
                    "n": sum(counts.values()),
                }
            )

    return posted


def _gathered(batches: Iterator[pd.DataFrame], rows: int = 50_000) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= rows:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def postings(docs: DataFrame, bits: np.ndarray, id_column: str = "doc_id") -> DataFrame:
    """``doc, own, term, tf, n``, stored once. A document with terms has a row with its id (as text) and no term, and one for each term
    that passes the filter; ``doc`` numbers the rows of ``docs``, ``n`` counts a document's terms with repeats."""
    rows = docs.select(F.monotonically_increasing_id().alias("doc"), F.col(id_column).cast("string").alias("own"), "text")
    posted = _posted(bits)
    made = rows.mapInPandas(lambda batches: _gathered(posted(batches)), "doc long, own string, term string, tf long, n long")
    return scratch(made, "postings")


def impact(documents: int, terms: int) -> Column:
    """What a posting scores for each unit of its term's weight."""
    m = f"({100 - SLOPE} + ({SLOPE} * n * {documents}L) div {max(1, terms)}L)"
    return F.expr(f"(1000000000 * tf) div (1000 * tf + 8 * {m})")


def weight(documents: int) -> Column:
    return F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2.0 * F.col("df") + 1))).cast("long")


def _top(scores: DataFrame, k: int, *order: Column) -> DataFrame:
    """The ``k`` first rows of each item; Spark cuts each task's rows to as many before the shuffle."""
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), *order)
    return scores.withColumn("rank", F.row_number().over(best)).where(f"rank <= {k}")


def _completed(partial: DataFrame, lists: DataFrame, wanted: DataFrame) -> DataFrame:
    """``partial`` (``item, doc, score, round``) with the score of the terms of later blocks added, from the documents' own postings."""
    later = wanted.select("item", "term", "value", "block")
    added = (
        partial.select("item", "doc", "round")
        .join(lists.select("doc", "term", "impact"), "doc")
        .join(later, ["item", "term"])
        .where("block > round")
        .groupBy("item", "doc")
        .agg(F.sum(F.col("value") * F.col("impact")).alias("more"))
    )
    return partial.join(added, ["item", "doc"], "left").select(
        "item", "doc", (F.col("score") + F.coalesce("more", F.lit(0))).alias("score")
    )


def _planned(terms: DataFrame, known: DataFrame, documents: int) -> DataFrame:
    """``item, item_id, term, value, bound, block, left``: what an occurrence is worth, the most a list can add, the block in which the
    item takes the term, and the bounds of its later blocks together. Terms of no weight or in no document are left out."""
    rows = terms.join(known, "term").withColumn("value", F.col("times") * weight(documents)).where("value > 0")
    rows = rows.withColumn("bound", F.col("value") * F.col("most"))
    rarest = Window.partitionBy("item").orderBy("df", "term")
    so_far = F.sum("df").over(rarest)
    rows = rows.withColumn("block", F.ceil(F.greatest(F.lit(0.0), F.log(so_far / BLOCK) / F.log(F.lit(float(GROWTH))))))
    blocks = Window.partitionBy("item").orderBy("block")
    rows = rows.withColumn("block", F.dense_rank().over(blocks) - 1)
    through = F.sum("bound").over(blocks.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("left", F.sum("bound").over(Window.partitionBy("item")) - through)


def ranked(items: DataFrame, docs: DataFrame, k: int = 10, item_column: str = "item_id", id_column: str = "doc_id") -> DataFrame:
    """``item, item_id, rank, id, score``: the ``k`` documents of highest score above nought for each row of ``items``.

    Equal scores stand by ascending id, a null id last. Null and empty texts have no terms: such documents don't count and are
    never found, such items find nothing. Texts of any length are read whole. Rows that repeat are documents or items of their own. Extra
    columns are ignored. An empty table on either side gives no rows.
    """
    ids = docs.schema[id_column].dataType
    terms = scratch(item_terms(items, item_column), "item-terms")
    stored = postings(docs, term_filter(terms), id_column)
    heads = stored.where("term is null")
    documents, length = heads.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    lists = stored.where("term is not null").withColumn("impact", impact(documents, length))
    vocabulary = terms.select("term").distinct()
    known = (
        lists.join(vocabulary, "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"), F.max("impact").alias("most"))
    )
    wanted = scratch(_planned(terms, known, documents), "wanted")
    lefts = wanted.select("item", "block", "left").distinct()

    creating = scratch(wanted.select("item").distinct(), "creating")
    partial, final, block = None, [], 0
    while not creating.isEmpty():
        now = wanted.where(F.col("block") == block).join(creating, "item", "left_semi").select("item", "term", "value")
        gained = lists.join(now, "term").select("item", "doc", (F.col("value") * F.col("impact")).alias("score"))
        every = gained if partial is None else partial.unionByName(gained)
        partial = scratch(every.groupBy("item", "doc").agg(F.sum("score").alias("score")), "accumulators")
        best = _top(partial, k, F.col("doc")).select("item", "doc", "score", F.lit(block).alias("round"))
        reached = _completed(scratch(best, "best"), lists, wanted).groupBy("item").agg(
            F.min("score").alias("threshold"), F.count("*").alias("held")
        )
        state = scratch(
            creating.join(lefts.where(F.col("block") == block), "item")
            .join(reached, "item", "left")
            .select("item", "left", F.when(F.col("held") >= k, F.col("threshold")).otherwise(0).alias("threshold")),
            "state",
        )
        # The last block leaves nothing, so every item comes to its end.
        ended = (F.col("left") < F.col("threshold")) | (F.col("left") == 0)
        able = partial.join(state, "item").where("score + left >= threshold")
        final.append(
            scratch(able.where(ended).select("item", "doc", "score", F.lit(block).alias("round")), "survivors")
        )
        partial = able.where(~ended).select("item", "doc", "score")
        creating = scratch(state.where(~ended).select("item"), "creating")
        block += 1
    if not final:
        none = terms.limit(0)
        return none.select("item", "item_id", F.lit(1).alias("rank"), F.lit(None).cast(ids).alias("id"), F.lit(0).cast("long").alias("score"))

    scores = scratch(_completed(reduce(DataFrame.unionByName, final), lists, wanted).where("score > 0"), "scores")
    named = scores.join(heads.select("doc", F.col("own").cast(ids).alias("id")), "doc")
    top = _top(named, k, F.col("id").asc_nulls_last(), F.col("doc"))
    return top.join(terms.select("item", "item_id").distinct(), "item").select("item", "item_id", "rank", "id", "score")
