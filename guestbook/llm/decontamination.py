"""Benchmark decontamination by winnowing.

Of every ``WINDOW - GRAM + 1`` consecutive word grams the one of least hash is kept, in training and
test texts alike. A run of ``WINDOW`` words that both have therefore shares at least one kept gram at
the same place in it: joining the kept grams loses no shared run. A hit is then extended to all runs
around it, and these are joined with the runs of the test items. Items of fewer words than a run are
winnowed by their own length, word by word.

Test grams are joined, not shipped: Spark broadcasts them if its size check allows, else both
sides are shuffled by gram. Copies of a text share one key, so a group of copies costs one result row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestbook.llm.common import gram_hashes, mix64, rows_of, scratch, signed, text_key, word_hashes

WINDOW = 13
GRAM = 5
#: After A-Z became a-z: digits, small letters and every byte beyond ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def winnowed(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of the kept grams of a text, for runs of ``length`` words."""
    gram = GRAM if length == WINDOW else 1
    grams = gram_hashes(hashes, gram)
    width = length - gram + 1
    if len(grams) < width:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    least = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(1)
    places = np.unique(least + np.arange(len(least)))
    return places, mix64(grams[places] + np.uint64(length))


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Keys of all runs of ``length`` words."""
    return mix64(gram_hashes(hashes, length) ^ np.uint64(length))


def _item_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for item, text in rows_of(batches, "item", "text"):
        hashes = word_hashes(words_of(text))
        if not len(hashes):
            continue
        length = min(WINDOW, len(hashes))
        yield pd.DataFrame({"item": item, "length": length, "run": signed(runs(hashes, length))})


def item_runs(benchmark: DataFrame) -> DataFrame:
    """``(item, length, run)``: every run of every item; the item id is text, 'null' if it is null."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    return rows.mapInPandas(_item_rows, "item string, length int, run long").distinct()


def item_grams(benchmark: DataFrame) -> DataFrame:
    """``(gram)``: the winnowed grams of all items, each once."""

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (text,) in rows_of(batches, "text"):
            hashes = word_hashes(words_of(text))
            if len(hashes):
                yield pd.DataFrame({"gram": signed(winnowed(hashes, min(WINDOW, len(hashes)))[1])})

    return benchmark.select("text").mapInPandas(grams, "gram long").distinct()


def prints(docs: DataFrame, lengths: list[int], id_column: str = "doc_id") -> DataFrame:
    """``(id, key, n_words, grams)`` of every document: its winnowed grams for the given run lengths."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                hashes = word_hashes(words_of(text))
                keys = [winnowed(hashes, n)[1] for n in lengths]
                out.append((len(hashes), signed(np.unique(np.concatenate([np.empty(0, np.uint64), *keys])))))
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "key": batch["key"],
                    "n_words": [n for n, _ in out],
                    "grams": [g for _, g in out],
                }
            )

    id_type = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), text_key(F.col("text")).alias("key"), "text").mapInPandas(
        rows, f"id {id_type}, key binary, n_words long, grams array<long>"
    )


def _extended(lengths: list[int]):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for key, text, hits in rows_of(batches, "key", "text", "hits"):
            hashes = word_hashes(words_of(text))
            wanted = np.asarray(hits, np.int64).view(np.uint64)
            for n in lengths:
                places, keys = winnowed(hashes, n)
                places = places[np.isin(keys, wanted)]
                if not len(places):
                    continue
                gram = GRAM if n == WINDOW else 1
                starts = np.unique((places[:, None] - np.arange(n - gram + 1)).ravel())
                starts = starts[(starts >= 0) & (starts <= len(hashes) - n)]
                found = runs(hashes, n)[starts]
                yield pd.DataFrame({"key": [key] * len(starts), "start": starts, "length": n, "run": signed(found)})

    return rows


def overlaps(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per document its words, those inside a run of a benchmark item, and the items.

    Returns ``id, key, n_words, n_hit, spans, items``: ``spans`` are word ranges ``(start, end)``, merged;
    ``items`` the ids of the items with a run in it, sorted as text. Null and empty texts have no words and
    no hits; items without words match nothing; repeated rows of either table change nothing but the
    number of rows returned; an empty table gives no rows or no hits.
    """
    items = scratch(item_runs(benchmark), "item-runs")
    # At most WINDOW different lengths.
    lengths = sorted(r[0] for r in items.select("length").distinct().collect())
    marks = scratch(prints(docs, lengths, id_column), "prints")
    grams = scratch(item_grams(benchmark), "item-grams")

    hits = (
        marks.select("key", F.explode("grams").alias("gram"))
        .join(grams, "gram")
        .groupBy("key")
        .agg(F.collect_set("gram").alias("hits"))
    )
    found = (
        docs.select(text_key(F.col("text")).alias("key"), "text")
        .join(hits, "key")
        .select("key", "text", "hits")
        .mapInPandas(_extended(lengths), "key binary, start int, length int, run long")
    )
    matched = scratch(
        found.join(items.select("length", "run").distinct(), ["length", "run"])
        .groupBy("key", "length", "run")
        .agg(F.collect_set("start").alias("starts")),
        "runs-found",
    )
    return (
        marks.select("id", "key", "n_words")
        .join(_spans(matched), "key", "left")
        .join(_items(matched, items), "key", "left")
        .select(
            "id",
            "key",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,end:int>>)")).alias("spans"),
            F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        )
    )


def _spans(matched: DataFrame) -> DataFrame:
    merged = F.expr(
        """aggregate(array_sort(ranges), cast(array() as array<struct<start:int,end:int>>), (done, r) ->
             if(size(done) > 0 and r.start <= element_at(done, -1).end,
                concat(slice(done, 1, size(done) - 1), array(named_struct(
                  'start', element_at(done, -1).start, 'end', greatest(element_at(done, -1).end, r.end)))),
                concat(done, array(named_struct('start', r.start, 'end', r.end)))))"""
    )
    return (
        matched.select("key", "length", F.explode("starts").alias("start"))
        .groupBy("key")
        .agg(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end"))).alias("ranges"))
        .withColumn("spans", merged)
        .select("key", "spans", F.expr("aggregate(spans, 0L, (n, r) -> n + r.end - r.start)").alias("n_hit"))
    )


def _items(matched: DataFrame, items: DataFrame) -> DataFrame:
    """A document is paired with an item once for the result, which lists the items."""
    return (
        matched.select("key", "length", "run")
        .join(items, ["length", "run"])
        .groupBy("key")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def contaminated(found: DataFrame) -> DataFrame:
    """With ``contaminated``: at least one word hit, and at least a twentieth of all words."""
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that aren't contaminated, columns unchanged."""
    bad = contaminated(overlaps(docs, benchmark)).where("contaminated").select(F.col("key").alias("__bad_key")).distinct()
    return docs.join(bad, text_key(docs["text"]) == bad["__bad_key"], "left_anti")
