"""Line deduplication by the spread of a line over distinct sites.

A HyperLogLog sketch of the sites of every line hash is merged by aggregation. Where the estimate is well
beyond the threshold the line is boilerplate, where it is well below it isn't, and near the threshold the
distinct sites are counted exactly. A line that stands on ``SITES`` sites or more is removed wherever it stands,
but for its first document (that of least id): what only copies share isn't lost from the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestbook.llm.common import SPACE, scratch, text_key, unused

SITES = 5
#: log2 of a sketch's registers; its standard error is 1.04 / sqrt(2 ** 12), or 1.6 %.
REGISTERS = 12
#: Estimates within this share of the threshold, over thirty standard errors, are settled by an exact count.
NEAR = 0.5


def _trimmed(line: Column) -> Column:
    return F.regexp_replace(line, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def lines(docs: DataFrame, site: str = "source", id_column: str = "doc_id") -> DataFrame:
    """``id, key, site, at, line``: every line that isn't blank, as a hash of the line without outer white space."""
    return (
        docs.select(
            F.col(id_column).alias("id"),
            text_key(F.col("text")).alias("key"),
            F.col(site).cast("string").alias("site"),
            F.posexplode(F.transform(_lines(F.col("text")), _trimmed)).alias("at", "line"),
        )
        .where("line <> ''")
        .withColumn("line", F.unhex(F.md5("line")))
    )


def boilerplate(rows: DataFrame, sites: int = SITES) -> DataFrame:
    """``line, first``: lines on at least ``sites`` sites, and the least id of a document with them.

    ``rows`` come from :func:`lines`. Rows without a site or without an id don't count for either.
    """
    sketched = scratch(
        rows.groupBy("line")
        .agg(F.count("site").alias("n"), F.min("id").alias("first"), F.hll_sketch_agg("site", F.lit(REGISTERS)).alias("sketch"))
        .where(F.col("n") >= sites)
        .select("line", "first", F.hll_sketch_estimate("sketch").alias("estimate")),
        "line-sketches",
    ).where(F.col("estimate") >= sites * (1 - NEAR))
    sure = F.col("estimate") > sites * (1 + NEAR)
    near = (
        rows.join(sketched.where(~sure).select("line"), "line")
        .where("site is not null")
        .select("line", "site")
        .distinct()
        .groupBy("line")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= sites)
        .select("line")
    )
    return sketched.where(sure).select("line", "first").unionByName(
        sketched.where(~sure).select("line", "first").join(near, "line", "left_semi")
    )


def removals(docs: DataFrame, sites: int = SITES, site: str = "source", id_column: str = "doc_id") -> DataFrame:
    """``id, key, places``: the lines (counted from 0) that go, for documents that lose any."""
    rows = lines(docs, site, id_column)
    spread = scratch(boilerplate(rows, sites), "boilerplate")
    return (
        rows.select("id", "key", "at", "line")
        .join(spread, "line")
        .where(~F.col("id").eqNullSafe(F.col("first")))
        .groupBy("id", "key")
        .agg(F.collect_set("at").alias("places"))
    )


def without_boilerplate(docs: DataFrame, sites: int = SITES, keep_empty: bool = True) -> DataFrame:
    """``docs`` without lines that stand on at least ``sites`` sources; columns and other lines unchanged.

    Adds two last columns, the lines and those of them removed, named ``__lines`` and ``__removed`` or, where ``docs`` has
    such names, the like with more underscores. Null and empty texts stay as they are; a null
    source is no site; a document without an id is never the first of a line; equal rows lose the
    same lines; an empty table gives no rows. With ``keep_empty=False`` documents that lose all their lines go.
    """
    n_lines, removed, id_, key, places, rest = unused(docs, "__lines", "__removed", "__id", "__key", "__places", "__kept")
    lost = removals(docs, sites).select(
        F.col("id").alias(id_), F.col("key").alias(key), F.col("places").alias(places)
    )
    joined = docs.join(
        lost, (text_key(docs["text"]) == lost[key]) & docs["doc_id"].eqNullSafe(lost[id_]), "left"
    )
    kept = F.filter(_lines(F.col("text")), lambda _, i: ~F.array_contains(F.col(places), i))
    out = joined.withColumns(
        {
            n_lines: F.coalesce(F.size(F.filter(_lines(F.col("text")), lambda x: _trimmed(x) != "")), F.lit(0)),
            removed: F.coalesce(F.size(places), F.lit(0)),
            rest: F.when(F.col(places).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")),
        }
    )
    if not keep_empty:
        out = out.where((F.col(removed) == 0) | (F.col(removed) < F.col(n_lines)))
    return out.select(
        *(F.col(rest).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns), n_lines, removed
    )
