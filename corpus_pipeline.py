"""A corpus pipeline of five stages over the documents.

Each stage reads what its predecessor wrote: quality rules, line deduplication, near duplicates, benchmark
decontamination, and the mix of the sources. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guestbook.llm import decontamination, jaccard, linespread, mixing, outliers
from guestbook.llm.common import open_table, prepared, scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules accept."""
    prepared(spark)
    return outliers.accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sites share; those that consist of such lines alone go."""
    prepared(spark)
    found = linespread.without_boilerplate(docs, keep_empty=False)
    if "n_chars" in docs.columns:
        chars = F.when(F.col(found.columns[-1]) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", chars)
    return found.select(*(F.col(f"`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    prepared(spark)
    return jaccard.representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark doesn't contaminate."""
    return decontamination.clean(docs, open_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each copy of a document that it takes, dealt over shards."""
    prepared(spark)
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing", mix_sources),
]

#: The estimates of the first stage and the draws of the last one aren't SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = open_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
