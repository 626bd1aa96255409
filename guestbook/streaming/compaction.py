"""Compaction of landed messages: one row a message and day, kept up to date day by day.

The landing only ever grows. A compaction takes the batches that came in since the last one and merges them with what it holds of
the days they touch; those days are written anew and swapped all at once (:mod:`guestbook.sinks.manifest`), all other days keep their
files. Readers get the last copy of each message from few files, without ranking anything.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from guestbook.sinks.manifest import Published
from guestbook.sources.files import _list
from guestbook.streaming.incremental import BATCH
from guestbook.streaming.webhook import FAULT, NO_FAULT

KEYS = ("event_name", "message_id", "event_date")
COMPACTED = "event_name string, message_id string, event_date date, received_at timestamp, body string, copies bigint"
_DAY = "day"
#: The newest batch that is compacted.
_THROUGH = "batch"


def landed_batches(spark: SparkSession, landing: str) -> list[int]:
    prefix = f"{BATCH}="
    return sorted(int(n.removeprefix(prefix)) for n, is_folder in _list(spark, landing) if is_folder and n.startswith(prefix))


def merge_copies(rows: DataFrame) -> DataFrame:
    """One row a message and day: the copy received last (of these the one of least body), and how many copies there were.

    A partial aggregate, so a message that is sent over and over is merged where its copies lie.
    """
    age = (-F.unix_micros("received_at")).alias("age")
    last = F.min(F.struct(age, F.struct("received_at", "body").alias("copy"))).getField("copy")
    merged = rows.groupBy(*KEYS).agg(last.alias("last"), F.sum("copies").alias("copies"))
    return merged.select(*KEYS, "last.received_at", "last.body", "copies")


def compact(spark: SparkSession, landing: str, store: str) -> list[dt.date]:
    """Merge what has landed since the last compaction; the days rewritten.

    Batches count once: which ones are in is published together with the days, so a run that fails before that is as if it
    hadn't been. One compaction at a time; of two that overlap the later fails to publish.
    """
    published = Published(spark, store)
    state = published.state()
    through = int(state.marks.get(_THROUGH, -1))
    fresh = [n for n in landed_batches(spark, landing) if n > through]
    if not fresh:
        return []
    rows = spark.read.option("basePath", landing).parquet(*(f"{landing}/{BATCH}={n}" for n in fresh))
    good = rows.where(F.col(FAULT) == NO_FAULT).select(*KEYS, "received_at", "body", F.lit(1).cast("long").alias("copies"))
    days = sorted(r[0] for r in good.select("event_date").distinct().collect())  # a row a day
    held = published.read(map(str, days), COMPACTED, state)
    merged = merge_copies(good if held is None else held.unionByName(good))
    # Files of a size that suits reading, however many tasks merged a day.
    sized = merged.withColumn(_DAY, F.col("event_date").cast("string")).hint("rebalance", _DAY)
    folder = published.write(sized, "days", [_DAY]) if days else None
    published.publish(state, {str(d): f"{folder}/{_DAY}={d}" for d in days}, {_THROUGH: str(fresh[-1])})
    return days


def compacted(spark: SparkSession, store: str, days: Iterable[dt.date] | None = None) -> DataFrame:
    """The last copy of every message compacted so far; of some days, only their files are opened."""
    rows = Published(spark, store).read(None if days is None else map(str, days), COMPACTED)
    return spark.createDataFrame([], COMPACTED) if rows is None else rows
