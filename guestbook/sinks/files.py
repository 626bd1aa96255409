"""File sinks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from guestbook.operators.clean import sentinel_to_null

SUCCESS_MARKER = "mapreduce.fileoutputcommitter.marksuccessfuljobs"

# Fixed value: records per file of the null-stripped feed.
FEED_FILE_RECORDS = 10_000


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), marker: bool = True, whole: bool | None = None
) -> None:
    """Replace a folder; with ``partition_by`` only the partitions the frame holds, unless ``whole``.

    ``marker=False`` leaves no success marker behind.
    """
    if whole is None:
        whole = not partition_by
    writer = (
        df.write.mode("overwrite")
        .option("compression", "snappy")
        .option(SUCCESS_MARKER, str(marker).lower())
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").json(path)


def stripped(df: DataFrame, skip_bare: bool = False) -> DataFrame:
    """Nulls for the word ``null``; with ``skip_bare`` only rows that keep more than one value."""
    clean = sentinel_to_null(df)
    if not skip_bare:
        return clean
    held = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in clean.columns])
    return clean.where(held > 1)


def stripped_json(df: DataFrame, skip_bare: bool = False, name: str = "json") -> DataFrame:
    """Each row as JSON text without its null fields."""
    return stripped(df, skip_bare).select(F.to_json(F.struct("*")).alias(name))


def write_stripped_json(
    df: DataFrame, path: str, per_file: int = FEED_FILE_RECORDS, skip_bare: bool = False
) -> None:
    """JSON lines without null fields, at most ``per_file`` records a file, written by all tasks."""
    (
        stripped(df, skip_bare)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("ignoreNullFields", True)
        .option("maxRecordsPerFile", per_file)
        .json(path)
    )


def day_folder(path: str, day: dt.date | str) -> str:
    """Folder of one day, readable as a partition of ``path``."""
    return f"{path}/snapshot_date={day}"


def land(df: DataFrame, path: str, day: dt.date | str) -> None:
    """Raw landing: replace one day of a table."""
    write_parquet(df, day_folder(path, day))
