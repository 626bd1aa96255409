"""Incremental file intake: every run takes only the files no run has taken before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BATCH = "batch_id"

#: Beyond Spark's own limit of a week a file dated before the newest would never be taken.
ANY_AGE = "36500d"


def new_files(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_per_batch: int = 10_000,
    max_age: str = ANY_AGE, **options
) -> DataFrame:
    """A stream over the files of a folder, in batches of bounded size.

    Files may carry any date. Names of files taken are remembered up to ``max_age`` before the newest;
    a shorter age bounds that memory and loses files that come in with an older date.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    reader = reader.option("maxFileAge", max_age)
    return reader.options(**options).load(path)


def run_once(
    stream: DataFrame, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Process what is new, then stop. The checkpoint remembers the files taken.

    A batch replaces its own partition, so one that is repeated after a failure leaves no
    duplicates. The progress is committed after the write, never before.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = transform(batch) if transform else batch
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{out}/{BATCH}={number}")

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    )
    query.awaitTermination()
