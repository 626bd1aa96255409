"""File intake by a ledger: every run takes the files that no committed run has taken.

Files taken are rows of a table (path, size, time of change). A run lists the source, anti-joins the ledger, and writes what it read and the names it
read it from aside; one publication (:mod:`guestbook.sinks.manifest`) commits both. So a failed run's files are taken again, none is taken
twice, a file that is replaced counts as new, and nothing has to be remembered between runs but the table. Its parts are merged as they grow in number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from guestbook.sinks.manifest import Published, State

FILES = "path string, size bigint, modified timestamp"
#: Parts the ledger may have before they are merged.
MOST_PARTS = 32
_ROWS, _LEDGER, _LAST = "rows", "ledger", "batch"


def listing(spark: SparkSession, source: str) -> DataFrame:
    """``path, size, modified`` of every file under a folder or pattern. No file is opened; folders are listed by tasks where they are many."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


class Intake:
    """Files of ``source`` read into ``store``, in batches of at most ``files_per_batch``."""

    def __init__(
        self, spark: SparkSession, source: str, store: str, schema: StructType, fmt: str = "parquet",
        files_per_batch: int = 10_000, **options
    ):
        self.spark, self.source, self.schema, self.fmt, self.options = spark, source, schema, fmt, options
        self.files_per_batch = files_per_batch
        self.published = Published(spark, store)

    def _named(self, state: State, kind: str) -> list[str]:
        return [n for n in state.folders if n.startswith(f"{kind} ")]

    def taken(self, state: State | None = None) -> DataFrame:
        state = state or self.published.state()
        rows = self.published.read(self._named(state, _LEDGER), FILES, state)
        return self.spark.createDataFrame([], FILES) if rows is None else rows

    def pending(self, state: State | None = None) -> DataFrame:
        names = ["path", "size", "modified"]
        return listing(self.spark, self.source).join(self.taken(state).select(*names), names, "left_anti")

    def run(self, transform: Callable[[DataFrame], DataFrame] | None = None) -> int:
        """Take all that is new, oldest files first; the number of files taken."""
        taken = 0
        while True:
            state = self.published.state()
            # The names of one batch, which bounds them.
            some = self.pending(state).orderBy("modified", "path").limit(self.files_per_batch).collect()
            if some:
                self._take(state, some, transform)
                taken += len(some)
            if len(some) < self.files_per_batch:
                return taken

    def _take(self, state: State, some: list, transform: Callable[[DataFrame], DataFrame] | None) -> None:
        number = int(state.marks.get(_LAST, -1)) + 1
        rows = self.spark.read.format(self.fmt).schema(self.schema).options(**self.options).load([r["path"] for r in some])
        names = self.spark.createDataFrame([tuple(r) for r in some], FILES)
        parts = self._named(state, _LEDGER)
        gone = {}
        if len(parts) >= MOST_PARTS:
            names, gone = names.unionByName(self.taken(state)), dict.fromkeys(parts)
        written = {
            f"{_ROWS} {number}": self.published.write(transform(rows) if transform else rows, f"{_ROWS}-{number}"),
            f"{_LEDGER} {number}": self.published.write(names.coalesce(8), f"{_LEDGER}-{number}"),
        }
        self.published.publish(state, {**gone, **written}, {_LAST: str(number)})

    def rows(self) -> DataFrame | None:
        """What committed runs have read; none before the first."""
        state = self.published.state()
        return self.published.read(self._named(state, _ROWS), None, state)
