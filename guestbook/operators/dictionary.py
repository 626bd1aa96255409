"""Dictionaries of keys: numbers that stay what they are while keys come in.

A key gets its number once, in the load that first shows it; later loads number only what is new, beyond the greatest number so far. Tables that
were loaded before therefore go on pointing at the right rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from guestbook.operators.conform import Schema, struct_of
from guestbook.operators.joins import join_on
from guestbook.session import stage
from guestbook.sinks.manifest import Published

_PART_ROWS = 1 << 33  # rows a partition's own numbers leave room for


def numbered(rows: DataFrame, order: Sequence[str], column: str = "id", start: int = 1) -> DataFrame:
    """``rows`` numbered from ``start`` in the order of some columns, nulls last.

    Rows are dealt by ranges and numbered where they lie; only the sizes of the ranges, one row each, are added up in one place.
    """
    ways = [F.col(c).asc_nulls_last() for c in order]
    placed = rows.repartitionByRange(*ways).sortWithinPartitions(*ways).withColumn("_at", F.monotonically_increasing_id())
    placed = stage(placed, "numbered").withColumn("_part", F.floor(F.col("_at") / _PART_ROWS))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")  # a row a range
    number = F.col("_at") % _PART_ROWS + F.col("_before") + start
    return (
        placed.join(sizes.select("_part", before.alias("_before")), "_part")
        .withColumn(column, number)
        .select(column, *rows.columns)
    )


def unseen(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``rows`` that ``known`` lacks; a null is a key like any other."""
    return join_on(rows.select(*keys).distinct(), known.select(*keys), null_safe=list(keys), how="left_anti")


def extended(known: DataFrame, rows: DataFrame, keys: Sequence[str], column: str = "id") -> DataFrame:
    """What ``rows`` add to a dictionary: its new keys with the next numbers, in the order of the keys."""
    last = known.agg(F.coalesce(F.max(column), F.lit(0))).first()[0]
    return numbered(unseen(rows, known, keys), keys, column, last + 1)


class Dictionary:
    """A dictionary kept in a folder. Loads only ever append to it, each as a whole or not at all."""

    def __init__(self, spark: SparkSession, root: str, schema: Schema, keys: Sequence[str] | None = None, column: str = "id"):
        self.spark, self.column = spark, column
        self.schema = struct_of(schema)
        self.keys = list(keys or (n for n in self.schema.names if n != column))
        self.published = Published(spark, root)

    def read(self) -> DataFrame:
        rows = self.published.read(None, self.schema)
        return self.spark.createDataFrame([], self.schema) if rows is None else rows

    def extend(self, rows: DataFrame) -> DataFrame:
        """Number the keys of ``rows`` that aren't known yet; the whole dictionary. Of two loads at a time one fails to publish."""
        state = self.published.state()
        new = extended(self.read(), rows, self.keys, self.column)
        typed = new.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields))
        folder = self.published.write(typed, f"load-{state.version}")
        if not self.spark.read.schema(self.schema).parquet(self.published.path(folder)).isEmpty():
            self.published.publish(state, {f"load {state.version}": folder})
        return self.read()
