"""The dimension of source systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from guestbook.operators.conform import conform
from guestbook.operators.dictionary import Dictionary
from guestbook.schemas import SOURCE_SYSTEM


def source_rows(view: DataFrame, instance: str | None = None, platform: str = "source_system") -> DataFrame:
    """Distinct (name, url, platform) of a source.

    Distinct by source, so that Spark drops the left joins of the view and reads the named
    columns of its first table alone.
    """
    mapping = {"platform": platform} | ({"name": instance} if instance else {})
    return conform(view, mapping, {"name": "string", "url": "string", "platform": "string"}).distinct()


def source_book(spark: SparkSession, root: str) -> Dictionary:
    """The sources of all loads so far, in a folder. ``extend`` numbers those of a load that are new; the others keep their number."""
    return Dictionary(spark, root, SOURCE_SYSTEM, ["platform", "name", "url"])


def source_systems(rows: DataFrame) -> DataFrame:
    """Distinct sources of one load, numbered; ``source_book`` keeps numbers from load to load.

    The window sees one row per source, a dozen or so.
    """
    numbered = F.row_number().over(
        Window.orderBy(F.col("platform").asc_nulls_last(), F.col("name").asc_nulls_last())
    )
    return rows.distinct().select(numbered.alias("id"), "name", "url", "platform").select(*SOURCE_SYSTEM)
