"""Dated snapshots: the latest, the missing, and what stands in for them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from guestbook.operators.joins import join_on

DAY = "snapshot_date"


def of_day(df: DataFrame, day: dt.date | str, column: str = DAY) -> DataFrame:
    """One day's rows; on a partition column only that day's files are read."""
    return df.where(F.col(column) == F.lit(str(day)).cast("date"))


def latest_snapshot(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows of each key's greatest ``ts``, ties included.

    The maxima are pre-aggregated on the map side and joined back, so no window gathers a
    key's whole history in one task.
    """
    newest = df.groupBy(*keys).agg(F.max(ts).alias(ts))
    return join_on(df, newest, equal=[ts], null_safe=list(keys))


def missing_snapshots(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    return join_on(expected, present.select(*keys).distinct(), equal=list(keys), how="left_anti")


def missing_action(missing: DataFrame, runs: DataFrame, keys: Sequence[str], failed: Column) -> DataFrame:
    """``report`` for a missing table whose run failed, else ``placeholder``."""
    failures = runs.where(failed).select(*keys).distinct().withColumn("_failed", F.lit(True))
    decided = join_on(missing, failures, equal=list(keys), how="left")
    action = F.when(F.col("_failed"), "report").otherwise("placeholder")
    return decided.withColumn("action", action).drop("_failed")


def carry_forward(df: DataFrame, keys: Sequence[str], day: dt.date, column: str = DAY) -> DataFrame:
    """Yesterday's rows, dated today, of every table that has none today."""
    before = day - dt.timedelta(days=1)
    arrived = of_day(df, day, column).select(*keys).distinct()
    stale = join_on(of_day(df, before, column), arrived, equal=list(keys), how="left_anti")
    return stale.withColumn(column, F.lit(str(day)).cast("date")).select(*df.columns)


def placeholder_row(df: DataFrame) -> DataFrame:
    """One all-null row of the frame's schema."""
    one = df.sparkSession.range(1)
    return one.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])


def empty_like(df: DataFrame) -> DataFrame:
    return df.limit(0)
