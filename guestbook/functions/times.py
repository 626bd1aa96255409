from __future__ import annotations

from pyspark.sql import Column, functions as F

from guestbook.functions._columns import ColumnOrName, as_col


def epoch_micros(c: ColumnOrName) -> Column:
    return F.unix_micros(as_col(c).cast("timestamp"))


def from_epoch_micros(c: ColumnOrName) -> Column:
    return F.timestamp_micros(as_col(c))


def date_path(c: ColumnOrName) -> Column:
    """``yyyy/MM/dd``, the folder name of a dated snapshot."""
    return F.date_format(as_col(c), "yyyy/MM/dd")
