"""Surrogate keys computed from natural keys.

A key is a pure function of the row, so a fact computes its foreign key where it stands: no
join attaches it, a rerun gives the same ids, and a recomputed task cannot disagree with the
parent table.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from guestbook.functions._columns import ColumnOrName, as_col


def natural_key(*cols: ColumnOrName) -> Column:
    """md5 over length-prefixed values; null and empty text stay apart."""
    parts = []
    for c in cols:
        text = as_col(c).cast("string")
        prefixed = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(prefixed, F.lit("N")))
    return F.md5(F.concat_ws("|", *parts))
