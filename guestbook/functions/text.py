"""Text expressions. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from guestbook.functions._columns import ColumnOrName, as_col

# Fixed value: the characters that separate words, Unicode blanks and C0 separators included.
WHITESPACE = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}\x{0b}]+"


def squeeze(c: ColumnOrName) -> Column:
    """Trim, and collapse every run of white space to one blank."""
    return F.trim(F.regexp_replace(as_col(c), WHITESPACE, " "))


def trim_blank(c: ColumnOrName) -> Column:
    """Strip blanks and tabs from both ends."""
    return F.btrim(as_col(c), F.lit(" \t"))


def street_line(c: ColumnOrName, line: int) -> Column:
    """Comma-separated part ``line`` of a street, counted from 0; null when there is none."""
    return F.get(F.split(as_col(c), ","), F.lit(line))


def phone_text(c: ColumnOrName) -> Column:
    """Keep letters, digits and dollar signs."""
    return F.regexp_replace(as_col(c), "[^0-9a-zA-Z$]+", "")


def digits(c: ColumnOrName) -> Column:
    return F.regexp_replace(as_col(c), "[^0-9]", "")


def year_text(c: ColumnOrName) -> Column:
    """First four characters: the year of a date, a timestamp or ISO text."""
    return F.substring(as_col(c).cast("string"), 1, 4)
