"""Row-level quality verdicts: which columns to check, and why a row is rejected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from guestbook.functions.quality import any_phone_status, email_status
from guestbook.functions.text import digits
from guestbook.operators.joins import longest_prefix

REASON = "reject_reason"

# What marks an email column, and the phone columns checked together.
EMAIL_MARKS = ("email", "cyber_txt")
PHONE_TRIPLE = ("phone", "mobilephone", "homephone")
PHONE_PAIR = ("phone", "mobilephone")

# Shortest and longest international number, country code included.
E164_DIGITS = (8, 15)


def email_column(mapped: Sequence[str], exact: bool = False) -> str | None:
    """The first mapped column that names an email; a dotted path gives its second part.

    ``exact`` is the older choice: only a column named exactly so.
    """
    for path in mapped:
        if path in EMAIL_MARKS or (not exact and any(mark in path for mark in EMAIL_MARKS)):
            parts = path.split(".")
            return parts[1] if len(parts) > 1 else path
    return None


def phone_columns(mapped: Sequence[str]) -> tuple[str, ...]:
    if "homephone" in mapped:
        return PHONE_TRIPLE
    if "mobilephone" in mapped:
        return PHONE_PAIR
    for name in ("phone_number", "phone"):
        if name in mapped:
            return (name,)
    return ()


def reject_reason(email: str | None, phones: Sequence[str]) -> Column:
    """``email`` or ``phone``, whichever check fails first; null when the row is good."""
    reason = F.lit(None).cast("string")
    if phones:
        reason = F.when(any_phone_status(*phones) == "invalid", "phone").otherwise(reason)
    if email:
        reason = F.when(email_status(email) == "invalid", "email").otherwise(reason)
    return reason


def split_quality(df: DataFrame, email: str | None, phones: Sequence[str] = ()) -> DataFrame:
    """All rows with their verdict in ``reject_reason``, in one pass."""
    present = {c.lower() for c in df.columns}
    return df.withColumn(REASON, reject_reason(email, [p for p in phones if p.lower() in present]))


def trusted(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNull()).drop(REASON)


def quarantined(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNotNull()).drop(REASON)


def phone_zone(df: DataFrame, phone: str, prefixes: DataFrame, values: Sequence[str] = ("country", "zone")) -> DataFrame:
    """Plausibility of an international number, and what the prefix table says of it.

    A number counts when it starts with ``+``, has 8 to 15 digits, and its leading digits
    are in ``prefixes`` (column ``prefix``). Null numbers get a null verdict.
    """
    typed = F.col(phone)
    e164 = F.when(typed.startswith("+") & F.length(digits(typed)).between(*E164_DIGITS), digits(typed))
    matched = longest_prefix(df.withColumn("_e164", e164), "_e164", prefixes, "prefix", values)
    verdict = F.when(typed.isNull(), F.lit(None).cast("string")).when(
        F.col("_e164").isNotNull() & F.col(values[0]).isNotNull(), "valid"
    )
    return matched.withColumn("phone_check", verdict.when(typed.isNotNull(), "invalid")).drop("_e164")


#: Columns of a number plan: the prefix, and the least and most digits of a number under it, the prefix included.
PLAN = ("prefix", "least", "most")


def phone_plan(df: DataFrame, phone: str, plan: DataFrame, values: Sequence[str] = ("country", "zone")) -> DataFrame:
    """Validity of an international number by a number plan, and what the plan says of it.

    The plan is a tree of prefixes (``PLAN`` beside ``values``), each with the lengths it admits. A number is valid when some prefix of
    it admits its length; the longest such prefix says where it belongs. So a number that is too short for its area may still be
    one of the country around it, and one that fits neither is invalid. Null numbers get a null verdict.
    """
    typed = F.col(phone)
    e164 = F.when(typed.startswith("+") & (digits(typed) != ""), digits(typed))
    matched = longest_prefix(df.withColumn("_e164", e164), "_e164", plan, PLAN[0], values, PLAN[1:])
    verdict = F.when(typed.isNotNull(), F.when(F.col(values[0]).isNotNull(), "valid").otherwise("invalid"))
    return matched.withColumn("phone_check", verdict).drop("_e164")
