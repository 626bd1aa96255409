"""The person feed: three systems, one row per (email, first, last), null-stripped JSON."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from guestbook.functions.text import phone_text
from guestbook.operators.clean import require
from guestbook.operators.conform import union_distinct
from guestbook.operators.dedupe import keep_one

# The feed's columns.
FEED = {
    "email": "string",
    "phoneNumber": "string",
    "firstName": "string",
    "lastName": "string",
    "juniorParent": "boolean",
    "genderEst": "string",
    "address1": "string",
    "address2": "string",
    "city": "string",
    "stateRegion": "string",
    "country": "string",
    "postalCode": "string",
    "homeCourse": "string",
    "handicap": "string",
}


def person_feed(sources: Iterable[DataFrame], keys=("email", "firstName", "lastName")) -> DataFrame:
    """``sources`` are conformed to ``FEED``. The older feed keyed two of them on email alone."""
    chosen = [keep_one(require(df, "email"), list(keys)) for df in sources]
    merged = union_distinct(df.withColumn("email", F.btrim("email", F.lit("\t"))) for df in chosen)
    return merged.withColumn("phoneNumber", phone_text("phoneNumber"))
