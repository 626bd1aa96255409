"""Who our people are: one id per distinct (first name, last name, email)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from guestbook.functions.keys import natural_key
from guestbook.operators.dedupe import keep_one
from guestbook.schemas import CONSUMERS

IDENTITY = ("name_first", "name_last", "email")


def person_id() -> Column:
    return natural_key(*IDENTITY)


def identify(rows: DataFrame, alias: str = "id") -> DataFrame:
    """Attach the person id to every row that has an email; no join is needed."""
    return rows.where(F.col("email").isNotNull()).withColumn(alias, person_id())


def consumers(identified: DataFrame) -> DataFrame:
    return keep_one(identified.select(*CONSUMERS), ["id"])


def residences(identified: DataFrame) -> DataFrame:
    """Where each person lives: one row per address, its state the least of those given."""
    place = ["address_1", "address_2", "city", "country", "postal_code"]
    return identified.groupBy("id", *place).agg(F.min("state_region").alias("state_region"))


def resolve(facts: DataFrame, people: DataFrame | None, alias: str = "consumer_id") -> DataFrame:
    """Facts whose person is in ``people``, with the person's id; the join ships the id alone.

    Without ``people`` every person named counts as known: that of facts that fed them.
    """
    if people is None:
        return identify(facts, alias)
    known = people.select(F.col("id").alias(alias))
    return identify(facts, alias).join(known, alias, "left_semi")
