"""Events and who took part in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from guestbook.functions.keys import natural_key
from guestbook.functions.text import year_text
from guestbook.operators.dedupe import distinct_keyed, keep_one
from guestbook.operators.joins import lookup
from guestbook.plans.people import resolve
from guestbook.schemas import CONSUMER_EVENTS, EVENTS

ADDRESS_KEYS = ("address_1", "city", "state_region", "postal_code", "country")


def event_id(start: str = "start_time") -> Column:
    """Key of (name, venue, year); null when the event has no name."""
    return F.when(
        F.col("event_name").isNotNull(), natural_key("event_name", "venue_name", year_text(start))
    )


def event_visits(visits: DataFrame) -> DataFrame:
    return visits.where(F.col("event_name").isNotNull()).withColumn("id", event_id())


def events(keyed: DataFrame, book: DataFrame) -> DataFrame:
    """One row per event; its address is looked up once, after the rows are down to events."""
    facts = [c for c in EVENTS if c != "address_id"]
    one = keep_one(keyed.select(*facts, *ADDRESS_KEYS), ["id"])
    return lookup(one, book, ADDRESS_KEYS, "id", "address_id").select(*EVENTS)


def consumer_events(keyed: DataFrame, people: DataFrame | None = None) -> DataFrame:
    """Who took part; only those of ``people``, if given."""
    parts = resolve(keyed.withColumnRenamed("id", "event_id"), people)
    return distinct_keyed(parts.select(*[c for c in CONSUMER_EVENTS if c != "id"]))
