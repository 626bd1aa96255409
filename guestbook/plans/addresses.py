"""The address book, and who lives where."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from guestbook.functions.keys import natural_key
from guestbook.functions.text import trim_blank
from guestbook.operators.clean import drop_empty_rows, sentinel_to_null
from guestbook.operators.conform import union_all
from guestbook.operators.dedupe import distinct_keyed
from guestbook.operators.joins import join_on
from guestbook.schemas import ADDRESS_FIELDS, ADDRESSES, PLACE


def address_book(frames: Iterable[DataFrame]) -> DataFrame:
    """Distinct addresses of people, orders and venues.

    The word ``null`` becomes null before rows are compared, so no two rows share a key.
    """
    rows = drop_empty_rows(sentinel_to_null(union_all(frames)))
    return distinct_keyed(rows, natural=list(ADDRESS_FIELDS)).select(*ADDRESSES)


def _somewhere() -> Column:
    return F.coalesce(*[F.col(c).cast("string") for c in PLACE]).isNotNull()


def person_places(residences: DataFrame) -> DataFrame:
    """Bridge of people to the places they live in: a row for each, whatever addresses a place has. Nowhere is no place."""
    rows = residences.where(_somewhere()).select(F.col("id").alias("consumer_id"), natural_key(*PLACE).alias("place_id"))
    return distinct_keyed(rows)


def place_addresses(book: DataFrame) -> DataFrame:
    """Bridge of places to their addresses, those that differ in other columns included."""
    rows = book.where(_somewhere()).select(natural_key(*PLACE).alias("place_id"), F.col("id").alias("address_id"))
    return distinct_keyed(rows)


def place_links(people: DataFrame, homes: DataFrame) -> DataFrame:
    """``place_id, people, addresses, links`` of every place of either bridge: how many pairs it stands for, of which none is made.

    A place of a country alone links all its people with all its addresses. Who needs pairs joins the bridges for the places,
    people or addresses in question; ``consumer_addresses`` makes all of them.
    """
    living = people.groupBy("place_id").agg(F.count("*").alias("people"))
    there = homes.groupBy("place_id").agg(F.count("*").alias("addresses"))
    both = living.withColumn("addresses", F.lit(0).cast("long")).unionByName(there.withColumn("people", F.lit(0).cast("long")))
    summed = both.groupBy("place_id").agg(F.sum("people").alias("people"), F.sum("addresses").alias("addresses"))
    return summed.withColumn("links", F.col("people") * F.col("addresses"))


def pairs_of(people: DataFrame, homes: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """``consumer_id, address_id`` of the places given (all by default) from the two bridges."""
    if places is not None:
        wanted = places.select("place_id").distinct()
        people, homes = people.join(wanted, "place_id", "left_semi"), homes.join(wanted, "place_id", "left_semi")
    met = join_on(people.select("consumer_id", "place_id"), homes.select("place_id", "address_id"), equal=["place_id"])
    return met.select("consumer_id", "address_id")


def consumer_addresses(residences: DataFrame, book: DataFrame) -> DataFrame:
    """Person and address whose six place columns agree, nulls matching nulls.

    Both sides travel as a hash of the place. People with none of the six live nowhere: they would
    meet every address that is known by other columns only. Pairs multiply where a place is wide; ``place_links`` says where.
    """
    return distinct_keyed(pairs_of(person_places(residences), place_addresses(book)))


def match_existing(
    staged: DataFrame,
    existing: DataFrame,
    keys: Sequence[str] = ("address_1", "city", "state_region", "country", "postal_code"),
) -> DataFrame:
    """Staged addresses that the warehouse already holds, with both ids.

    Address lines are compared without surrounding blanks and tabs; a null matches nothing.
    """

    def keyed(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            F.col("id").alias(name),
            *[trim_blank(k).alias(k) if k.startswith("address_") else F.col(k) for k in keys],
        )

    pairs = join_on(keyed(staged, "staged_id"), keyed(existing, "existing_id"), equal=list(keys))
    return pairs.select("staged_id", "existing_id")
