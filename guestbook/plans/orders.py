"""Orders and their items."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from guestbook.functions.keys import natural_key
from guestbook.functions.text import year_text
from guestbook.operators.clean import drop_empty_rows
from guestbook.operators.dedupe import distinct_rows, keep_one
from guestbook.operators.joins import join_on, lookup
from guestbook.plans.people import resolve
from guestbook.schemas import ITEM_FIELDS, ORDER_ITEMS, ORDER_PLACE, ORDER_TOTALS, ORDERS
from guestbook.session import stage_spare

ORDER_KEY = ("source_order_id", "source_system", "source_instance")
ORDER_FACTS = ("order_date", "campaign", "site", *ORDER_TOTALS)


def order_id() -> Column:
    return natural_key(*ORDER_KEY)


def order_place(kind: str | None = None) -> Column:
    """Key of an order's place; null where any of its columns is, as such a place isn't looked up."""
    names = [f"{kind}_{c}" if kind else c for c in ORDER_PLACE]
    return F.when(reduce(lambda x, y: x & y, [F.col(n).isNotNull() for n in names]), natural_key(*names))


def order_places(book: DataFrame) -> DataFrame:
    """``place, id`` of the addresses that orders look up: the least id of each complete place."""
    placed = book.select(order_place().alias("place"), "id").where(F.col("place").isNotNull())
    return placed.groupBy("place").agg(F.min("id").alias("id"))


def orders(lines: DataFrame, sources: DataFrame, book: DataFrame, people: DataFrame | None = None) -> DataFrame:
    """One row per order of a known person: one of ``people``, or anybody if they aren't given.

    Lines are cut to orders before the two address lookups, which then move one row an order. ``book`` is the address
    book, or its ``order_places``. Ids travel as bytes and places as keys, and the order's own id is made last.
    """
    places = book if "place" in book.columns else order_places(book)
    placed = resolve(lines.where(F.col("source_order_id").isNotNull()), people).select(
        F.unhex("consumer_id").alias("consumer_id"),  # bytes are ordered like the digits
        *ORDER_KEY,
        *ORDER_FACTS,
        *[f"{kind}_{c}" for kind in ("shipping", "billing") for c in ORDER_PLACE],
    )
    origin = sources.select(F.col("id").alias("source_system_id"), "platform", "name")
    placed = join_on(
        placed,
        origin,
        equal=[("source_system", "platform")],
        null_safe=[("source_instance", "name")],
        how="left",
    )
    placed = drop_empty_rows(placed, ["source_system_id", *ORDER_FACTS])
    out = keep_one(placed, ORDER_KEY)
    kinds = ("shipping", "billing")
    out = out.select(
        "consumer_id", "source_system_id", *ORDER_KEY, *ORDER_FACTS, *[order_place(k).alias(f"{k}_place") for k in kinds]
    )
    for kind in kinds:
        out = lookup(out, places, [(f"{kind}_place", "place")], "id", f"address_{kind}_id").drop(f"{kind}_place")
    return out.withColumns({"id": order_id(), "consumer_id": F.lower(F.hex("consumer_id"))}).select(*ORDERS)


def surely_placed() -> Column:
    """Whether a line alone makes its order one of ``orders`` where everybody counts as known; others may need another line for it."""
    facts = [F.nanvl(c, F.lit(None)) if c in ORDER_TOTALS else F.col(c) for c in ORDER_FACTS]
    told = F.coalesce(*[f.cast("string") for f in facts]).isNotNull()
    return F.col("source_order_id").isNotNull() & F.col("email").isNotNull() & told


def order_items(lines: DataFrame, placed: DataFrame, sure: Column | None = None) -> DataFrame:
    """Distinct items of the surviving orders.

    ``sure`` tells lines whose orders are known to be in ``placed``: they need no join, and of them and what the others leave
    only repeated rows are shuffled. Without it every line is looked up.
    """
    named = lines.where(F.col("source_order_id").isNotNull() | F.col("source_product_id").isNotNull())
    ids = placed.select(F.col("id").alias("order_id"))
    if sure is None:
        items = _keyed(_items(named).distinct()).join(ids, "order_id", "left_semi")
    else:
        others = _items(named.where(~sure)).withColumn("order_id", order_id()).join(ids, "order_id", "left_semi").drop("order_id")
        items = _keyed(distinct_rows(_items(named.where(sure)).unionByName(stage_spare(others, "other-items"))))
    columns = [c for c in ORDER_ITEMS if c != "id"]
    return items.select(*columns, natural_key(*columns).alias("id"))


def _items(lines: DataFrame) -> DataFrame:
    """Items with the columns of their order's and event's key, which are narrower than the keys. 0.0 stands for -0.0."""
    fields = [(F.col(c) + F.lit(0.0)).alias(c) if kind == "double" else F.col(c) for c, kind in ITEM_FIELDS.items()]
    event = F.col("event_name").isNotNull()
    venue, year = F.when(event, F.col("venue_name")), F.when(event, year_text("event_datetime"))
    items = lines.select(*ORDER_KEY, *fields, "event_name", venue.alias("venue_name"), year.alias("year"))
    return drop_empty_rows(items, [c for c in ITEM_FIELDS if c != "source_product_id"])


def _keyed(items: DataFrame) -> DataFrame:
    event = F.when(F.col("event_name").isNotNull(), natural_key("event_name", "venue_name", "year"))
    return items.select(order_id().alias("order_id"), *ITEM_FIELDS, event.alias("event_id"))
