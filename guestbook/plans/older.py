"""Older shapes: the ten tables of the first datamart, and the staging drafts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from guestbook.functions.keys import natural_key
from guestbook.operators.clean import drop_null_records
from guestbook.operators.conform import conform
from guestbook.operators.dedupe import distinct_keyed, keep_one

# Columns of the older tables that no source fills.
UNFILLED_CONSUMER = {
    "do_not_sell": "boolean",
    "total_ticket_spend": "double",
    "total_merch_spend": "double",
    "total_pga_spend": "double",
    "secondary_purchaser": "boolean",
    "trade_in_purchaser": "boolean",
    "travel_purchaser": "boolean",
    "merch_purchase_likely": "double",
    "ticket_purchase_likely": "double",
    "internal": "boolean",
    "vip_status": "boolean",
    "pga_professional_id": "string",
    "golf_handicap": "bigint",
    "dma_region": "string",
    "course_home": "string",
    "has_coach": "boolean",
    "volunteer_history": "string",
    "sign_up_at": "date",
    "sign_up_source": "string",
}
ORDER_COLUMNS = {
    "source_order_id": "string",
    "campaign": "string",
    "site": "string",
    "total_discount": "double",
    "total_gross_sub": "double",
    "total_taxable_sub": "double",
    "total_nontaxable_sub": "double",
    "total_tax": "double",
    "total_ship": "double",
}
ITEM_COLUMNS = {
    "source_product_id": "string",
    "quantity": "double",
    "unit_price": "double",
    "item_discount": "double",
    "category": "string",
    "subcategory": "string",
    "sub_class": "string",
    "variation_size": "string",
}
KEY_COLUMNS = (
    "id", "profile_id", "email_id", "consumer_id", "interest_id", "address_id",
    "source_id", "order_id", "address_shipping_id", "address_billing_id",
)


def older_tables(feed: DataFrame) -> dict[str, DataFrame]:
    """Ten tables, one row each per feed row; rows with nothing but keys are dropped.

    Keys differ by table though they come from the same row. Person and address are tied by
    the row itself, where the first datamart joined on a key it had never filled.
    """
    row = [F.col(c) for c in feed.columns]

    def key(table: str):
        return natural_key(F.lit(table), *row)

    keyed = feed.select(
        *row,
        key("consumer").alias("id"),
        key("profile").alias("profile_id"),
        key("email").alias("email_id"),
        key("address").alias("address_id"),
        key("interest").alias("interest_id"),
        key("order").alias("order_id"),
        key("source").alias("source_id"),
    )
    consumer = {"id": "string", "profile_id": "string", "email_id": "string", **UNFILLED_CONSUMER}
    tables = {
        "emails": keyed.select(F.col("email_id").alias("id"), "email"),
        "profiles": keyed.select(
            F.col("profile_id").alias("id"),
            F.col("firstName").alias("name_first"),
            F.col("lastName").alias("name_last"),
            F.col("genderEst").alias("gender"),
            F.lit(None).cast("string").alias("league"),
            F.lit(None).cast("string").alias("team"),
        ),
        "consumers": conform(
            keyed,
            {
                "id": "id",
                "profile_id": "profile_id",
                "email_id": "email_id",
                "golf_handicap": "handicap",
                "course_home": "homeCourse",
            },
            consumer,
        ),
        "consumer_interests": conform(
            keyed,
            {"id": natural_key(F.lit("link"), "interest_id"), "consumer_id": "id", "interest_id": "interest_id"},
            {"id": "string", "consumer_id": "string", "interest_id": "string", "email_opt_in": "boolean"},
        ),
        "interests": conform(
            keyed, {"id": "interest_id"}, {"id": "string", "name": "string", "type": "string", "parent": "int"}
        ),
        "addresses": conform(
            keyed,
            {
                "id": "address_id",
                "address_1": "address1",
                "address_2": "address2",
                "city": "city",
                "state_region": "stateRegion",
                "country": "country",
                "postal_code": "postalCode",
            },
            {
                "id": "string",
                "address_1": "string",
                "address_2": "string",
                "address_3": "string",
                "address_4": "string",
                "city": "string",
                "state_region": "string",
                "int_region": "string",
                "country": "string",
                "postal_code": "string",
            },
        ),
        "consumer_addresses": keyed.select(
            natural_key(F.lit("home"), "address_id").alias("id"),
            F.col("id").alias("consumer_id"),
            F.col("address1").alias("address_1"),
        ),
        "orders": conform(
            keyed,
            {
                "id": "order_id",
                "consumer_id": "id",
                "source_id": "source_id",
                "address_shipping_id": "address_id",
                "address_billing_id": "address_id",
            },
            {
                "id": "string",
                "consumer_id": "string",
                "source_id": "string",
                "address_shipping_id": "string",
                "address_billing_id": "string",
                **ORDER_COLUMNS,
            },
        ),
        "sources": conform(
            keyed, {"id": "source_id"}, {"id": "string", "name": "string", "url": "string", "platform": "string"}
        ),
        "order_items": conform(
            keyed,
            {"id": natural_key(F.lit("item"), "order_id"), "order_id": "order_id"},
            {"id": "string", "order_id": "string", **ITEM_COLUMNS},
        ),
    }
    return {name: drop_null_records(df, KEY_COLUMNS) for name, df in tables.items()}


# Columns of the staging drafts.
STAGED_NAME = {"name_first": "string", "name_last": "string", "email": "string"}
STAGED_ADDRESS = {
    **STAGED_NAME,
    "address_1": "string",
    "address_2": "string",
    "address_3": "string",
    "address_4": "string",
    "city": "string",
    "state_region": "string",
    "int_region": "string",
    "country": "string",
    "postal_code": "string",
}
STAGED_INTEREST = {**STAGED_NAME, "name": "string", "type": "string", "parent": "int", "email_opt_in": "boolean"}
STAGED_EVENT = {
    **STAGED_NAME,
    "source_event_id": "string",
    "event_name": "string",
    "event_description": "string",
    "venue_name": "string",
    "start_time": "string",
    "end_time": "string",
    "rsvp_open": "string",
    "wait_list": "string",
    "rsvp_closed_at": "string",
    "date_rsvped": "string",
    "attending": "string",
    "checked_in": "string",
    "vip": "string",
    "waitlist": "string",
    "ticket_scanned": "string",
    "ticket_scanned_datetime": "string",
    **{c: "string" for c in STAGED_ADDRESS if c not in STAGED_NAME},
}


def address_staging(rows: DataFrame) -> DataFrame:
    """One row per person and address; state and country do not tell addresses apart."""
    same = ["state_region", "int_region", "country"]
    keys = [c for c in STAGED_ADDRESS if c not in same]
    return keep_one(rows.select(*STAGED_ADDRESS), keys).withColumn("address_id", natural_key(*keys))


def interest_staging(rows: DataFrame) -> DataFrame:
    keys = [c for c in STAGED_INTEREST if c != "email_opt_in"]
    return keep_one(rows.select(*STAGED_INTEREST), keys).withColumn("interests_id", natural_key(*keys))


def event_staging(rows: DataFrame) -> DataFrame:
    return distinct_keyed(rows.select(*STAGED_EVENT), key="events_id")
