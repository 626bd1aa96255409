"""Campaigns, lists, actions and the bridges between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from guestbook.functions.keys import natural_key
from guestbook.operators.dedupe import distinct_keyed, keep_one
from guestbook.operators.joins import join_on
from guestbook.plans.people import resolve
from guestbook.schemas import ACTION_FIELDS, CAMPAIGN_FIELDS, CONSUMER_MARKETING_ACTIONS, LIST_FIELDS

# The actions that name a list.
LIST_ACTIONS = ("email_subscribe", "email_unsubscribe")


def campaign_id() -> Column:
    return F.when(F.col("source_campaign_id").isNotNull(), natural_key("source_campaign_id"))


def marketing_list_id() -> Column:
    return F.when(F.col("list_id").isNotNull(), natural_key("list_id"))


def campaigns(log: DataFrame) -> DataFrame:
    rows = log.where(F.col("source_campaign_id").isNotNull()).select(*CAMPAIGN_FIELDS)
    return keep_one(rows, ["source_campaign_id"]).select(campaign_id().alias("id"), *CAMPAIGN_FIELDS)


def marketing_lists(log: DataFrame) -> DataFrame:
    rows = log.where(F.col("list_id").isNotNull()).select("list_id", *LIST_FIELDS)
    return keep_one(rows, ["list_id"]).select(*LIST_FIELDS, marketing_list_id().alias("id"))


def campaign_lists(log: DataFrame) -> DataFrame:
    pairs = log.where(F.col("source_campaign_id").isNotNull() & F.col("list_id").isNotNull()).select(
        campaign_id().alias("campaign_id"), marketing_list_id().alias("marketing_list_id")
    )
    return distinct_keyed(pairs).select("id", "campaign_id", "marketing_list_id")


def keyed_actions(log: DataFrame, people: DataFrame | None = None) -> DataFrame:
    """Distinct actions of known people (of ``people``, if given), still with email and time."""
    acted = resolve(log.where(F.col("marketing_action_type").isNotNull()), people)
    return distinct_keyed(
        acted.select("consumer_id", campaign_id().alias("campaign_id"), *ACTION_FIELDS, "email", "created_at")
    )


def consumer_actions(keyed: DataFrame) -> DataFrame:
    return keyed.select(*CONSUMER_MARKETING_ACTIONS)


def action_lists(log: DataFrame, keyed: DataFrame) -> DataFrame:
    """Which lists an action concerns: those (un)subscribed by the same person at the same time."""
    listed = (
        log.where(F.col("marketing_action_type").isin(*LIST_ACTIONS) & F.col("list_id").isNotNull())
        .select("email", "created_at", marketing_list_id().alias("list_id"))
        .distinct()
    )
    acted = keyed.select(F.col("id").alias("action_id"), "email", "created_at")
    pairs = join_on(listed, acted, equal=["email", "created_at"])
    return distinct_keyed(pairs.select("action_id", "list_id"))
