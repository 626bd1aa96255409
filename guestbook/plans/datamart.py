"""Trusted tables of all systems -> the thirteen datamart tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from guestbook.operators.conform import conform, conform_each, same_names, union_all
from guestbook.operators.dictionary import Dictionary
from guestbook.plans import addresses as places
from guestbook.plans import events as occasions
from guestbook.plans import feed, marketing, older, orders as sales, origins, people as persons
from guestbook.schemas import (
    ADDRESS_FIELDS,
    CAMPAIGN_FIELDS,
    ENGAGEMENT,
    LIST_FIELDS,
    ORDER_LINE,
    ORDER_PLACE,
    PERSON,
    PLACE,
    VISIT,
)
from guestbook.session import stage_spare
from guestbook.sources import systems

# What each system knows of a person; everything else is null. The fixed value here is which
# columns a system feeds.
_WHO = "source_consumer_id source_system name_first name_last email"
_WHERE = " ".join(PLACE)
_WHERE_NO_COUNTRY = "address_1 address_2 city state_region postal_code"
PEOPLE_COLUMNS = {
    "golf_genius": f"{_WHO} golf_handicap birth_date gender team {_WHERE}",
    "splash_that": f"{_WHO} address_1 city state_region country postal_code",
    "axs": f"{_WHO} birth_date {_WHERE}",
    "salesforce_career_services": f"{_WHO} gender {_WHERE}",
    "salesforce_championships": f"{_WHO} gender {_WHERE}",
    "salesforce_reach": f"{_WHO} birth_date gender {_WHERE_NO_COUNTRY}",
    "coach_tools": f"{_WHO} gender parent_of_junior {_WHERE_NO_COUNTRY}",
    "ccms": f"{_WHO} {_WHERE}",
    "iterable_api": f"source_system name_first name_last email total_ticket_spend {_WHERE}",
    "shopify": f"{_WHO} {_WHERE}",
    "ticket_registry": "source_system name_first name_last email postal_code",
}
ADDRESS_COLUMNS = {
    **{name: _WHERE for name in PEOPLE_COLUMNS if name != "splash_that"},
    "coach_tools": _WHERE_NO_COUNTRY,
    "ccms": f"{_WHERE} address_3 address_4",
    "ticket_registry": "postal_code",
}


@dataclass(frozen=True)
class Conformed:
    """The union of all systems by subject, each frame in its declared schema."""

    people: DataFrame  # PERSON
    addresses: DataFrame  # ADDRESS_FIELDS
    visits: DataFrame  # VISIT
    lines: DataFrame  # ORDER_LINE
    origins: DataFrame  # name, url, platform
    engagement: DataFrame  # ENGAGEMENT

    def staged(self) -> Conformed:
        """Write each subject that feeds two or more tables once, and read it back.

        One after the other, the widest first, so that the disk holds the shuffles of one. A person's repeated rows add
        nothing to the tables made of them. Addresses feed the address book alone, which is staged itself.
        """
        shared = {**vars(self), "people": self.people.distinct()}
        order = ["lines", "visits", "people", "engagement", "origins"]
        return replace(self, **{name: stage_spare(shared[name], name) for name in order})


def _address(df: DataFrame, columns: str) -> DataFrame:
    return conform(df, same_names(columns), ADDRESS_FIELDS)


def _addresses_of(df: DataFrame, *kinds: str) -> DataFrame:
    """An address row of each kind for every row, in one pass."""
    given = [{c: f"{kind}_{c}" for c in PLACE if f"{kind}_{c}" in df.columns} for kind in kinds]
    return conform_each(df, given, ADDRESS_FIELDS)


def conform_all(t: Mapping[str, DataFrame], staged: bool = True) -> Conformed:
    """All systems by subject. ``staged`` writes every view that joins tables and feeds several subjects once."""
    keep = stage_spare if staged else (lambda df, label: df)
    axs, shop, mail = systems.axs(t), systems.shopify(t), systems.iterable_api(t)
    axs = {**axs, "lines": keep(axs["lines"], "axs-lines")}
    shop = {**shop, "lines": keep(shop["lines"], "shop-lines")}
    splash = keep(systems.splash_that(t), "splash")
    championships = keep(systems.salesforce_championships(t), "championships")
    reach = keep(systems.salesforce_reach(t), "reach")
    who = {
        "golf_genius": systems.golf_genius(t),
        "splash_that": splash,
        "axs": axs["people"],
        "salesforce_career_services": systems.salesforce_career_services(t),
        "salesforce_championships": championships,
        "salesforce_reach": reach,
        "coach_tools": keep(systems.coach_tools(t), "coach"),
        "ccms": keep(systems.ccms(t), "ccms"),
        "iterable_api": mail["people"],
        "shopify": shop["people"],
        "ticket_registry": systems.ticket_registry(t),
    }

    people = union_all(conform(df, same_names(PEOPLE_COLUMNS[name]), PERSON) for name, df in who.items())

    addresses = union_all(
        [_address(df, ADDRESS_COLUMNS[name]) for name, df in who.items() if name in ADDRESS_COLUMNS]
        + [_addresses_of(axs["billing"], "billing"), _addresses_of(shop["lines"], "billing", "shipping")]
        + [_address(splash, "address_1 city state_region country postal_code")]
        + [_addresses_of(view, "venue") for view in (axs["lines"], championships)]
    )

    person = "name_first name_last email"
    venue = {
        "address_1": "venue_address_1",
        "city": "venue_city",
        "state_region": "venue_state_region",
        "postal_code": "venue_postal_code",
        "country": "venue_country",
    }
    visits = union_all(
        [
            conform(
                axs["lines"],
                same_names(f"{person} source_event_id event_name venue_name")
                | venue
                | {"start_time": "event_datetime"},
                VISIT,
            ),
            conform(splash, same_names(c for c in VISIT), VISIT),
            conform(
                championships,
                same_names(f"{person} event_name venue_name start_time end_time") | venue,
                VISIT,
            ),
        ]
    )

    line = f"{person} source_system source_order_id order_date total"
    item = "source_product_id product_name quantity unit_price"
    billing = " ".join(f"billing_{c}" for c in ORDER_PLACE)
    shipping = " ".join(f"shipping_{c}" for c in ORDER_PLACE)
    totals = "total_discount total_gross_sub total_tax total_ship"
    lines = union_all(
        [
            conform(
                axs["lines"],
                same_names(f"{line} source_product_id unit_price event_name event_datetime venue_name {billing}")
                | {f"shipping_{c}": c for c in ORDER_PLACE},
                ORDER_LINE,
            ),
            conform(
                championships,
                same_names(f"{line} {item} event_name venue_name") | {"event_datetime": "start_time"},
                ORDER_LINE,
            ),
            conform(reach, same_names(line), ORDER_LINE),
            conform(
                shop["lines"],
                same_names(f"{line} source_instance {totals} {item} item_discount {billing} {shipping}"),
                ORDER_LINE,
            ),
        ]
    )

    rows = {**who, "shopify": shop["instances"]}
    origin = union_all(
        origins.source_rows(df, "source_instance" if name == "shopify" else None) for name, df in rows.items()
    )

    log = union_all(
        [
            conform(
                mail["actions"],
                same_names(
                    "name_first name_last email source_campaign_id marketing_action_type click_url "
                    "message_name message_subscription_policy proxy_source consumer_ip list_id "
                    "list_name list_description list_type created_at"
                ),
                ENGAGEMENT,
            ),
            conform(mail["campaigns"], same_names([*CAMPAIGN_FIELDS, "list_id", *LIST_FIELDS]), ENGAGEMENT),
            conform(mail["lists"], same_names(["list_id", *LIST_FIELDS]), ENGAGEMENT),
        ]
    )
    return Conformed(people, addresses, visits, lines, origin.distinct(), log)


def build(subjects: Conformed, staged: bool = True, sources: Dictionary | None = None) -> dict[str, DataFrame]:
    """The thirteen tables, best of staged subjects.

    ``staged`` writes the tables that other tables read once. ``sources`` is the book of all loads' sources
    (``origins.source_book``), which this load extends; without it they are numbered for this load alone.
    """
    keep = stage_spare if staged else (lambda df, label: df)
    book = keep(places.address_book([subjects.addresses]), "address_book")
    identified = persons.identify(subjects.people)
    visits = occasions.event_visits(subjects.visits)
    source_system = sources.extend(subjects.origins) if sources else origins.source_systems(subjects.origins)
    order_places = keep(sales.order_places(book), "order_places")
    orders = keep(sales.orders(subjects.lines, source_system, order_places), "orders")
    actions = keep(marketing.keyed_actions(subjects.engagement), "actions")
    return {
        "consumers": persons.consumers(identified),
        "addresses": book,
        "consumer_addresses": places.consumer_addresses(persons.residences(identified), book),
        "events": occasions.events(visits, book),
        "consumer_events": occasions.consumer_events(visits),
        "source_system": source_system,
        "orders": orders,
        "order_items": sales.order_items(subjects.lines, orders, sales.surely_placed() if staged else None),
        "marketing_campaigns": marketing.campaigns(subjects.engagement),
        "consumer_marketing_actions": marketing.consumer_actions(actions),
        "marketing_lists": marketing.marketing_lists(subjects.engagement),
        "campaign_marketing_lists": marketing.campaign_lists(subjects.engagement),
        "marketing_action_list": marketing.action_lists(subjects.engagement, actions),
    }


def feed_sources(t: Mapping[str, DataFrame]) -> list[DataFrame]:
    """The three systems of the person feed, conformed to its columns."""
    who = {
        "email": "email",
        "phoneNumber": "phone",
        "firstName": "name_first",
        "lastName": "name_last",
        "genderEst": "gender",
        "address1": "address_1",
        "address2": "address_2",
        "city": "city",
        "stateRegion": "state_region",
        "country": "country",
        "postalCode": "postal_code",
    }
    coach = {k: v for k, v in who.items() if k != "country"} | {"juniorParent": "parent_of_junior"}
    legacy = {k: v for k, v in who.items() if k != "address2"}
    return [
        conform(systems.salesforce_career_services(t), who, feed.FEED),
        conform(systems.coach_tools(t), coach, feed.FEED),
        conform(systems.ccms(t), legacy, feed.FEED),
    ]


def staging_sources(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Address, interest and event rows of the staging drafts, from their six systems."""
    axs, splash = systems.axs(t), systems.splash_that(t)
    crm, coach, legacy = systems.salesforce_career_services(t), systems.coach_tools(t), systems.ccms(t)
    roster = systems.golf_genius(t)
    name = "name_first name_last email"
    homes = [
        (roster, same_names(f"{name} {_WHERE}")),
        (splash, same_names(f"{name} address_1 city state_region country postal_code")),
        (axs["people"], same_names(f"{name} {_WHERE}")),
        (crm, same_names(f"{name} {_WHERE}")),
        (coach, same_names(f"{name} {_WHERE_NO_COUNTRY}")),
        (legacy, same_names(f"{name} {_WHERE} address_3 address_4")),
    ]
    payers = systems.axs_payers(t)
    billing = (payers, same_names(name) | {c: f"billing_{c}" for c in PLACE})
    event = "source_event_id event_name event_description venue_name start_time end_time rsvp_open rsvp_closed_at"
    visited = {
        1: same_names(event) | {"wait_list": "has_waitlist"},
        2: same_names("source_event_id event_name venue_name") | {"start_time": "event_datetime"},
    }
    event_homes = [(axs["lines"], m) if i == 2 else (df, m) for i, (df, m) in enumerate(homes)]
    return {
        "address": union_all(conform(df, m, older.STAGED_ADDRESS) for df, m in [*homes, billing]),
        "interest": union_all(
            conform(
                df,
                same_names(name) | ({"email_opt_in": "email_opt_in"} if i == 2 else {}),
                older.STAGED_INTEREST,
            )
            for i, (df, _) in enumerate(homes)
        ),
        "event": union_all(
            conform(df, m | visited.get(i, {}), older.STAGED_EVENT) for i, (df, m) in enumerate(event_homes)
        ),
    }


def staging(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    rows = staging_sources(t)
    return {
        "address_stg": older.address_staging(rows["address"]),
        "interests_stg": older.interest_staging(rows["interest"]),
        "events_stg": older.event_staging(rows["event"]),
    }
