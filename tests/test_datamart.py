"""The thirteen tables from a few rows of every source system."""

from __future__ import annotations

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from guestbook.plans import datamart, feed, marketing, older
from guestbook.schemas import DATAMART, PLACE
from guestbook.sources import systems
from guestbook.sources.systems import ccms, click_history, salesforce_organizations
from tests import sources
from tests.conftest import rows


@pytest.fixture(scope="module")
def trusted(spark):
    return sources.frames(spark)


@pytest.fixture(scope="module")
def mart(spark, trusted):
    return datamart.build(datamart.conform_all(trusted).staged())


def records(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def data(mart):
    return {name: records(df) for name, df in mart.items()}


def test_tables_and_schemas(mart):
    assert list(mart) == list(DATAMART)
    for name, df in mart.items():
        assert df.dtypes == list(DATAMART[name].items()), name


def test_ids_are_unique(data):
    for name, table in data.items():
        ids = [r["id"] for r in table]
        assert len(ids) == len(set(ids)) and None not in ids, name


FOREIGN = [
    ("consumer_addresses", "consumer_id", "consumers"),
    ("consumer_addresses", "address_id", "addresses"),
    ("events", "address_id", "addresses"),
    ("consumer_events", "event_id", "events"),
    ("consumer_events", "consumer_id", "consumers"),
    ("orders", "consumer_id", "consumers"),
    ("orders", "source_system_id", "source_system"),
    ("orders", "address_shipping_id", "addresses"),
    ("orders", "address_billing_id", "addresses"),
    ("order_items", "order_id", "orders"),
    ("order_items", "event_id", "events"),
    ("consumer_marketing_actions", "consumer_id", "consumers"),
    ("consumer_marketing_actions", "campaign_id", "marketing_campaigns"),
    ("campaign_marketing_lists", "campaign_id", "marketing_campaigns"),
    ("campaign_marketing_lists", "marketing_list_id", "marketing_lists"),
    ("marketing_action_list", "action_id", "consumer_marketing_actions"),
    ("marketing_action_list", "list_id", "marketing_lists"),
]


@pytest.mark.parametrize(("child", "column", "parent"), FOREIGN)
def test_foreign_keys_resolve(data, child, column, parent):
    known = {r["id"] for r in data[parent]}
    used = {r[column] for r in data[child]} - {None}
    assert used and used <= known


def test_people(data):
    people = {(r["email"], r["name_first"], r["name_last"]): r for r in data["consumers"]}
    assert set(people) == {
        ("tina@x.com", "Tina", "Ray"), ("gus@x.com", "Gus", None), ("ann@x.com", "Ann", "Lee"),
        ("bob@x.com", "Bob", "Fox"), ("cal@x.com", "Cal", "Roe"), ("dan@x.com", "Dan", "Poe"),
        ("sue@x.com", "Sue", "May"), ("kim@x.com", "Kim", "Orr"), ("quin@x.com", "Quin", "Ivy"),
        ("pat@x.com", "Pat", "Hay"), ("ray@x.com", None, None), (" uma@x.com ".strip(), "Uma", "Voss"),
        ("zed@x.com", None, None), ("new@x.com", None, None), ("ike@x.com", "Ike", "Ames"),
    }
    assert people["gus@x.com", "Gus", None]["golf_handicap"] == 12
    assert people["gus@x.com", "Gus", None]["birth_date"] == dt.date(1990, 2, 3)
    assert people["pat@x.com", "Pat", "Hay"]["parent_of_junior"] is True
    assert people["ray@x.com", None, None]["parent_of_junior"] is False


def test_bridge_matches_null_safely(data):
    """Every person row against every address, by brute force."""
    homes = {
        (r["id"], *(r[c] for c in PLACE))
        for r in data["addresses"]
    }
    ann = next(r["id"] for r in data["consumers"] if r["email"] == "ann@x.com")
    linked = {r["address_id"] for r in data["consumer_addresses"] if r["consumer_id"] == ann}
    lived = [
        ("2 Oak", "Apt 1", "Cary", "NC", "US", "27000"),
        ("9 Hill", None, "Cary", "NC", "US", "27000"),
        ("2 Oak", " Apt 1", "Cary", "NC", "US", "27000"),
        ("x", None, None, None, None, None),
    ]
    assert linked == {h[0] for h in homes for place in lived if h[1:] == place}
    assert len(linked) == 4


def test_word_null_is_no_address(data):
    assert all("null" not in r.values() for r in data["addresses"])
    keys = [tuple(r[c] for c in r if c != "id") for r in data["addresses"]]
    assert len(keys) == len(set(keys))
    assert not any(all(v is None for v in k) for k in keys)
    gus = next(r["id"] for r in data["consumers"] if r["email"] == "gus@x.com")
    assert not any(r["consumer_id"] == gus for r in data["consumer_addresses"]), "the person still says 'null'"


def test_payment_addresses_of_known_orders_only(data):
    lines = {r["address_1"] for r in data["addresses"]}
    assert "7 Bay" in lines and "lost" not in lines


def test_events(data):
    events = {(r["event_name"], r["venue_name"], r["start_time"].year) for r in data["events"]}
    assert events == {("Gala", "Hall", 2023), ("Open", "Links", 2023), ("Cup", None, 2024)}
    gala = next(r for r in data["events"] if r["event_name"] == "Gala")
    assert gala["rsvp_open"] is True and gala["address_id"] is not None
    parts = {(r["event_id"], r["attending"]) for r in data["consumer_events"]}
    assert len(data["consumer_events"]) == 4 and (gala["id"], True) in parts


def test_source_systems(data):
    found = [(r["id"], r["platform"], r["name"]) for r in sorted(data["source_system"], key=lambda r: r["id"])]
    platforms = [p for _, p, _ in found]
    assert [i for i, _, _ in found] == list(range(1, 14))
    assert platforms == sorted(platforms)
    assert {n for _, p, n in found if p == "shopify"} == {"ryder_cup", "pga", None}
    assert len(set(platforms)) == 11


def test_orders_and_items(data):
    orders = {(r["source_order_id"], r["total"]): r for r in data["orders"]}
    assert set(orders) == {("o1", 50.5), ("w1", 1000.0), ("r1", 20.0), ("901", 31.5), ("901", 5.0)}
    assert ("o2", 10.0) not in orders, "its buyer has no email"
    shop = orders["901", 31.5]
    assert shop["total_ship"] == 3.0 and shop["total_gross_sub"] == 30.0
    homes = {r["id"]: r for r in data["addresses"]}
    assert homes[shop["address_shipping_id"]]["address_1"] == "2 Oak"
    assert homes[shop["address_billing_id"]]["address_1"] == "5 Sea"
    assert orders["901", 5.0]["address_billing_id"] is None
    items = sorted((r["product_name"] or r["source_product_id"], r["order_id"]) for r in data["order_items"])
    assert items == sorted(
        [("p1", orders["o1", 50.5]["id"]), ("p2", orders["o1", 50.5]["id"]), ("Suite", orders["w1", 1000.0]["id"]),
         ("Cap", shop["id"]), ("Tee", shop["id"]), ("Mug", orders["901", 5.0]["id"])]
    )
    open_event = next(r["id"] for r in data["events"] if r["event_name"] == "Open")
    assert {r["event_id"] for r in data["order_items"] if r["source_product_id"] in ("p1", "p2", "pb1")} == {open_event}


def test_marketing(data):
    campaigns = {r["source_campaign_id"]: r for r in data["marketing_campaigns"]}
    assert set(campaigns) == {"71", "73"}, "a campaign without lists is not listed"
    assert campaigns["73"]["template_id"] == 702
    assert {r["list_name"] for r in data["marketing_lists"]} == {"All", "VIP", "None"}
    assert len(data["campaign_marketing_lists"]) == 2
    kinds = sorted(r["marketing_action_type"] for r in data["consumer_marketing_actions"])
    assert kinds == ["email_click", "email_click", "email_open", "email_subscribe", "email_subscribe", "email_unsubscribe"]
    opened = next(r for r in data["consumer_marketing_actions"] if r["marketing_action_type"] == "email_open")
    assert (opened["message_name"], opened["proxy_source"]) == ("News", "proxy")
    # At t1 Ann clicked, opened and subscribed to two lists: three actions by two lists; then t4 and t6.
    assert len(data["marketing_action_list"]) == 3 * 2 + 1 + 1


def test_branches_agree_with_the_full_log(spark, trusted, data):
    """The log that joins everything gives the same campaigns, lists, bridges and actions."""
    from guestbook.operators.conform import conform, union_all
    from guestbook.schemas import ENGAGEMENT

    clicks = click_history(trusted)
    subs = systems.subscription_history(trusted)

    def shaped(df):
        return conform(df, {c: c for c in ENGAGEMENT if c in df.columns}, ENGAGEMENT)

    log = union_all([shaped(clicks), shaped(subs)]).distinct()
    keyed = marketing.keyed_actions(log)
    made = {
        "marketing_campaigns": marketing.campaigns(log),
        "marketing_lists": marketing.marketing_lists(log),
        "campaign_marketing_lists": marketing.campaign_lists(log),
        "consumer_marketing_actions": marketing.consumer_actions(keyed),
        "marketing_action_list": marketing.action_lists(log, keyed),
    }
    for name, df in made.items():
        assert sorted(map(repr, records(df))) == sorted(map(repr, data[name])), name


def test_rerun_gives_the_same_rows(spark, trusted, data):
    again = datamart.build(datamart.conform_all(trusted), staged=False)
    for name, df in again.items():
        assert sorted(map(repr, records(df))) == sorted(map(repr, data[name])), name


def test_legacy_chain(trusted):
    linked = {r["source_consumer_id"]: r for r in records(ccms(trusted))}
    assert linked[51]["email"] == "uma@x.com" and linked[51]["golf_handicap"] == "9"
    assert linked[52]["email"] is None, "no address, so no email"
    rooted = {r["source_consumer_id"]: r for r in records(ccms(trusted, linked=False))}
    assert rooted[52]["email"] == "wes@x.com"


def test_won_deals_drive(trusted):
    won = {r["source_order_id"]: r["email"] for r in records(systems.salesforce_championships(trusted))}
    assert won == {"w1": "kim@x.com", "w3": None}
    roles = {r["role"]: r["org_name"] for r in records(salesforce_organizations(trusted))}
    assert roles == {"CEO": "Orr Inc", None: None}


def test_click_history_is_full(trusted):
    log = records(click_history(trusted))
    assert {r["list_name"] for r in log} == {"All", "VIP", "None", None}
    assert {r["source_campaign_id"] for r in log} == {71, 73, None}
    assert {r["email"] for r in log} == {"ann@x.com", "zed@x.com", None}
    # Ann's click and open on campaign 71, each by its two lists.
    assert sum(1 for r in log if r["email"] == "ann@x.com" and r["source_campaign_id"] == 71) == 4


def test_draft_histories(trusted):
    clicks = records(systems.campaign_click_history(trusted))
    assert {(r["source_campaign_id"], r["marketing_action_type"]) for r in clicks} == {
        (71, "email_click"), (71, "email_open"), (73, None)
    }
    subs = records(systems.campaign_subscription_history(trusted))
    assert {(r["source_campaign_id"], r["list_id"], r["action_email"]) for r in subs} == {
        (71, 81, "ann@x.com"), (71, 81, "new@x.com"), (71, 82, "ann@x.com"), (73, None, None)
    }


def test_person_feed(trusted):
    got = {(r["email"], r["firstName"]): r for r in records(feed.person_feed(datamart.feed_sources(trusted)))}
    assert set(got) == {("ann@x.com", "Ann"), ("sue@x.com", "Sue"), ("pat@x.com", "Pat"), ("ray@x.com", None), ("uma@x.com", "Uma")}
    assert got["ann@x.com", "Ann"]["phoneNumber"] == "5713331112"
    assert got["sue@x.com", "Sue"]["phoneNumber"] == "57133311$2x"
    assert got["pat@x.com", "Pat"]["juniorParent"] is True
    assert got["uma@x.com", "Uma"]["address2"] is None and got["uma@x.com", "Uma"]["homeCourse"] is None


def test_older_tables(trusted):
    tables = older.older_tables(feed.person_feed(datamart.feed_sources(trusted)))
    sizes = {name: df.count() for name, df in tables.items()}
    assert sizes == {
        "emails": 5, "profiles": 4, "consumers": 0, "consumer_interests": 0, "interests": 0, "addresses": 4,
        "consumer_addresses": 4, "orders": 0, "sources": 0, "order_items": 0,
    }
    ids = {name: {r["id"] for r in records(df)} for name, df in tables.items()}
    for a, b in itertools.combinations(ids, 2):
        assert not ids[a] & ids[b]


def test_staging_drafts(trusted):
    made = datamart.staging(trusted)
    addresses = records(made["address_stg"])
    assert len({r["address_id"] for r in addresses}) == len(addresses)
    assert ("ann@x.com", "7 Bay") in {(r["email"], r["address_1"]) for r in addresses}
    interests = {r["email"]: r["email_opt_in"] for r in records(made["interests_stg"])}
    assert interests["dan@x.com"] is None and interests["ann@x.com"] is True
    events = records(made["events_stg"])
    assert {r["event_name"] for r in events} == {"Gala", "Open", None}
    assert len({r["events_id"] for r in events}) == len(events)


def test_whole_run_writes_all(spark, trusted, mart, tmp_path):
    from guestbook.operators.audit import with_audit
    from guestbook.sinks.warehouse import FolderTarget, write_all

    audited = {name: with_audit(df) for name, df in mart.items()}
    target = FolderTarget(str(tmp_path / "warehouse"))
    assert write_all(audited, str(tmp_path / "json"), target) == list(DATAMART)
    back = spark.read.parquet(f"{target.root}/consumers")
    assert back.columns[-2:] == ["created_at", "updated_at"] and back.where(F.col("created_at").isNull()).isEmpty()
    assert rows(back.select("id")) == rows(mart["consumers"].select("id"))
