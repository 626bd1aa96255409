"""People, addresses, events, sources, orders, marketing: the oracle joins, the library keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from guestbook.functions import squeeze, trim_blank
from guestbook.operators.conform import conform, union_all, union_distinct
from guestbook.operators.dedupe import distinct_keyed, keep_one
from guestbook.plans import addresses as places
from guestbook.plans import events as occasions
from guestbook.plans import datamart, feed, marketing, older, orders as sales, origins
from guestbook.plans import people as persons
from guestbook.schemas import ADDRESS_FIELDS, PERSON
from guestbook.session import stage, stage_spare
from workload.recipes import (
    ACTIONS,
    BOOK_COLUMNS,
    CAMPAIGNS,
    CRM,
    LINES,
    LISTS,
    PEOPLE_SQL,
    VENDOR,
    VISITS,
    crm,
    engagement,
    home_addresses,
    lines,
    order_addresses,
    people,
    vendor,
    venue_addresses,
    visits,
)
from workload.registry import Tables, key_sql, query

PERSON_KEY = key_sql("name_first", "name_last", "email")
PERSON_COLUMNS = ["source_consumer_id", "source_system", "name_first", "name_last", "email"]


@query(f"with {PEOPLE_SQL} select {', '.join(PERSON_COLUMNS)} from people")
def conform_union(t: Tables) -> DataFrame:
    return people(t).select(*PERSON_COLUMNS)


@query(
    f"""select distinct name_first, name_last, email from (with {PEOPLE_SQL} select * from people)""",
    name="union_distinct_feed",
)
def union_distinct_people(t: Tables) -> DataFrame:
    names = ["name_first", "name_last", "email"]
    both = [
        crm(t).select(squeeze("first_name").alias("name_first"), F.col("last_name").alias("name_last"), trim_blank("email").alias("email")),
        vendor(t).select(F.col("first_name").alias("name_first"), F.col("last_name").alias("name_last"), "email"),
    ]
    return union_distinct(both).select(*names)


@query(
    f"""with {PEOPLE_SQL}, k as (
      select distinct name_first, name_last, email from people where email is not null)
    select name_first, name_last, email, {PERSON_KEY} as id from k"""
)
def identity_keys(t: Tables) -> DataFrame:
    known = people(t).where(F.col("email").isNotNull())
    return distinct_keyed(known.select("name_first", "name_last", "email"))


IDENTIFIED_SQL = f"""{PEOPLE_SQL}, k as (
    select distinct name_first, name_last, email, {PERSON_KEY} as id from people where email is not null),
  identified as (
    select k.id, p.* from people p join k on p.name_first is not distinct from k.name_first
      and p.name_last is not distinct from k.name_last and p.email = k.email)"""


@query(
    f"""with {IDENTIFIED_SQL}, ranked as (
      select *, row_number() over (partition by id order by country nulls last, source_system nulls last) as rn
      from identified)
    select id, email, name_first, name_last, country as course_home, source_system as sign_up_source
    from ranked where rn = 1"""
)
def identity_resolve(t: Tables) -> DataFrame:
    """One row per person of both systems, the survivor by a fixed order."""
    chosen = persons.consumers(persons.identify(people(t)))
    return chosen.select("id", "email", "name_first", "name_last", "course_home", "sign_up_source")


@query(
    f"""with {IDENTIFIED_SQL}, buyers as ({LINES})
    select b.source_order_id, b.source_product_id, b.unit_price, i.id as consumer_id
    from buyers b join (select distinct id, name_first, name_last, email from identified) i
      on b.name_first is not distinct from i.name_first and b.name_last is not distinct from i.name_last
      and b.email = i.email"""
)
def fact_resolve(t: Tables) -> DataFrame:
    """Facts of a system that did not feed the people: only known people remain."""
    known = persons.identify(people(t))
    return persons.resolve(lines(t), known).select("source_order_id", "source_product_id", "unit_price", "consumer_id")


# --- addresses -------------------------------------------------------------------------------

ADDRESS_KEY = key_sql(*ADDRESS_FIELDS)
NO_VALUE = "cast(null as varchar)"


def _address_row(**given: str) -> str:
    return ", ".join(f"{given.get(c, NO_VALUE)} as {c}" for c in ADDRESS_FIELDS)


HOME_ROWS = "select " + _address_row(
    address_1="address_1", address_2="address_2", country="country", postal_code="postal_code"
) + " from people"
ORDER_ROWS = " union all ".join(
    "select "
    + _address_row(**{c: f"{kind}_{c}" for c in ["address_1", "address_2", "city", "state_region", "country"]})
    + f" from ({LINES})"
    for kind in ("shipping", "billing")
)
VENUE_ROWS = "select " + _address_row(**{c: c for c in BOOK_COLUMNS if c != "address_2"}) + f" from ({VISITS})"


def _book_sql(*rows: str) -> str:
    cleaned = ", ".join(f"nullif({c}, 'null') as {c}" for c in ADDRESS_FIELDS)
    return f"""raw_rows as ({' union all '.join(rows)}),
      clean_rows as (select distinct {cleaned} from raw_rows),
      book as (select *, {ADDRESS_KEY} as id from clean_rows
        where coalesce({', '.join(ADDRESS_FIELDS)}) is not null)"""


@query(f"with {PEOPLE_SQL}, {_book_sql(HOME_ROWS, ORDER_ROWS)} select id, {', '.join(BOOK_COLUMNS)} from book")
def address_book(t: Tables) -> DataFrame:
    return places.address_book([home_addresses(t), order_addresses(t)]).select("id", *BOOK_COLUMNS)


HOMES_SQL = f"""homes as (
    select id, address_1, address_2, {NO_VALUE} as city, {NO_VALUE} as state_region, country, postal_code
    from identified group by all)"""


@query(
    f"""with {IDENTIFIED_SQL}, {_book_sql(HOME_ROWS, ORDER_ROWS)}, {HOMES_SQL},
    pairs as (
      select distinct h.id as consumer_id, b.id as address_id from homes h join book b on
      {' and '.join(f'h.{c} is not distinct from b.{c}' for c in BOOK_COLUMNS)}
      where coalesce({', '.join(f'h.{c}' for c in BOOK_COLUMNS)}) is not null)
    select *, {key_sql('consumer_id', 'address_id')} as id from pairs"""
)
def person_address(t: Tables) -> DataFrame:
    book = places.address_book([home_addresses(t), order_addresses(t)])
    return places.consumer_addresses(persons.residences(persons.identify(people(t))), book)


BRIDGES_SQL = f"""{IDENTIFIED_SQL}, {_book_sql(HOME_ROWS, ORDER_ROWS)}, {HOMES_SQL},
    lives as (select distinct id as consumer_id, {key_sql(*BOOK_COLUMNS)} as place_id from homes
      where coalesce({', '.join(BOOK_COLUMNS)}) is not null),
    lies as (select distinct {key_sql(*BOOK_COLUMNS)} as place_id, id as address_id from book
      where coalesce({', '.join(BOOK_COLUMNS)}) is not null)"""


def _bridges(t: Tables) -> tuple[DataFrame, DataFrame]:
    book = places.address_book([home_addresses(t), order_addresses(t)])
    return places.person_places(persons.residences(persons.identify(people(t)))), places.place_addresses(book)


@query(f"with {BRIDGES_SQL} select *, {key_sql('consumer_id', 'place_id')} as id from lives")
def person_places(t: Tables) -> DataFrame:
    return _bridges(t)[0]


@query(f"with {BRIDGES_SQL} select *, {key_sql('place_id', 'address_id')} as id from lies")
def place_addresses(t: Tables) -> DataFrame:
    return _bridges(t)[1]


@query(
    f"""with {BRIDGES_SQL}, n as (select place_id, count(consumer_id) as people, count(address_id) as addresses
      from (select place_id, consumer_id, null as address_id from lives union all select place_id, null, address_id from lies) group by 1)
    select place_id, people, addresses, people * addresses as links from n"""
)
def place_links(t: Tables) -> DataFrame:
    """People and addresses of every place, and how many pairs that makes."""
    return places.place_links(*_bridges(t))


@query(
    f"""with {BRIDGES_SQL}, n as (select place_id from lives join lies using (place_id) group by 1 having count(*) = 1)
    select consumer_id, address_id from lives join lies using (place_id) where place_id in (select place_id from n)"""
)
def only_address_there(t: Tables) -> DataFrame:
    """Pairs on demand: of the places where one person and one address meet."""
    living, lying = _bridges(t)
    return places.pairs_of(living, lying, places.place_links(living, lying).where("links = 1"))


@query(
    f"""with staged as (select distinct o_orderkey as id, o_orderpriority || chr(9) as address_1,
        o_orderstatus as city from {{orders}}),
      held as (select distinct o_orderpriority as address_1, o_orderstatus as city,
        {key_sql('o_orderpriority', 'o_orderstatus')} as id from {{orders}})
    select s.id as staged_id, h.id as existing_id from staged s join held h
      on trim(s.address_1, ' ' || chr(9)) = trim(h.address_1, ' ' || chr(9)) and s.city = h.city"""
)
def address_key_reuse(t: Tables) -> DataFrame:
    """Staged rows meet the rows of an earlier load, lines compared without tabs."""
    staged = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.concat("o_orderpriority", F.lit("\t")).alias("address_1"),
        F.col("o_orderstatus").alias("city"),
    )
    held = t.orders.select(F.col("o_orderpriority").alias("address_1"), F.col("o_orderstatus").alias("city"))
    return places.match_existing(staged, distinct_keyed(held), keys=["address_1", "city"])


# --- events ----------------------------------------------------------------------------------

EVENT_KEY = key_sql("event_name", "venue_name", "year")
KEYED_VISITS_SQL = f"""v as (select *, cast(year(start_time) as varchar) as year from ({VISITS})),
  e as (select distinct event_name, venue_name, year, {EVENT_KEY} as id from v where event_name is not null),
  keyed as (select e.id, v.* from e join v on e.event_name = v.event_name
    and e.venue_name is not distinct from v.venue_name and e.year is not distinct from v.year)"""


@query(
    f"""with {KEYED_VISITS_SQL}, {_book_sql(VENUE_ROWS)}, ranked as (
      select *, row_number() over (partition by id order by cast(source_event_id as varchar),
        event_description nulls last) as rn from keyed),
    looked as (select address_1, city, state_region, postal_code, country, min(id) as address_id from book
      group by all)
    select r.id, r.source_event_id, r.event_name, r.event_description, r.venue_name, l.address_id,
      strftime(r.start_time, '%Y-%m-%d') as start_day
    from ranked r left join looked l on r.address_1 = l.address_1 and r.city = l.city
      and r.state_region = l.state_region and r.postal_code = l.postal_code and r.country = l.country
    where rn = 1"""
)
def event_master(t: Tables) -> DataFrame:
    book = places.address_book([venue_addresses(t)])
    made = occasions.events(occasions.event_visits(visits(t)), book)
    return made.select(
        "id", "source_event_id", "event_name", "event_description", "venue_name", "address_id",
        F.date_format("start_time", "yyyy-MM-dd").alias("start_day"),
    )


@query(
    f"""with {KEYED_VISITS_SQL}, {_book_sql(VENUE_ROWS)},
    p as (select distinct name_first, name_last, email, {PERSON_KEY} as pid from v where email is not null)
    select distinct k.id as event_id, p.pid as consumer_id, k.attending from keyed k join p
      on k.name_first is not distinct from p.name_first and k.name_last is not distinct from p.name_last
      and k.email = p.email"""
)
def person_event(t: Tables) -> DataFrame:
    made = occasions.consumer_events(occasions.event_visits(visits(t)))
    return made.select("event_id", "consumer_id", "attending")


# --- sources, orders, items --------------------------------------------------------------------

SOURCES_SQL = f"""(select row_number() over (order by platform, name nulls last) as id, name, platform
  from (select distinct source_instance as name, source_system as platform from ({LINES})))"""


def _sources(t: Tables) -> DataFrame:
    return origins.source_systems(origins.source_rows(lines(t), "source_instance"))


@query(f"select id, name, {NO_VALUE} as url, platform from {SOURCES_SQL}")
def source_dimension(t: Tables) -> DataFrame:
    return _sources(t)


ORDER_KEY = key_sql("source_order_id", "source_system", "source_instance")
ORDER_PLACES = ["address_1", "address_2", "city", "state_region", "country"]


def _lookup_sql(kind: str) -> str:
    return f"left join found {kind} on " + " and ".join(f"o.{kind}_{c} = {kind}.{c}" for c in ORDER_PLACES)


# The people of the shop's own register, in which every seventh buyer is missing.
BUYERS = """
select 'Customer' as name_first, lpad(cast(c_custkey as string), 9, '0') as name_last,
  concat('u', cast(c_custkey as string), '@example.org') as email
from {customer} where c_custkey % 7 <> 0
"""


def buyers(t: Tables) -> DataFrame:
    return persons.identify(t.sql(BUYERS))


ORDERS_SQL = f"""l as ({LINES}), {_book_sql(ORDER_ROWS)},
  found as (select {', '.join(ORDER_PLACES)}, min(id) as address_id from book group by all),
  p as (select *, {PERSON_KEY} as pid from ({BUYERS})),
  s as (select * from {SOURCES_SQL}),
  o as (select distinct {ORDER_KEY} as id, p.pid as consumer_id, s.id as source_system_id, source_order_id,
      order_date, total, {', '.join(f'{k}_{c}' for k in ('shipping', 'billing') for c in ORDER_PLACES)}
    from l join p on l.name_first is not distinct from p.name_first
      and l.name_last is not distinct from p.name_last and l.email = p.email
      left join s on l.source_system = s.platform and l.source_instance is not distinct from s.name
    where source_order_id is not null)"""


@query(
    f"""with {ORDERS_SQL}
    select o.id, consumer_id, source_system_id, source_order_id, shipping.address_id as address_shipping_id,
      billing.address_id as address_billing_id, strftime(order_date, '%Y-%m-%d') as order_day, total
    from o {_lookup_sql('shipping')} {_lookup_sql('billing')}"""
)
def orders_fact(t: Tables) -> DataFrame:
    """Orders of registered people; others' orders aren't facts."""
    book = places.address_book([order_addresses(t)])
    placed = t.once("lines", lambda: stage(lines(t), "lines"))
    sources = origins.source_systems(origins.source_rows(placed, "source_instance"))
    made = sales.orders(placed, sources, book, buyers(t))
    return made.select(
        "id", "consumer_id", "source_system_id", "source_order_id", "address_shipping_id", "address_billing_id",
        F.date_format("order_date", "yyyy-MM-dd").alias("order_day"), "total",
    )


ITEM_COLUMNS = ["source_product_id", "product_name", "quantity", "unit_price", "item_discount"]


@query(
    f"""with l as ({LINES}),
    e as (select distinct event_name, venue_name, cast(year(event_datetime) as varchar) as year from l
      where event_name is not null),
    ek as (select *, {EVENT_KEY} as event_id from e),
    o as (select distinct {ORDER_KEY} as order_id, source_order_id, source_system, source_instance from l
      where source_order_id is not null and email in (select email from ({BUYERS}))),
    i as (select distinct source_order_id, source_system, source_instance, {', '.join(ITEM_COLUMNS)}, event_name,
        venue_name, cast(year(event_datetime) as varchar) as year from l
      where source_order_id is not null or source_product_id is not null)
    select distinct o.order_id, {', '.join('i.' + c for c in ITEM_COLUMNS)}, ek.event_id
    from o join i on o.source_order_id is not distinct from i.source_order_id and o.source_system = i.source_system
      and o.source_instance is not distinct from i.source_instance
      left join ek on i.event_name = ek.event_name and i.year is not distinct from ek.year
        and i.venue_name is not distinct from ek.venue_name
    where coalesce(cast(i.quantity as varchar), cast(i.unit_price as varchar), i.product_name) is not null"""
)
def order_items_fact(t: Tables) -> DataFrame:
    """Items of the orders of registered people."""
    rows = t.once("lines", lambda: stage(lines(t), "lines"))
    sources = origins.source_systems(origins.source_rows(rows, "source_instance"))
    placed = sales.orders(rows, sources, places.address_book([order_addresses(t)]), buyers(t))
    made = sales.order_items(rows, placed)
    return made.select("order_id", *ITEM_COLUMNS, "event_id")


# --- marketing -------------------------------------------------------------------------------

LOG_SQL = f"""acted as (select 'Customer' as name_first, {NO_VALUE} as name_last, email, marketing_action_type,
    source_campaign_id, list_id, strftime(created_at, '%Y-%m-%d %H') as created_at from ({ACTIONS})),
  c as ({CAMPAIGNS}), li as ({LISTS}),
  all_campaigns as (select source_campaign_id, campaign_name, template_id, message_medium from c
    union select source_campaign_id, null, null, null from acted),
  all_lists as (select list_id, list_name, list_description, list_type from li
    union select list_id, null, null, null from acted)"""
CAMPAIGN_KEY = key_sql("source_campaign_id")
LIST_KEY = key_sql("list_id")


@query(
    f"""with {LOG_SQL}, ranked as (select *, row_number() over (partition by source_campaign_id
      order by campaign_name nulls last) as rn from all_campaigns)
    select {CAMPAIGN_KEY} as id, cast(source_campaign_id as varchar) as source_campaign_id, campaign_name,
      template_id, message_medium from ranked where rn = 1"""
)
def campaigns(t: Tables) -> DataFrame:
    made = marketing.campaigns(engagement(t))
    return made.select("id", "source_campaign_id", "campaign_name", "template_id", "message_medium")


@query(
    f"""with {LOG_SQL}, ranked as (select *, row_number() over (partition by list_id
      order by list_name nulls last) as rn from all_lists)
    select list_name, list_description, list_type, {LIST_KEY} as id from ranked where rn = 1""",
    name="lists",
)
def marketing_lists(t: Tables) -> DataFrame:
    return marketing.marketing_lists(engagement(t))


@query(
    f"""with {LOG_SQL}, pairs as (select distinct {CAMPAIGN_KEY} as campaign_id, {LIST_KEY} as marketing_list_id
      from acted)
    select {key_sql('campaign_id', 'marketing_list_id')} as id, * from pairs"""
)
def campaign_list_bridge(t: Tables) -> DataFrame:
    return marketing.campaign_lists(engagement(t))


ACTED_SQL = f"""keyed as (select distinct {PERSON_KEY} as consumer_id, {CAMPAIGN_KEY} as campaign_id,
  marketing_action_type, email, created_at from acted)"""


@query(f"with {LOG_SQL}, {ACTED_SQL} select consumer_id, campaign_id, marketing_action_type, created_at from keyed")
def consumer_actions(t: Tables) -> DataFrame:
    made = marketing.keyed_actions(engagement(t))
    return made.select("consumer_id", "campaign_id", "marketing_action_type", "created_at")


@query(
    f"""with {LOG_SQL}, {ACTED_SQL},
    listed as (select distinct email, created_at, {LIST_KEY} as list_id from acted
      where marketing_action_type in ('email_subscribe', 'email_unsubscribe'))
    select k.consumer_id, k.campaign_id, k.marketing_action_type, k.created_at, l.list_id
    from listed l join keyed k on l.email = k.email and l.created_at = k.created_at"""
)
def action_list_bridge(t: Tables) -> DataFrame:
    """The bridge, spelled out through its keys."""
    keyed = stage(marketing.keyed_actions(engagement(t)), "actions")
    bridge = marketing.action_lists(engagement(t), keyed).select("action_id", "list_id")
    return bridge.join(keyed.withColumnRenamed("id", "action_id"), "action_id").select(
        "consumer_id", "campaign_id", "marketing_action_type", "created_at", "list_id"
    )


# --- feed and older shapes ---------------------------------------------------------------------

FEED_MAPPING = {
    "email": "email",
    "phoneNumber": "phone",
    "firstName": "first_name",
    "lastName": "last_name",
    "address1": "street",
    "country": "country",
}
FEED_COLUMNS = list(FEED_MAPPING)


def _feed_sql(source: str) -> str:
    return f"""select trim(email, chr(9)) as email, regexp_replace(phone, '[^0-9a-zA-Z$]+', '', 'g') as phoneNumber,
      first_name as firstName, last_name as lastName, street as address1, country
    from (select *, row_number() over (partition by email, first_name, last_name
      order by phone nulls last, street nulls last, country nulls last) as rn from ({source}))
    where rn = 1 and email is not null"""


FEED_SQL = f"{_feed_sql(CRM)} union {_feed_sql(VENDOR)}"


def _feed(t: Tables) -> DataFrame:
    return feed.person_feed([conform(df, FEED_MAPPING, feed.FEED) for df in (crm(t), vendor(t))])


@query(FEED_SQL)
def person_feed(t: Tables) -> DataFrame:
    return _feed(t).select(*FEED_COLUMNS)


@query(
    f"""select table_name, count(*) as rows, count(distinct id) as ids from (
      with f as ({FEED_SQL})
      select 'emails' as table_name, rowid_key as id from (select *, {key_sql(*FEED_COLUMNS)} as rowid_key from f)
      union all select 'profiles', rowid_key from (select *, {key_sql(*FEED_COLUMNS)} as rowid_key from f)
      union all select 'addresses', rowid_key from (select *, {key_sql(*FEED_COLUMNS)} as rowid_key from f)
      union all select 'consumer_addresses', rowid_key from (select *, {key_sql(*FEED_COLUMNS)} as rowid_key from f)
    ) group by table_name"""
)
def older_person_tables(t: Tables) -> DataFrame:
    """Row and key counts of the older tables; those without any content come out empty."""
    made = older.older_tables(stage(_feed(t), "feed"))
    sizes = [df.select(F.lit(name).alias("table_name"), "id") for name, df in made.items()]
    return union_all(sizes).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids")
    )


STAGED = ["name_first", "name_last", "email", "address_1", "address_2", "country", "postal_code"]


@query(
    f"""with {PEOPLE_SQL}, ranked as (
      select *, row_number() over (partition by name_first, name_last, email, address_1, address_2, postal_code
        order by country nulls last) as rn from people)
    select {', '.join(STAGED)} from ranked where rn = 1"""
)
def staging_tables(t: Tables) -> DataFrame:
    rows = conform(people(t), {c: c for c in STAGED}, older.STAGED_ADDRESS)
    return older.address_staging(rows).select(*STAGED)


@query(
    f"""with {PEOPLE_SQL} select distinct name_first, name_last, email, source_system as event_name, country,
      address_1 from people"""
)
def event_staging(t: Tables) -> DataFrame:
    mapping = {c: c for c in ["name_first", "name_last", "email", "country", "address_1"]}
    rows = conform(people(t), {**mapping, "event_name": "source_system"}, older.STAGED_EVENT)
    return older.event_staging(rows).select("name_first", "name_last", "email", "event_name", "country", "address_1")


@query(
    """select o_custkey, o_orderkey, o_orderstatus from (
      select *, row_number() over (partition by o_custkey order by o_orderstatus, o_orderkey) as rn from {orders})
    where rn = 1"""
)
def survivor_per_key(t: Tables) -> DataFrame:
    return keep_one(t.orders.select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], ["o_orderstatus", "o_orderkey"])


# --- the whole datamart ------------------------------------------------------------------------

PERSON_ROWS = "select name_first, name_last, email from"


def _rows_sql(table: str, body: str) -> str:
    return f"select '{table}' as table_name, count(*) as rows, count(*) as ids from ({body})"


DATAMART_SQL = " union all ".join(
    [
        _rows_sql(
            "consumers",
            f"""with {PEOPLE_SQL} select distinct name_first, name_last, email from (
              {PERSON_ROWS} people union all {PERSON_ROWS} ({LINES}) union all {PERSON_ROWS} ({VISITS})
              union all select 'Customer', null, email from ({ACTIONS})) where email is not null""",
        ),
        _rows_sql("addresses", f"with {PEOPLE_SQL}, {_book_sql(HOME_ROWS, ORDER_ROWS, VENUE_ROWS)} select id from book"),
        _rows_sql(
            "consumer_addresses",
            f"""with {IDENTIFIED_SQL}, {_book_sql(HOME_ROWS, ORDER_ROWS, VENUE_ROWS)}, {HOMES_SQL}
              select distinct h.id as consumer_id, b.id as address_id from homes h join book b on
              {' and '.join(f'h.{c} is not distinct from b.{c}' for c in BOOK_COLUMNS)}""",
        ),
        _rows_sql("events", f"with {KEYED_VISITS_SQL} select * from e"),
        _rows_sql(
            "consumer_events",
            f"""with {KEYED_VISITS_SQL} select distinct id, name_first, name_last, email, attending from keyed
              where email is not null""",
        ),
        _rows_sql("source_system", f"select * from {SOURCES_SQL} union all select 0, null, s from (values ('crm'), ('vendor')) v(s)"),
        _rows_sql("orders", f"select distinct {', '.join(sales.ORDER_KEY)} from ({LINES}) where email is not null"),
        _rows_sql(
            "order_items",
            f"""select distinct {', '.join(sales.ORDER_KEY)}, {', '.join(ITEM_COLUMNS)},
                case when event_name is not null then venue_name end, event_name, year(event_datetime)
              from ({LINES}) where email is not null and source_product_id is not null""",
        ),
        _rows_sql("marketing_campaigns", f"with {LOG_SQL} select distinct source_campaign_id from all_campaigns"),
        _rows_sql("marketing_lists", f"with {LOG_SQL} select distinct list_id from all_lists"),
        _rows_sql("campaign_marketing_lists", f"with {LOG_SQL} select distinct source_campaign_id, list_id from acted"),
        _rows_sql("consumer_marketing_actions", f"with {LOG_SQL}, {ACTED_SQL} select * from keyed"),
        _rows_sql(
            "marketing_action_list",
            f"""with {LOG_SQL}, {ACTED_SQL}, listed as (select distinct email, created_at, list_id from acted
                where marketing_action_type in ('email_subscribe', 'email_unsubscribe'))
              select k.*, l.list_id from listed l join keyed k on l.email = k.email and l.created_at = k.created_at""",
        ),
    ]
)


@query(DATAMART_SQL, name="datamart")
def whole_datamart(t: Tables) -> DataFrame:
    """Rows and distinct ids of all thirteen tables, built together from one set of subjects."""
    who = {"name_first": "name_first", "name_last": "name_last", "email": "email"}
    log = engagement(t)
    subjects = datamart.Conformed(
        people=union_all([people(t), *[conform(df, who, PERSON) for df in (visits(t), log)]]),
        addresses=union_all([home_addresses(t), order_addresses(t), venue_addresses(t)]),
        visits=visits(t),
        lines=lines(t),
        origins=union_all([origins.source_rows(lines(t), "source_instance"), origins.source_rows(people(t))]).distinct(),
        engagement=log,
    )
    made = datamart.build(subjects.staged())
    return union_all([_tally(name, df) for name, df in made.items()])


def _tally(name: str, df: DataFrame) -> DataFrame:
    """A table's name, rows and distinct ids. It is made here, so that the disk holds the shuffles of one table.

    Ids of 32 hexadecimal digits are counted as their 16 bytes.
    """
    id_ = F.col("id").cast("string")
    digits = id_.rlike("^[0-9a-f]{32}$")
    packed = df.select(F.when(digits, F.unhex(id_)).alias("bytes"), F.when(~digits, id_).alias("text"))
    each = packed.groupBy("bytes", "text").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("bytes").isNotNull() | F.col("text").isNotNull()
    sums = each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.when(known, 1)).alias("ids"))
    return stage_spare(sums.where("rows > 0").select(F.lit(name).alias("table_name"), "rows", "ids"), f"tally-{name}")
