"""Source systems derived from the driver tables, as SQL that Spark and the oracle both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from guestbook.functions import squeeze, street_line, trim_blank
from guestbook.functions.text import WHITESPACE
from guestbook.operators.conform import conform, conform_each, union_all
from guestbook.schemas import ADDRESS_FIELDS, ENGAGEMENT, ORDER_LINE, ORDER_PLACE, PERSON, VISIT
from workload.registry import Tables

# People of system A, with every email shape and missing values.
CRM = """
select c_custkey as id, 'crm' as source_system,
  concat('  ', split_part(c_name, '#', 1), '   ') as first_name,
  split_part(c_name, '#', 2) as last_name,
  case c_custkey % 6
    when 0 then concat(case when c_custkey % 12 = 0 then 'josé.' else '' end, c_mktsegment, cast(c_custkey as string),
                       case when c_custkey % 24 = 0 then '@exämple.com' else '@example.com' end)
    when 1 then concat(' u', cast(c_custkey as string), '@example.org', chr(9))
    when 2 then concat('www.u', cast(c_custkey as string), '@example.com')
    when 3 then concat('u', cast(c_custkey as string), '@@example.com')
    when 4 then concat('u', cast(c_custkey as string), '@example.invalid')
    else null end as email,
  case c_custkey % 4
    when 0 then concat('+1 (', lpad(cast(c_custkey % 900 + 100 as string), 3, '0'), ') 555-',
                       lpad(cast(c_custkey % 10000 as string), 4, '0'))
    when 1 then cast(c_custkey as string)
    when 2 then null
    else concat('571-333-', lpad(cast(c_custkey as string), 4, '0')) end as phone,
  concat(n_name, case when c_custkey % 3 = 0 then '' else concat(', ', c_mktsegment) end) as street,
  case when c_custkey % 7 = 0 then 'null' else n_name end as country
from {customer} join {nation} on c_nationkey = n_nationkey
"""

# People of system B, some of them also in A, some without a last name.
VENDOR = """
select s_suppkey as id, 'vendor' as source_system, 'Customer' as first_name,
  case when s_suppkey % 4 <> 3 then lpad(cast(s_suppkey as string), 9, '0') else null end as last_name,
  case when s_suppkey % 6 = 1 then concat('u', cast(s_suppkey as string), '@example.org')
       else concat('v', cast(s_suppkey % 40 as string), '@example.net') end as email,
  cast(null as string) as phone, n_name as street, n_name as country
from {supplier} join {nation} on s_nationkey = n_nationkey
"""

# Shipping and billing address of an order.
SHIPPING_AND_BILLING = """n_name as shipping_address_1,
  case when o_custkey % 4 = 0 then null else concat('Unit ', cast(c_nationkey % 3 as string)) end as shipping_address_2,
  c_mktsegment as shipping_city, n_name as shipping_state_region, 'XX' as shipping_country,
  case when o_orderkey % 3 = 0 then null else n_name end as billing_address_1,
  concat('Unit ', cast(c_nationkey % 3 as string)) as billing_address_2,
  c_mktsegment as billing_city, n_name as billing_state_region, 'XX' as billing_country"""
ORDER_PLACES = f"""
select {SHIPPING_AND_BILLING}
from {{orders}} left join {{customer}} on o_custkey = c_custkey left join {{nation}} on c_nationkey = n_nationkey
"""

# Store order lines with buyer, event, shipping and billing address.
LINE_COLUMNS = f"""
select 'Customer' as name_first, lpad(cast(o_custkey as string), 9, '0') as name_last,
  case when o_custkey % 10 = 0 then null else concat('u', cast(o_custkey as string), '@example.org') end as email,
  case when o_custkey % 3 = 0 then 'tickets' else 'shop' end as source_system,
  case when o_custkey % 3 = 0 then null when o_orderkey % 2 = 0 then 'north' else 'south' end as source_instance,
  cast(o_orderkey as string) as source_order_id,
  cast(o_orderdate as date) as order_date, o_totalprice as total,
  cast(l_partkey as string) as source_product_id, p_name as product_name,
  l_quantity as quantity, l_extendedprice as unit_price, l_discount as item_discount,
  case when o_orderkey % 11 = 0 then null else concat('Event ', cast(o_custkey % 12 as string)) end as event_name,
  case when o_orderkey % 5 = 0 then null else concat('Venue ', cast(o_orderkey % 4 as string)) end as venue_name,
  cast(o_orderdate as date) as event_datetime,
  {SHIPPING_AND_BILLING}
"""
LINES = f"""{LINE_COLUMNS.rstrip()}
from {{orders}} left join {{lineitem}} on o_orderkey = l_orderkey
  left join {{part}} on l_partkey = p_partkey
  left join {{customer}} on o_custkey = c_custkey
  left join {{nation}} on c_nationkey = n_nationkey
"""
# The same rows by joins that move less: an order's customer is found once, and a line's part before its order's columns are beside it.
LINES_BY_ORDER = f"""{LINE_COLUMNS.rstrip()}
from {{orders}} left join {{customer}} on o_custkey = c_custkey
  left join {{nation}} on c_nationkey = n_nationkey
  left join ({{lineitem}} left join {{part}} on l_partkey = p_partkey) on o_orderkey = l_orderkey
"""

# Engagement log: clicks, opens, subscribes, unsubscribes.
ACTIONS = """
select event_id, concat('u', cast(user_id as string), '@example.org') as email,
  case event_type when 'click' then 'email_click' when 'view' then 'email_open'
    when 'signup' then 'email_subscribe' when 'purchase' then 'email_purchase'
    else 'email_unsubscribe' end as marketing_action_type,
  cast(regexp_extract(props, '([0-9]+)', 1) as int) % 20 as source_campaign_id,
  cast(regexp_extract(props, '([0-9]+)', 1) as int) % 7 as list_id, ts as created_at
from {events}
"""

# Visits of occurrences with nullable name and venue, over several years.
VISITS = """
select cast(o_orderkey as string) as source_event_id, 'Customer' as name_first,
  lpad(cast(o_custkey as string), 9, '0') as name_last,
  case when o_custkey % 10 = 0 then null else concat('u', cast(o_custkey as string), '@example.org') end as email,
  case when o_orderkey % 11 = 0 then null else concat('Event ', cast(o_custkey % 12 as string)) end as event_name,
  case when o_orderkey % 5 = 0 then null else concat('Venue ', cast(o_orderkey % 4 as string)) end as venue_name,
  cast(o_orderdate as date) as start_time, o_orderstatus = 'F' as attending, o_orderpriority as event_description,
  n_name as address_1, case when o_orderkey % 7 = 0 then null else c_mktsegment end as city,
  n_name as state_region, c_mktsegment as postal_code, 'XX' as country
from {orders} left join {customer} on o_custkey = c_custkey left join {nation} on c_nationkey = n_nationkey
"""

# Lists of the campaigns: the engagement log's own campaigns and some nobody used.
CAMPAIGNS = """
select distinct p_size as source_campaign_id, concat('Campaign ', cast(p_size as string)) as campaign_name,
  p_size * 10 as template_id, case when p_size % 2 = 0 then 'Email' else 'Push' end as message_medium
from {part}
"""
LISTS = """
select n_nationkey as list_id, concat('List ', n_name) as list_name, r_name as list_description,
  case when n_regionkey % 2 = 0 then 'Standard' else 'Dynamic' end as list_type
from {nation} join {region} on n_regionkey = r_regionkey
"""

SQUEEZED = f"trim(regexp_replace(%s, '{WHITESPACE}', ' ', 'g'))"
UNBLANKED = "trim(%s, ' ' || chr(9))"

# The conformed people, as the oracle writes them.
PEOPLE_SQL = f"""
people as (
  select cast(id as varchar) as source_consumer_id, source_system, {SQUEEZED % 'first_name'} as name_first,
    last_name as name_last, {UNBLANKED % 'email'} as email, phone, string_split(street, ',')[1] as address_1,
    string_split(street, ',')[2] as address_2, country, last_name as postal_code
  from ({CRM})
  union all
  select cast(id as varchar), source_system, first_name, last_name, email, phone, string_split(street, ',')[1],
    string_split(street, ',')[2], country, last_name
  from ({VENDOR})
)"""


def crm(t: Tables) -> DataFrame:
    return t.sql(CRM)


def vendor(t: Tables) -> DataFrame:
    return t.sql(VENDOR)


def _person(df: DataFrame) -> DataFrame:
    return conform(
        df,
        {
            "source_consumer_id": "id",
            "source_system": "source_system",
            "name_first": squeeze("first_name"),
            "name_last": "last_name",
            "email": trim_blank("email"),
            "course_home": "country",
            "sign_up_source": "source_system",
            "address_1": street_line("street", 0),
            "address_2": street_line("street", 1),
            "country": "country",
            "postal_code": "last_name",
        },
        PERSON,
    )


def people(t: Tables) -> DataFrame:
    """Both systems, conformed."""
    return union_all([_person(crm(t)), _person(vendor(t))])


def home_addresses(t: Tables) -> DataFrame:
    names = ["address_1", "address_2", "country", "postal_code"]
    return conform(people(t), {n: n for n in names}, ADDRESS_FIELDS)


def lines(t: Tables) -> DataFrame:
    """Store order lines, conformed."""
    df = t.sql(LINES_BY_ORDER)
    return conform(df, {c: c for c in df.columns}, ORDER_LINE)


def order_addresses(t: Tables) -> DataFrame:
    """Both addresses of every order."""
    given = [{c: f"{kind}_{c}" for c in ORDER_PLACE} for kind in ("shipping", "billing")]
    return conform_each(t.sql(ORDER_PLACES), given, ADDRESS_FIELDS)


# The address book of people and orders, as the oracle writes it.
BOOK_COLUMNS = ["address_1", "address_2", "city", "state_region", "country", "postal_code"]


def engagement(t: Tables) -> DataFrame:
    """The log with its campaigns and lists, conformed."""
    acted = t.sql(ACTIONS).withColumn("name_first", F.lit("Customer"))
    acted = acted.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH"))
    used = {
        c: c for c in ["name_first", "email", "marketing_action_type", "source_campaign_id", "list_id", "created_at"]
    }
    campaigns, lists = t.sql(CAMPAIGNS), t.sql(LISTS)
    return union_all(
        [
            conform(acted, used, ENGAGEMENT),
            conform(campaigns, {c: c for c in campaigns.columns}, ENGAGEMENT),
            conform(lists, {c: c for c in lists.columns}, ENGAGEMENT),
        ]
    )


def visits(t: Tables) -> DataFrame:
    """Visits with the place of the event, conformed."""
    df = t.sql(VISITS)
    return conform(df, {c: c for c in df.columns}, VISIT)


def venue_addresses(t: Tables) -> DataFrame:
    names = ["address_1", "city", "state_region", "country", "postal_code"]
    return conform(visits(t), {n: n for n in names}, ADDRESS_FIELDS)
