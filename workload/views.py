"""Views of the source systems over raw tables shaped from the driver tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, functions as F

from guestbook.sources import systems
from workload.recipes import UNBLANKED
from workload.registry import Tables, query

CHAMPIONSHIPS = "salesforce-championships_salesforce-championships-"
REACH = "salesforce-reach_salesforce-reach-"
MAIL = "iterable_api_iterable_api_"

_CONTACT = """select c_custkey as id, 'F' as firstname, c_name as lastname, concat('u', cast(c_custkey as string), '@x.org') as email,
  concat(c_mktsegment, ',Unit ', cast(c_nationkey as string)) as mailingstreet, c_mktsegment as mailingcity, 'S' as mailingstate,
  '1' as mailingpostalcode, 'US' as mailingcountry, cast(null as string) as birthdate, 'x' as gender__c from {customer}"""
_DEALS = """select o_orderkey as id, o_totalprice as amount, cast(o_orderdate as date) as closedate,
  case when o_orderkey % 9 = 0 then null else o_custkey end as contactid, o_orderkey % 30 as championship__c,
  case when o_orderstatus = 'F' then 'Won' else 'Open' end as stagename, o_orderstatus = 'F' as iswon from {orders}"""
_MAILED = """select concat('u', cast(user_id as string), '@x.org') as email, user_id % 60 as campaignId, user_id % 7 as messageId,
  event_id as createdAt, concat('10.0.0.', cast(user_id as string)) as ip, concat('/p/', cast(event_id as string)) as url,
  'proxy' as proxySource from {events} where event_type = """

#: Raw tables under the names the systems use, as SQL that Spark and the oracle both run.
RAW = {
    "ticket_registry_registrysubmission": """select case when c_custkey % 5 = 0 then null
        else concat('t', cast(c_custkey as string), '@x.org') end as email, 'Tom' as first, c_name as last,
        cast(c_nationkey as string) as zipcode from {customer}""",
    "golf_genius_golf_genius_master_roster": """select c_custkey as id, concat('g', cast(c_custkey as string), '@x.org') as email,
        'Gil' as first_name, c_name as last_name, c_acctbal as handicap_index, cast(null as date) as date_of_birth, 'm' as gender,
        c_mktsegment as team_name, n_name as address_1, cast(null as string) as address_2, n_name as city, 'S' as state, 'US' as country,
        '1' as zip_postal_code from {customer} join {nation} on c_nationkey = n_nationkey""",
    "splash_that_splash_that_group_contacts": """select o_orderkey as id, 'Sam' as first_name, cast(o_custkey as string) as last_name,
        concat('s', cast(o_custkey as string), '@x.org') as primary_email, cast(o_orderdate as date) as date_rsvped,
        o_orderstatus = 'F' as attending, o_orderstatus = 'O' as checked_in, false as vip, true as waitlist,
        case when o_orderkey % 8 = 0 then null else o_orderkey % 30 end as event_id from {orders}""",
    "splash_that_splash_that_events": """select n_nationkey as id, n_name as title, 'd' as description, date '2024-03-07' as event_start,
        date '2024-03-08' as event_end, 'hall' as venue_name, true as rsvp_open, cast(null as date) as rsvp_closed_at, false as wait_list,
        n_name as address, n_name as city, 'S' as state, '1' as zip_code, 'US' as country from {nation}""",
    "axs_customers": """select c_custkey as customer_unique_id, 'Axl' as first_name, c_name as last_name, concat('a', cast(c_custkey as string), '@x.org') as email,
        c_mktsegment as address1, cast(null as string) as address2, 'C' as city, 'S' as state, '1' as zip, 'US' as country,
        cast(null as date) as birthday, true as is_opt_in from {customer}""",
    "axs_orders": """select o_orderkey as order_unique_id, o_totalprice as order_amount, cast(o_orderdate as date) as created_on,
        case when o_orderkey % 6 = 0 then -1 else o_custkey end as customer_unique_id from {orders}""",
    "axs_payments": """select o_orderpriority as address1, cast(null as string) as address2, 'P' as city, 'S' as state, '1' as zip, 'US' as country,
        o_orderkey as order_unique_id from {orders} where o_orderkey % 3 <> 0
        union all select concat('0', o_orderpriority), null, 'P', 'S', '1', 'US', o_orderkey from {orders} where o_orderkey % 5 = 0""",
    "axs_order_tickets": """select l_partkey as product_unique_id, l_extendedprice as amount_gross, l_suppkey % 30 as event_unique_id,
        l_orderkey as order_unique_id from {lineitem}""",
    "axs_events": """select n_nationkey as event_unique_id, n_name as event_name, date '2024-03-07' as event_datetime,
        n_regionkey + 1 as venue_unique_id from {nation}""",
    "axs_venues": """select r_regionkey as venue_unique_id, r_name as venue_name, 'V' as venue_address1, cast(null as string) as venue_address2,
        'C' as venue_city, 'S' as venue_state, '1' as venue_zip, 'US' as venue_country from {region}""",
    "salesforce-career-services_salesforce-career-services-contact": """select c_custkey as Id,
        concat(' k', cast(c_custkey as string), '@x.org', chr(9)) as Email, c_phone_ as Phone, cast(null as string) as HomePhone, c_phone_ as MobilePhone,
        'Kim' as FirstName, c_name as LastName, cast(null as date) as Birthdate, 'f' as Gender__c,
        case when c_custkey % 2 = 0 then concat(c_mktsegment, ',Unit 2') else c_mktsegment end as MailingStreet, 'C' as MailingCity, 'S' as MailingState,
        'US' as MailingCountry, '1' as MailingPostalCode from (select *, concat('555', cast(c_custkey as string)) as c_phone_ from {customer})""",
    CHAMPIONSHIPS + "opportunity": _DEALS,
    CHAMPIONSHIPS + "contact": _CONTACT,
    CHAMPIONSHIPS + "opportunitylineitem": """select cast(l_partkey as string) as name, l_extendedprice as listPrice, l_partkey as pricebookentryid,
        l_quantity as quantity, l_orderkey as OpportunityId from {lineitem}""",
    CHAMPIONSHIPS + "championship": """select n_name as name, 'Club' as club_name__c, 'Street' as street__c, 'C' as city__c, 'S' as state__c, '1' as zip_postal_code__c,
        'US' as country__c, date '2024-03-07' as start_date__c, date '2024-03-08' as end_date__c, n_nationkey as id from {nation}""",
    REACH + "opportunity": _DEALS,
    REACH + "contact": _CONTACT,
    "coach_tools_contacts": """select c_custkey as id, concat(' c', cast(c_custkey % 500 as string), '@x.org ') as email, '555' as phone_number,
        c_mktsegment as address1, cast(null as string) as address2, 'C' as city, 'S' as state, '1' as zip from {customer}""",
    "coach_tools_students": """select concat('St', cast(s_suppkey as string)) as first_name, s_name as last_name, s_suppkey as id,
        concat('c', cast(s_suppkey as string), '@x.org') as email from {supplier}""",
    "coach_tools_coach_connections": "select s_suppkey as student_id from {supplier} where s_suppkey % 3 <> 0",
    "coach_tools_demographic_profiles": "select s_suppkey as student_id, case when s_suppkey % 2 = 0 then 'f' else 'm' end as gender from {supplier}",
    "coach_tools_representatives": """select c_custkey as contact_id, case when c_custkey % 4 = 0 then 'PARENT' when c_custkey % 4 = 1 then 'COACH' end
        as relationship_type from {customer} where c_custkey % 5 <> 0""",
    "ccms_cen_cust_mast": "select c_custkey as cust_id, 'Cc' as first_nm, c_name as last_nm, cast(null as date) as birth_dt, 'x' as sex from {customer}",
    "ccms_cen_cust_addr": """select c_custkey as cust_id, c_mktsegment as street1, cast(null as string) as street2, 'three' as street3, cast(null as string) as street4,
        'C' as city_nm, 'S' as state_cd, 'US' as country_nm, '1' as postal_cd from {customer} where c_custkey % 2 = 0""",
    "ccms_cen_cust_cyber": "select c_custkey as cust_id, concat(' y', cast(c_custkey as string), '@x.org') as cyber_txt from {customer} where c_custkey % 3 = 0",
    "ccms_cen_cust_phone": "select c_custkey as cust_id, '555' as phone_num from {customer} where c_custkey % 5 <> 0",
    "ccms_evt_reg_hdr": "select c_custkey as cust_id, c_custkey * 10 as REGI_SERNO from {customer} where c_custkey % 7 <> 0",
    "ccms_evt_reg_tourn_info": "select c_custkey * 10 as REGI_SERNO, c_mktsegment as home_course, c_acctbal as handicap from {customer} where c_custkey % 11 <> 0",
    MAIL + "users": """select concat('u', cast(c_custkey as string), '@x.org') as email, 'Ian' as firstName, c_name as lastName, cast(null as string) as address1,
        cast(null as string) as address2, 'C' as city, 'S' as stateRegion, 'US' as country, '1' as postalCode, c_acctbal as totalTicketSpend,
        cast(null as string) as signupDate, 'web' as signupSource from {customer}""",
    MAIL + "email_clicks": _MAILED + "'click'",
    MAIL + "email_opens": _MAILED + "'view'",
    MAIL + "email_subscribes": """select concat('u', cast(user_id as string), '@x.org') as email, event_id as createdAt,
        array(user_id % 20, user_id % 3 + 20) as emailListIds from {events} where event_type = 'signup'""",
    MAIL + "email_unsubscribes": """select concat('u', cast(user_id as string), '@x.org') as email, event_id as createdAt,
        array(user_id % 30) as emailListIds from {events} where event_type = 'purchase'""",
    MAIL + "campaigns": """select p_partkey as id, p_name as name, p_size as templateId, 'Email' as messageMedium, 'me' as createdByUserId,
        'me' as updatedByUserId, 'Done' as campaignState, 'Blast' as type, array(p_partkey % 40, p_partkey % 2 + 40) as listIds
        from {part}""",
    MAIL + "lists": "select n_nationkey as id, n_name as name, 'd' as description, 'Standard' as listType from {nation}",
    MAIL + "message_types": "select r_regionkey as id, r_name as name, 'opt' as subscriptionPolicy from {region}",
}


class RawTables(Mapping):
    """Raw frames by name, each made when it is asked for."""

    def __init__(self, t: Tables):
        self.t = t

    def __getitem__(self, name: str) -> DataFrame:
        return self.t.once(name, lambda: self.t.sql(RAW[name]))

    def __iter__(self) -> Iterator[str]:
        return iter(RAW)

    def __len__(self) -> int:
        return len(RAW)


def raw(name: str) -> str:
    return "(" + RAW[name] + ")"


@query(
    f"""select email, first as name_first, last as name_last, zipcode as postal_code, 'ticket_registry' as source_system
    from {raw('ticket_registry_registrysubmission')} where email is not null"""
)
def ticket_view(t: Tables) -> DataFrame:
    return systems.ticket_registry(RawTables(t))


@query(
    f"""select id as source_consumer_id, email, first_name as name_first, last_name as name_last, handicap_index as golf_handicap,
      team_name as team, address_1, city, zip_postal_code as postal_code, 'golf_genius' as source_system
    from {raw('golf_genius_golf_genius_master_roster')}"""
)
def roster_view(t: Tables) -> DataFrame:
    names = "source_consumer_id email name_first name_last golf_handicap team address_1 city postal_code source_system"
    return systems.golf_genius(RawTables(t)).select(*names.split())


@query(
    f"""select c.id as source_consumer_id, primary_email as email, attending, checked_in, waitlist as on_waitlist, event_id,
      e.id as source_event_id, title as event_name, wait_list as has_waitlist, e.city
    from {raw('splash_that_splash_that_group_contacts')} c left join {raw('splash_that_splash_that_events')} e on c.event_id = e.id"""
)
def splash_view(t: Tables) -> DataFrame:
    names = "source_consumer_id email attending checked_in on_waitlist event_id source_event_id event_name has_waitlist city"
    return systems.splash_that(RawTables(t)).select(*names.split())


@query(
    f"""select c.customer_unique_id as source_consumer_id, o.order_unique_id as source_order_id, p.address1 as billing_address_1,
      k.product_unique_id as source_product_id, k.amount_gross as unit_price, e.event_name, v.venue_name
    from {raw('axs_customers')} c left join {raw('axs_orders')} o on c.customer_unique_id = o.customer_unique_id
    left join (select order_unique_id, min(address1) as address1 from {raw('axs_payments')} group by 1) p on o.order_unique_id = p.order_unique_id
    left join {raw('axs_order_tickets')} k on o.order_unique_id = k.order_unique_id
    left join {raw('axs_events')} e on k.event_unique_id = e.event_unique_id
    left join {raw('axs_venues')} v on e.venue_unique_id = v.venue_unique_id"""
)
def ticketing_lines(t: Tables) -> DataFrame:
    names = "source_consumer_id source_order_id billing_address_1 source_product_id unit_price event_name venue_name"
    return systems.axs(RawTables(t))["lines"].select(*names.split())


@query(
    f"""select p.order_unique_id as source_order_id, p.address1 as billing_address_1 from {raw('axs_payments')} p
    join {raw('axs_orders')} o on p.order_unique_id = o.order_unique_id
    where o.customer_unique_id in (select customer_unique_id from {raw('axs_customers')})"""
)
def ticketing_billing(t: Tables) -> DataFrame:
    """Every payment address of known customers' orders."""
    return systems.axs(RawTables(t))["billing"].select(F.col("_order").alias("source_order_id"), "billing_address_1")


@query(
    f"""select Id as source_consumer_id, {UNBLANKED % 'Email'} as email, Phone as phone, MobilePhone as mobile_phone, LastName as name_last,
      string_split(MailingStreet, ',')[1] as address_1, string_split(MailingStreet, ',')[2] as address_2
    from {raw('salesforce-career-services_salesforce-career-services-contact')}"""
)
def career_view(t: Tables) -> DataFrame:
    names = "source_consumer_id email phone mobile_phone name_last address_1 address_2"
    return systems.salesforce_career_services(RawTables(t)).select(*names.split())


@query(
    f"""select d.id as source_order_id, d.amount as total, c.email, i.pricebookentryid as source_product_id, i.quantity, h.name as event_name
    from (select * from {raw(CHAMPIONSHIPS + 'opportunity')} where stagename = 'Won') d
    left join {raw(CHAMPIONSHIPS + 'contact')} c on d.contactid = c.id
    left join {raw(CHAMPIONSHIPS + 'opportunitylineitem')} i on d.id = i.OpportunityId
    left join {raw(CHAMPIONSHIPS + 'championship')} h on d.championship__c = h.id"""
)
def championships_view(t: Tables) -> DataFrame:
    names = "source_order_id total email source_product_id quantity event_name"
    return systems.salesforce_championships(RawTables(t)).select(*names.split())


@query(
    f"""select d.id as source_order_id, d.amount as total, c.id as source_consumer_id, c.email, string_split(c.mailingstreet, ',')[2] as address_2
    from (select * from {raw(REACH + 'opportunity')} where iswon) d left join {raw(REACH + 'contact')} c on d.contactid = c.id"""
)
def reach_view(t: Tables) -> DataFrame:
    return systems.salesforce_reach(RawTables(t)).select("source_order_id", "total", "source_consumer_id", "email", "address_2")


@query(
    f"""select c.id as source_consumer_id, trim(c.email) as email, s.first_name as name_first, p.gender,
      coalesce(r.relationship_type = 'PARENT', false) as parent_of_junior
    from {raw('coach_tools_contacts')} c left join {raw('coach_tools_students')} s on trim(c.email) = trim(s.email)
    left join {raw('coach_tools_coach_connections')} k on s.id = k.student_id
    left join {raw('coach_tools_demographic_profiles')} p on k.student_id = p.student_id
    left join {raw('coach_tools_representatives')} r on c.id = r.contact_id"""
)
def coach_view(t: Tables) -> DataFrame:
    return systems.coach_tools(RawTables(t)).select("source_consumer_id", "email", "name_first", "gender", "parent_of_junior")


@query(
    f"""select m.cust_id as source_consumer_id, a.street1 as address_1, a.street3 as address_3, trim(y.cyber_txt) as email, p.phone_num as phone,
      i.home_course as course_home, i.handicap as golf_handicap
    from {raw('ccms_cen_cust_mast')} m left join {raw('ccms_cen_cust_addr')} a on m.cust_id = a.cust_id
    left join {raw('ccms_cen_cust_cyber')} y on a.cust_id = y.cust_id left join {raw('ccms_cen_cust_phone')} p on y.cust_id = p.cust_id
    left join {raw('ccms_evt_reg_hdr')} h on p.cust_id = h.cust_id left join {raw('ccms_evt_reg_tourn_info')} i on h.REGI_SERNO = i.REGI_SERNO"""
)
def legacy_view(t: Tables) -> DataFrame:
    """A step matches only where the step before it did."""
    names = "source_consumer_id address_1 address_3 email phone course_home golf_handicap"
    return systems.ccms(RawTables(t)).select(*names.split())


_ACTED = f"""(select distinct email, campaignId, 'email_click' as marketing_action_type, messageId, createdAt from {raw(MAIL + 'email_clicks')}
  union select distinct email, campaignId, 'email_open', messageId, createdAt from {raw(MAIL + 'email_opens')})"""
_RUN = f"(select id, name, unnest(listIds) as list from ({RAW[MAIL + 'campaigns'].replace('array(p_partkey % 40, p_partkey % 2 + 40)', '[p_partkey % 40, p_partkey % 2 + 40]')}))"


@query(
    f"""select u.email, a.marketing_action_type, cast(a.createdAt as varchar) as created_at, c.id as source_campaign_id, l.id as list_id, m.name as message_name
    from {raw(MAIL + 'users')} u left join {_ACTED} a on u.email = a.email
    full outer join {_RUN} c on a.campaignId = c.id
    full outer join {raw(MAIL + 'lists')} l on c.list = l.id
    left join {raw(MAIL + 'message_types')} m on a.messageId = m.id"""
)
def click_log(t: Tables) -> DataFrame:
    """Users with their actions, all campaigns and all lists: both full outer joins."""
    names = "email marketing_action_type created_at source_campaign_id list_id message_name"
    return systems.click_history(RawTables(t)).select(*names.split())


_LISTED = f"""(select distinct email, 'email_subscribe' as kind, createdAt, unnest([user_id % 20, user_id % 3 + 20]) as list
    from (select concat('u', cast(user_id as varchar), '@x.org') as email, event_id as createdAt, user_id from {{events}} where event_type = 'signup')
  union select distinct email, 'email_unsubscribe', createdAt, user_id % 30
    from (select concat('u', cast(user_id as varchar), '@x.org') as email, event_id as createdAt, user_id from {{events}} where event_type = 'purchase'))"""


@query(
    f"""select l.id as list_id, l.name as list_name, s.kind as marketing_action_type, cast(s.createdAt as varchar) as created_at, s.email, u.lastName as name_last
    from {raw(MAIL + 'lists')} l left join {_LISTED} s on l.id = s.list left join {raw(MAIL + 'users')} u on s.email = u.email"""
)
def subscription_log(t: Tables) -> DataFrame:
    """Lists with who joined or left them."""
    names = "list_id list_name marketing_action_type created_at email name_last"
    return systems.subscription_history(RawTables(t)).select(*names.split())
