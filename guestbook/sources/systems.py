"""Views of the source systems, in the datamart's column names.

Each function takes the trusted tables by frame name and returns lazy frames. Table names,
source column names and the provenance words are fixed values.

A view never multiplies two independent one-to-many branches of the same key (addresses by
order lines, tickets by payments): it returns one frame per branch instead.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from guestbook.functions.text import street_line, trim_blank
from guestbook.operators.conform import union_all
from guestbook.operators.dedupe import keep_one
from guestbook.operators.joins import full_outer, join_on, left_chain

Tables = Mapping[str, DataFrame]


def _tagged(df: DataFrame, system: str) -> DataFrame:
    return df.withColumn("source_system", F.lit(system))


def _pick(df: DataFrame, **columns) -> DataFrame:
    """Select ``target=source`` pairs, the source a name or an expression."""
    return df.select(*[(F.col(s) if isinstance(s, str) else s).alias(t) for t, s in columns.items()])


def ticket_registry(t: Tables) -> DataFrame:
    rows = t["ticket_registry_registrysubmission"].where(F.col("email").isNotNull())
    return _tagged(_pick(rows, email="email", name_first="first", name_last="last", postal_code="zipcode"), "ticket_registry")


def golf_genius(t: Tables) -> DataFrame:
    view = _pick(
        t["golf_genius_golf_genius_master_roster"],
        source_consumer_id="id",
        email="email",
        name_first="first_name",
        name_last="last_name",
        golf_handicap="handicap_index",
        birth_date="date_of_birth",
        gender="gender",
        team="team_name",
        address_1="address_1",
        address_2="address_2",
        city="city",
        state_region="state",
        country="country",
        postal_code="zip_postal_code",
    )
    return _tagged(view, "golf_genius")


def splash_that(t: Tables) -> DataFrame:
    """Contacts of events, each with its event when there is one."""
    contacts = _pick(
        t["splash_that_splash_that_group_contacts"],
        source_consumer_id="id",
        name_first="first_name",
        name_last="last_name",
        email="primary_email",
        date_rsvped="date_rsvped",
        attending="attending",
        checked_in="checked_in",
        vip="vip",
        on_waitlist="waitlist",
        event_id="event_id",
    )
    events = _pick(
        t["splash_that_splash_that_events"],
        source_event_id="id",
        event_name="title",
        event_description="description",
        start_time="event_start",
        end_time="event_end",
        venue_name="venue_name",
        rsvp_open="rsvp_open",
        rsvp_closed_at="rsvp_closed_at",
        has_waitlist="wait_list",
        address_1="address",
        city="city",
        state_region="state",
        postal_code="zip_code",
        country="country",
        _event="id",
    )
    return _tagged(join_on(contacts, events, equal=[("event_id", "_event")], how="left"), "splash_that")


def axs(t: Tables) -> dict[str, DataFrame]:
    """Ticketing. ``people``: customers; ``lines``: their orders by ticket, with event, venue
    and one payment address; ``billing``: every payment address of those orders."""
    customers = _pick(
        t["axs_customers"],
        source_consumer_id="customer_unique_id",
        name_first="first_name",
        name_last="last_name",
        email="email",
        address_1="address1",
        address_2="address2",
        city="city",
        state_region="state",
        postal_code="zip",
        country="country",
        birth_date="birthday",
        email_opt_in="is_opt_in",
    )
    orders = _pick(
        t["axs_orders"],
        source_order_id="order_unique_id",
        total="order_amount",
        order_date="created_on",
        _customer="customer_unique_id",
    )
    payments = _pick(
        t["axs_payments"],
        billing_address_1="address1",
        billing_address_2="address2",
        billing_city="city",
        billing_state_region="state",
        billing_postal_code="zip",
        billing_country="country",
        _order="order_unique_id",
    )
    tickets = _pick(
        t["axs_order_tickets"],
        source_product_id="product_unique_id",
        unit_price="amount_gross",
        event_key="event_unique_id",
        _order="order_unique_id",
    )
    events = _pick(
        t["axs_events"],
        source_event_id="event_unique_id",
        event_name="event_name",
        event_datetime="event_datetime",
        venue_key="venue_unique_id",
        _event="event_unique_id",
    )
    venues = _pick(
        t["axs_venues"],
        venue_name="venue_name",
        venue_address_1="venue_address1",
        venue_address_2="venue_address2",
        venue_city="venue_city",
        venue_state_region="venue_state",
        venue_postal_code="venue_zip",
        venue_country="venue_country",
        _venue="venue_unique_id",
    )
    lines = left_chain(
        customers,
        [
            (orders, [("source_consumer_id", "_customer")]),
            (keep_one(payments, ["_order"]), [("source_order_id", "_order")]),
            (tickets, [("source_order_id", "_order")]),
            (events, [("event_key", "_event")]),
            (venues, [("venue_key", "_venue")]),
        ],
    )
    placed = join_on(orders, customers, equal=[("_customer", "source_consumer_id")], how="left_semi")
    billing = join_on(payments, placed, equal=[("_order", "source_order_id")], how="left_semi")
    return {
        "people": _tagged(customers, "axs"),
        "lines": _tagged(lines, "axs"),
        "billing": _tagged(billing, "axs"),
    }


def axs_payers(t: Tables) -> DataFrame:
    """Customers with every payment address of their orders."""
    view = axs(t)
    orders = _pick(t["axs_orders"], _order="order_unique_id", _customer="customer_unique_id")
    names = view["people"].select("source_consumer_id", "name_first", "name_last", "email")
    bought = join_on(names, orders, equal=[("source_consumer_id", "_customer")])
    return join_on(bought, view["billing"].withColumnRenamed("_order", "_paid"), equal=[("_order", "_paid")])


def salesforce_career_services(t: Tables) -> DataFrame:
    view = _pick(
        t["salesforce-career-services_salesforce-career-services-contact"],
        source_consumer_id="Id",
        email=trim_blank("Email"),
        phone="Phone",
        home_phone="HomePhone",
        mobile_phone="MobilePhone",
        name_first="FirstName",
        name_last="LastName",
        birth_date="Birthdate",
        gender="Gender__c",
        address_1=street_line("MailingStreet", 0),
        address_2=street_line("MailingStreet", 1),
        city="MailingCity",
        state_region="MailingState",
        country="MailingCountry",
        postal_code="MailingPostalCode",
    )
    return _tagged(view, "salesforce_career_services")


def _crm_contacts(contacts: DataFrame) -> DataFrame:
    return _pick(
        contacts,
        source_consumer_id="id",
        name_first="firstname",
        name_last="lastname",
        email="email",
        address_1=street_line("mailingstreet", 0),
        address_2=street_line("mailingstreet", 1),
        city="mailingcity",
        state_region="mailingstate",
        postal_code="mailingpostalcode",
        country="mailingcountry",
        birth_date="birthdate",
        gender="gender__c",
        _contact="id",
    )


def salesforce_championships(t: Tables) -> DataFrame:
    """Won deals with their contact, items and championship.

    The deal drives: contacts without a won deal, and leads, which never have one, do not
    appear, and a deal without a contact does.
    """
    prefix = "salesforce-championships_salesforce-championships-"
    won = _pick(
        t[prefix + "opportunity"].where(F.col("stagename") == "Won"),
        source_order_id="id",
        total="amount",
        order_date="closedate",
        contact_key="contactid",
        championship_key="championship__c",
    )
    contacts = _crm_contacts(t[prefix + "contact"])
    items = _pick(
        t[prefix + "opportunitylineitem"],
        product_name="name",
        unit_price="listPrice",
        source_product_id="pricebookentryid",
        quantity="quantity",
        _deal="OpportunityId",
    )
    championships = _pick(
        t[prefix + "championship"],
        event_name="name",
        venue_name="club_name__c",
        venue_address_1="street__c",
        venue_city="city__c",
        venue_state_region="state__c",
        venue_postal_code="zip_postal_code__c",
        venue_country="country__c",
        start_time="start_date__c",
        end_time="end_date__c",
        _championship="id",
    )
    view = left_chain(
        won,
        [
            (contacts, [("contact_key", "_contact")]),
            (items, [("source_order_id", "_deal")]),
            (championships, [("championship_key", "_championship")]),
        ],
    )
    return _tagged(view, "salesforce_championships")


def salesforce_organizations(t: Tables) -> DataFrame:
    """Contacts with the organisation they belong to."""
    prefix = "salesforce-championships_salesforce-championships-"
    contacts = _pick(
        t[prefix + "contact"], source_consumer_id="id", role="title", account_key="accountid"
    )
    accounts = _pick(t[prefix + "account"], org_name="name", org_parent_id="parentid", _account="id")
    return join_on(contacts, accounts, equal=[("account_key", "_account")], how="left")


def salesforce_reach(t: Tables) -> DataFrame:
    prefix = "salesforce-reach_salesforce-reach-"
    won = _pick(
        t[prefix + "opportunity"].where(F.col("iswon").cast("string") == "true"),
        source_order_id="id",
        total="amount",
        order_date="closedate",
        contact_key="contactid",
    )
    contacts = _crm_contacts(t[prefix + "contact"])
    return _tagged(join_on(won, contacts, equal=[("contact_key", "_contact")], how="left"), "salesforce_reach")


def coach_tools(t: Tables) -> DataFrame:
    contacts = _pick(
        t["coach_tools_contacts"],
        source_consumer_id="id",
        email=trim_blank("email"),
        phone="phone_number",
        address_1="address1",
        address_2="address2",
        city="city",
        state_region="state",
        postal_code="zip",
    )
    students = _pick(
        t["coach_tools_students"],
        name_first="first_name",
        name_last="last_name",
        student_key="id",
        _email=trim_blank("email"),
    )
    connections = _pick(t["coach_tools_coach_connections"], profile_key="student_id", _student="student_id")
    profiles = _pick(t["coach_tools_demographic_profiles"], gender="gender", _student="student_id")
    representatives = _pick(
        t["coach_tools_representatives"], relationship="relationship_type", _contact="contact_id"
    )
    view = left_chain(
        contacts,
        [
            (students, [("email", "_email")]),
            (connections, [("student_key", "_student")]),
            (profiles, [("profile_key", "_student")]),
            (representatives, [("source_consumer_id", "_contact")]),
        ],
    )
    parent = F.coalesce(F.col("relationship") == "PARENT", F.lit(False))
    return _tagged(view.withColumn("parent_of_junior", parent), "coach_tools")


def ccms(t: Tables, linked: bool = True) -> DataFrame:
    """Legacy people. All steps but the last use the person's own id, so they share a shuffle.

    ``linked`` keeps the source's rule that a step only matches where the step before it
    did: no address, then no email or phone either.
    """
    master = _pick(
        t["ccms_cen_cust_mast"],
        source_consumer_id="cust_id",
        name_first="first_nm",
        name_last="last_nm",
        birth_date="birth_dt",
        gender="sex",
    )
    steps = [
        _pick(
            t["ccms_cen_cust_addr"],
            address_1="street1",
            address_2="street2",
            address_3="street3",
            address_4="street4",
            city="city_nm",
            state_region="state_cd",
            country="country_nm",
            postal_code="postal_cd",
            _id="cust_id",
        ),
        _pick(t["ccms_cen_cust_cyber"], email=trim_blank("cyber_txt"), _id="cust_id"),
        _pick(t["ccms_cen_cust_phone"], phone="phone_num", _id="cust_id"),
        _pick(t["ccms_evt_reg_hdr"], registration="REGI_SERNO", _id="cust_id"),
    ]
    view, previous = master, None
    for i, step in enumerate(steps):
        marked = step.withColumn(f"_found{i}", F.lit(True))
        condition = F.col(previous) if linked and previous else None
        view = join_on(view, marked, equal=[("source_consumer_id", "_id")], how="left", when=condition)
        previous = f"_found{i}"
    tournaments = _pick(
        t["ccms_evt_reg_tourn_info"], course_home="home_course", golf_handicap="handicap", _registration="REGI_SERNO"
    )
    view = join_on(view, tournaments, equal=[("registration", "_registration")], how="left")
    return _tagged(view.drop(*[f"_found{i}" for i in range(len(steps))]), "ccms")


# The stores and the name each goes by.
STORES = {"shopify_rc_shopify_rc": "ryder_cup", "shopify_pga_shopify_pga": "pga"}


def store_customers(customers: DataFrame, keep_homeless: bool = False) -> DataFrame:
    """One row per customer and address; customers without one only on request."""
    explode = F.explode_outer if keep_homeless else F.explode
    rows = customers.select("id", "email", "first_name", "last_name", explode("addresses").alias("home"))
    return _pick(
        rows,
        source_consumer_id="id",
        email="email",
        name_first="first_name",
        name_last="last_name",
        address_1="home.address1",
        address_2="home.address2",
        city="home.city",
        state_region="home.province",
        country="home.country",
        postal_code="home.zip",
    )


def store_orders(orders: DataFrame, instance: str, keep_itemless: bool = False) -> DataFrame:
    """One row per order line; orders without lines only on request.

    Takes the trusted table, whose billing address fields and shipping amount are lifted to
    the top.
    """
    explode = F.explode_outer if keep_itemless else F.explode
    rows = orders.select("*", explode("line_items").alias("line"))
    view = _pick(
        rows,
        source_order_id="id",
        order_date="processed_at",
        customer_key="customer.id",
        billing_address_1="address1",
        billing_address_2="address2",
        billing_city="city",
        billing_state_region="province",
        billing_postal_code="zip",
        billing_country="country",
        shipping_address_1="shipping_address.address1",
        shipping_address_2="shipping_address.address2",
        shipping_city="shipping_address.city",
        shipping_state_region="shipping_address.province",
        shipping_country="shipping_address.country",
        shipping_postal_code="shipping_address.zip",
        total_discount="total_discounts",
        total="total_price",
        total_tax="total_tax",
        total_ship="amount",
        total_gross_sub="subtotal_price",
        source_product_id="line.product_id",
        quantity="line.quantity",
        unit_price="line.price",
        item_discount="line.total_discount",
        product_name="line.title",
    )
    return view.withColumn("source_instance", F.lit(instance))


def shopify(t: Tables) -> dict[str, DataFrame]:
    """Stores. ``people``: customers by address; ``lines``: their order lines; ``instances``:
    the stores seen, null among them when some customer has not ordered."""
    people = union_all(store_customers(t[f"{name}_customers"]) for name in STORES)
    orders = union_all(store_orders(t[f"{name}_orders"], store) for name, store in STORES.items())
    buyers = people.select("source_consumer_id", "email", "name_first", "name_last").distinct()
    lines = join_on(buyers, orders, equal=[("source_consumer_id", "customer_key")])
    seen = orders.select(F.col("customer_key").alias("_customer"), "source_instance").distinct()
    instances = join_on(
        buyers.select("source_consumer_id"), seen, equal=[("source_consumer_id", "_customer")], how="left"
    )
    return {
        "people": _tagged(people, "shopify"),
        "lines": _tagged(lines, "shopify"),
        "instances": _tagged(instances.select("source_instance").distinct(), "shopify"),
    }


# --- email marketing -----------------------------------------------------------------------


def _users(t: Tables) -> DataFrame:
    return _pick(
        t["iterable_api_iterable_api_users"],
        email="email",
        name_first="firstName",
        name_last="lastName",
        address_1="address1",
        address_2="address2",
        city="city",
        state_region="stateRegion",
        country="country",
        postal_code="postalCode",
        total_ticket_spend="totalTicketSpend",
        sign_up_at="signupDate",
        sign_up_source="signupSource",
    )


def opens_and_clicks(t: Tables) -> DataFrame:
    def typed(table: str, kind: str, **present: str) -> DataFrame:
        columns = {
            "action_email": "email",
            "action_campaign": "campaignId",
            "marketing_action_type": F.lit(kind),
            "proxy_source": F.lit(None).cast("string"),
            "consumer_ip": F.lit(None).cast("string"),
            "click_url": F.lit(None).cast("string"),
            "message_key": "messageId",
            "created_at": F.col("createdAt").cast("string"),
        }
        return _pick(t[f"iterable_api_iterable_api_{table}"], **{**columns, **present})

    clicks = typed("email_clicks", "email_click", consumer_ip="ip", click_url="url")
    opens = typed("email_opens", "email_open", proxy_source="proxySource")
    return clicks.unionByName(opens).distinct()


def subscriptions(t: Tables) -> DataFrame:
    def typed(table: str, kind: str) -> DataFrame:
        rows = t[f"iterable_api_iterable_api_{table}"]
        return rows.select(
            F.col("email").alias("action_email"),
            F.lit(kind).alias("marketing_action_type"),
            F.col("createdAt").cast("string").alias("created_at"),
            F.explode("emailListIds").alias("list_key"),
        )

    return typed("email_subscribes", "email_subscribe").unionByName(
        typed("email_unsubscribes", "email_unsubscribe")
    ).distinct()


def _campaigns(t: Tables) -> DataFrame:
    """Campaigns by list; a campaign without lists does not appear."""
    rows = t["iterable_api_iterable_api_campaigns"].select("*", F.explode("listIds").alias("list_key"))
    return _pick(
        rows,
        source_campaign_id="id",
        campaign_name="name",
        template_id="templateId",
        message_medium="messageMedium",
        created_by_user_id="createdByUserId",
        updated_by_user_id="updatedByUserId",
        campaign_state="campaignState",
        campaign_type="type",
        campaign_list="list_key",
    )


def _lists(t: Tables) -> DataFrame:
    return _pick(
        t["iterable_api_iterable_api_lists"],
        list_id="id",
        list_name="name",
        list_description="description",
        list_type="listType",
    )


def _messages(t: Tables) -> DataFrame:
    return _pick(
        t["iterable_api_iterable_api_message_types"],
        message_name="name",
        message_subscription_policy="subscriptionPolicy",
        _message="id",
    )


def click_history(t: Tables) -> DataFrame:
    """Users with their actions, all campaigns and all lists: the full log of opens and clicks."""
    acted = join_on(_users(t), opens_and_clicks(t), equal=[("email", "action_email")], how="left")
    with_campaigns = full_outer(acted, _campaigns(t), [("action_campaign", "source_campaign_id")])
    with_lists = full_outer(with_campaigns, _lists(t), [("campaign_list", "list_id")])
    return join_on(with_lists, _messages(t), equal=[("message_key", "_message")], how="left")


def subscription_history(t: Tables) -> DataFrame:
    """Lists with their subscriptions and who made them."""
    listed = join_on(_lists(t), subscriptions(t), equal=[("list_id", "list_key")], how="left")
    users = _users(t).withColumnRenamed("email", "_email")
    joined = join_on(listed, users, equal=[("action_email", "_email")], how="left")
    return joined.withColumnRenamed("action_email", "email")


def campaign_click_history(t: Tables) -> DataFrame:
    """Draft shape of the log: campaigns first, then their actions, messages and users."""
    acted = join_on(_campaigns(t), opens_and_clicks(t), equal=[("source_campaign_id", "action_campaign")], how="left")
    named = join_on(acted, _messages(t), equal=[("message_key", "_message")], how="left")
    users = _users(t).withColumnRenamed("email", "_email")
    return join_on(named, users, equal=[("action_email", "_email")], how="left")


def campaign_subscription_history(t: Tables) -> DataFrame:
    """Draft shape: campaigns, their lists, the lists' subscriptions, and users."""
    listed = join_on(
        _campaigns(t),
        _lists(t).withColumn("_list", F.col("list_id")),
        equal=[("campaign_list", "_list")],
        how="left",
    )
    acted = join_on(listed, subscriptions(t), equal=[("list_id", "list_key")], how="left")
    users = _users(t).withColumnRenamed("email", "_email")
    return join_on(acted, users, equal=[("action_email", "_email")], how="left")


def iterable_api(t: Tables) -> dict[str, DataFrame]:
    """Email marketing. ``people``: users, and subscribers who are none; ``actions``: one row
    an action; ``campaigns``: campaigns by list; ``lists``."""
    users = _users(t)
    known = _campaigns(t).select(F.col("source_campaign_id").alias("_campaign")).distinct()
    known = known.withColumn("source_campaign_id", F.col("_campaign"))
    clicked = join_on(users, opens_and_clicks(t), equal=[("email", "action_email")])
    clicked = join_on(clicked, known, equal=[("action_campaign", "_campaign")], how="left")
    clicked = join_on(clicked, _messages(t), equal=[("message_key", "_message")], how="left")
    subscribed = subscription_history(t).where(F.col("marketing_action_type").isNotNull())
    actions = clicked.unionByName(subscribed, allowMissingColumns=True)
    people = users.unionByName(
        subscribed.where(F.col("email").isNotNull()).select(*users.columns).distinct()
    )
    campaigns = join_on(
        _campaigns(t), _lists(t).withColumn("_list", F.col("list_id")), equal=[("campaign_list", "_list")], how="left"
    )
    return {
        "people": _tagged(people, "iterable_api"),
        "actions": _tagged(actions, "iterable_api"),
        "campaigns": _tagged(campaigns, "iterable_api"),
        "lists": _tagged(_lists(t), "iterable_api"),
    }
