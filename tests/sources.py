"""A few rows of every source table, in the shape of the trusted zone."""

from __future__ import annotations

import datetime as dt

ADDRESS = "address1: string, address2: string, city: string, province: string, country: string, zip: string"

TABLES = {
    "ticket_registry_registrysubmission": (
        "email string, first string, last string, zipcode string",
        [("tina@x.com", "Tina", "Ray", "10001"), (None, "No", "Mail", "10002")],
    ),
    "golf_genius_golf_genius_master_roster": (
        "id int, email string, first_name string, last_name string, handicap_index string, country string, "
        "state string, zip_postal_code string, date_of_birth string, gender string, address_1 string, "
        "address_2 string, city string, team_name string",
        [
            (1, "gus@x.com", "Gus", None, "12.7", "US", "FL", "33000", "1990-02-03", "M", "1 Main", "null", "Miami", "A"),
            (2, "ann@x.com", "Ann", "Lee", "x", "US", "NC", "27000", "bad", "F", "2 Oak", "Apt 1", "Cary", "B"),
            (3, None, "Nobody", "Else", "1", "null", None, None, None, None, None, None, None, None),
        ],
    ),
    "splash_that_splash_that_group_contacts": (
        "id int, event_id int, first_name string, last_name string, primary_email string, date_rsvped string, "
        "attending string, checked_in string, vip string, waitlist string",
        [
            (11, 501, "Ann", "Lee", "ann@x.com", "2023-01-02 03:04:05", "true", "false", "no", None),
            (12, 501, "Bob", "Fox", "bob@x.com", None, "false", None, "yes", "true"),
            (13, 999, "Cal", "Roe", "cal@x.com", None, None, None, None, None),
        ],
    ),
    "splash_that_splash_that_events": (
        "id int, title string, description string, event_start string, event_end string, venue_name string, "
        "rsvp_open string, wait_list string, rsvp_closed_at string, address string, city string, state string, "
        "zip_code string, country string",
        [(501, "Gala", "Fun", "2023-05-01 18:00:00", "2023-05-01 22:00:00", "Hall", "true", "false", None,
          "9 Hill", "Cary", "NC", "27000", "US")],
    ),
    "axs_customers": (
        "customer_unique_id string, first_name string, last_name string, email string, address1 string, "
        "address2 string, city string, state string, zip string, country string, birthday string, is_opt_in string",
        [
            ("c1", "Ann", "Lee", "ann@x.com", "2 Oak", "Apt 1", "Cary", "NC", "27000", "US", "1980-01-01", "true"),
            ("c2", "Dan", "Poe", "dan@x.com", "3 Elm", "Apt 9", "Reno", "NV", "89000", "US", None, None),
            ("c3", "Eve", "Kay", None, "4 Fir", None, "Troy", "NY", "12000", "US", None, None),
        ],
    ),
    "axs_orders": (
        "order_unique_id string, customer_unique_id string, order_amount string, created_on string",
        [("o1", "c1", "50.5", "2023-04-01 00:00:00"), ("o2", "c3", "10", "2023-04-02 00:00:00"), ("o9", "zz", "1", None)],
    ),
    "axs_payments": (
        "order_unique_id string, address1 string, address2 string, city string, state string, zip string, country string",
        [
            ("o1", "2 Oak", "Apt 1", "Cary", "NC", "27000", "US"),
            ("o1", "7 Bay", "Apt 2", "Cary", "NC", "27001", "US"),
            ("o9", "lost", "lost", "lost", "lost", "lost", "lost"),
        ],
    ),
    "axs_order_tickets": (
        "order_unique_id string, product_unique_id string, amount_gross string, event_unique_id string",
        [("o1", "p1", "25.25", "e1"), ("o1", "p2", "25.25", "e1"), ("o2", "p1", "10", "e2")],
    ),
    "axs_events": (
        "event_unique_id string, event_name string, event_datetime string, venue_unique_id string",
        [("e1", "Open", "2023-06-10 09:00:00", "v1"), ("e2", None, "2023-07-01 09:00:00", "v1")],
    ),
    "axs_venues": (
        "venue_unique_id string, venue_name string, venue_address1 string, venue_address2 string, venue_city string, "
        "venue_state string, venue_zip string, venue_country string",
        [("v1", "Links", "1 Links", None, "Troon", "SC", "KA10", "GB")],
    ),
    "salesforce-career-services_salesforce-career-services-contact": (
        "Id string, Email string, Phone string, HomePhone string, MobilePhone string, FirstName string, "
        "LastName string, Birthdate string, MailingStreet string, MailingCity string, MailingState string, "
        "MailingCountry string, MailingPostalCode string, Gender__c string",
        [
            ("s1", " \tann@x.com\t", "(571) 333-1112", None, None, "Ann", "Lee", None, "2 Oak, Apt 1", "Cary", "NC", "US",
             "27000", "F"),
            ("s2", "sue@x.com", "57133311$2 x", None, None, "Sue", "May", None, "8 Ash", "Bonn", None, "DE", "53111", None),
        ],
    ),
    "salesforce-championships_salesforce-championships-contact": (
        "id string, firstname string, lastname string, email string, mailingstreet string, mailingcity string, "
        "mailingstate string, mailingpostalcode string, mailingcountry string, title string, birthdate string, "
        "gender__c string, accountid string",
        [
            ("k1", "Kim", "Orr", "kim@x.com", "5 Bay, Dock 2", "Erie", "PA", "16000", "US", "CEO", None, "F", "a1"),
            ("k2", "Lou", "Nye", "lou@x.com", "6 Bay", "Erie", "PA", "16000", "US", None, None, None, None),
        ],
    ),
    "salesforce-championships_salesforce-championships-account": (
        "id string, name string, parentid string", [("a1", "Orr Inc", None)],
    ),
    "salesforce-championships_salesforce-championships-opportunity": (
        "id string, contactid string, stagename string, amount string, closedate string, championship__c string",
        [
            ("w1", "k1", "Won", "1000", "2023-02-01", "h1"),
            ("w2", "k2", "Lost", "5", "2023-02-01", "h1"),
            ("w3", None, "Won", "7", "2023-02-02", "h2"),
        ],
    ),
    "salesforce-championships_salesforce-championships-opportunitylineitem": (
        "OpportunityId string, name string, listPrice string, pricebookentryid string, quantity string",
        [("w1", "Suite", "500", "pb1", "2")],
    ),
    "salesforce-championships_salesforce-championships-championship": (
        "id string, name string, start_date__c string, end_date__c string, street__c string, city__c string, "
        "state__c string, zip_postal_code__c string, country__c string, club_name__c string",
        [
            ("h1", "Open", "2023-06-10", "2023-06-13", "1 Links", "Troon", "SC", "KA10", "GB", "Links"),
            ("h2", "Cup", "2024-06-10", "2024-06-13", None, None, None, None, None, None),
        ],
    ),
    "salesforce-reach_salesforce-reach-opportunity": (
        "id string, contactid string, iswon boolean, amount string, closedate string",
        [("r1", "q1", True, "20", "2023-01-01"), ("r2", "q1", False, "30", "2023-01-02")],
    ),
    "salesforce-reach_salesforce-reach-contact": (
        "id string, firstname string, lastname string, email string, mailingstreet string, mailingcity string, "
        "mailingstate string, mailingpostalcode string, mailingcountry string, birthdate string, gender__c string",
        [("q1", "Quin", "Ivy", "quin@x.com", "1 Pier", "Bath", "ME", "04530", "US", "1970-07-07", None)],
    ),
    "coach_tools_contacts": (
        "id int, email string, phone_number string, address1 string, address2 string, city string, state string, zip string",
        [(31, "pat@x.com\t", "1", "1 Pat", None, "Lima", "OH", "45801"), (32, "ray@x.com", None, None, None, None, None, None)],
    ),
    "coach_tools_students": (
        "id int, first_name string, last_name string, email string",
        [(41, "Pat", "Hay", " pat@x.com")],
    ),
    "coach_tools_coach_connections": ("student_id int", [(41,)]),
    "coach_tools_demographic_profiles": ("student_id int, gender string", [(41, "M")]),
    "coach_tools_representatives": ("contact_id int, relationship_type string", [(31, "PARENT")]),
    "ccms_cen_cust_mast": (
        "cust_id int, first_nm string, last_nm string, birth_dt string, sex string",
        [(51, "Uma", "Voss", "1960-01-01", "F"), (52, "Wes", "Yost", None, "M")],
    ),
    "ccms_cen_cust_addr": (
        "cust_id int, street1 string, street2 string, street3 string, street4 string, city_nm string, "
        "state_cd string, country_nm string, postal_cd string",
        [(51, "1 U", "2 U", "3 U", "4 U", "Waco", "TX", "US", "76700")],
    ),
    "ccms_cen_cust_cyber": ("cust_id int, cyber_txt string", [(51, " uma@x.com "), (52, "wes@x.com")]),
    "ccms_cen_cust_phone": ("cust_id int, phone_num string", [(51, "5551234567")]),
    "ccms_evt_reg_hdr": ("cust_id int, REGI_SERNO int", [(51, 61)]),
    "ccms_evt_reg_tourn_info": ("REGI_SERNO int, home_course string, handicap string", [(61, "Dunes", "9")]),
    "iterable_api_iterable_api_users": (
        "email string, firstName string, lastName string, address1 string, address2 string, city string, "
        "stateRegion string, country string, postalCode string, totalTicketSpend string, signupDate string, "
        "signupSource string",
        [
            ("ann@x.com", "Ann", "Lee", "2 Oak", "Apt 1", "Cary", "NC", "US", "27000", "99.5", None, None),
            ("zed@x.com", None, None, None, None, None, None, None, None, None, None, None),
        ],
    ),
    "iterable_api_iterable_api_campaigns": (
        "id int, name string, templateId string, messageMedium string, createdByUserId string, "
        "updatedByUserId string, campaignState string, type string, listIds array<int>",
        [
            (71, "Spring", "700", "Email", "u", "u", "Ready", "Blast", [81, 82]),
            (72, "Fall", "701", "Email", "u", "u", "Ready", "Blast", []),
            (73, "Winter", "702.0", "Push", "u", "u", "Done", "Blast", [89]),
        ],
    ),
    "iterable_api_iterable_api_lists": (
        "id int, name string, description string, listType string",
        [(81, "All", None, "Standard"), (82, "VIP", "big", "Standard"), (83, "None", None, "Dynamic")],
    ),
    "iterable_api_iterable_api_message_types": ("id string, name string, subscriptionPolicy string", [("m1", "News", "OptIn")]),
    "iterable_api_iterable_api_email_opens": (
        "email string, campaignId int, templateId string, ip string, proxySource string, messageId string, createdAt string",
        [("ann@x.com", 71, "700", "i", "proxy", "m1", "t1"), ("stranger@x.com", 71, "700", "i", None, "m1", "t2")],
    ),
    "iterable_api_iterable_api_email_clicks": (
        "email string, campaignId int, templateId string, ip string, url string, messageId string, createdAt string",
        [
            ("ann@x.com", 71, "700", "1.1.1.1", "http://a", "m9", "t1"),
            ("ann@x.com", 71, "700", "1.1.1.1", "http://a", "m9", "t1"),
            ("ann@x.com", 72, "701", "1.1.1.1", "http://b", "m1", "t3"),
        ],
    ),
    "iterable_api_iterable_api_email_subscribes": (
        "email string, emailListIds array<int>, createdAt string",
        [("ann@x.com", [81, 82], "t1"), ("new@x.com", [81], "t4"), ("new@x.com", [99], "t5")],
    ),
    "iterable_api_iterable_api_email_unsubscribes": (
        "email string, emailListIds array<int>, createdAt string",
        [("ann@x.com", [82], "t6"), ("ann@x.com", None, "t7")],
    ),
}

_CUSTOMERS = f"id int, email string, first_name string, last_name string, addresses array<struct<{ADDRESS}>>"
_ITEM = "product_id: int, quantity: string, price: string, total_discount: string, title: string"
_ORDERS = (
    "id int, processed_at string, customer struct<id: int>, address1 string, address2 string, city string, "
    f"province string, zip string, country string, shipping_address struct<{ADDRESS}>, total_discounts string, "
    "total_price string, total_tax string, amount string, subtotal_price string, "
    f"line_items array<struct<{_ITEM}>>"
)
TABLES.update(
    {
        "shopify_rc_shopify_rc_customers": (
            _CUSTOMERS,
            [
                (91, "ann@x.com", "Ann", "Lee", [("2 Oak", "Apt 1", "Cary", "NC", "US", "27000"), ("x", None, None, None, None, None)]),
                (92, "sid@x.com", "Sid", "Dow", []),
            ],
        ),
        "shopify_pga_shopify_pga_customers": (
            _CUSTOMERS, [(93, "ike@x.com", "Ike", "Ames", [("5 Sea", "Unit 3", "Mesa", "AZ", "US", "85200")])],
        ),
        "shopify_rc_shopify_rc_orders": (
            _ORDERS,
            [
                (901, "2023-03-03 10:00:00", (91,), "5 Sea", "Unit 3", "Mesa", "AZ", "85200", "US",
                 ("2 Oak", "Apt 1", "Cary", "NC", "US", "27000"), "1.5", "31.5", "2", "3", "30",
                 [(1, "2", "10", "0", "Cap"), (2, "1", "10", "1.5", "Tee")]),
                (902, "2023-03-04 10:00:00", (92,), None, None, None, None, None, None, None, "0", "1", "0", "0", "1",
                 [(1, "1", "1", "0", "Cap")]),
                (903, "2023-03-05 10:00:00", (91,), None, None, None, None, None, None, None, "0", "1", "0", "0", "1", []),
            ],
        ),
        "shopify_pga_shopify_pga_orders": (
            _ORDERS,
            [(901, "2023-03-06 10:00:00", (91,), None, None, None, None, None, None, None, "0", "5", "0", "0", "5",
              [(7, "1", "5", "0", "Mug")])],
        ),
    }
)


def frames(spark):
    return {name: spark.createDataFrame(rows, schema) for name, (schema, rows) in TABLES.items()}


DAY = dt.date(2023, 3, 7)
