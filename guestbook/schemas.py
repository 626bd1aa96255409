"""Declared schemas: column name -> type, in output order.

Column names and types are fixed values of the datamart.
"""

from __future__ import annotations

PLACE = {
    "address_1": "string",
    "address_2": "string",
    "city": "string",
    "state_region": "string",
    "country": "string",
    "postal_code": "string",
}

CONSUMER_FIELDS = {
    "email": "string",
    "name_first": "string",
    "name_last": "string",
    "birth_date": "date",
    "gender": "string",
    "parent_of_junior": "boolean",
    "league": "string",
    "team": "string",
    "do_not_sell": "boolean",
    "total_ticket_spend": "double",
    "total_merch_spend": "double",
    "total_pga_spend": "double",
    "secondary_purchaser": "boolean",
    "secondary_seller": "boolean",
    "trade_in_purchaser": "boolean",
    "travel_purchaser": "boolean",
    "merch_purchase_likely": "double",
    "ticket_purchase_likely": "double",
    "internal": "boolean",
    "vip_status": "boolean",
    "pga_professional_id": "string",
    "golf_handicap": "int",
    "dma_region": "string",
    "course_home": "string",
    "has_coach": "boolean",
    "volunteer_history": "string",
    "sign_up_at": "timestamp",
    "sign_up_source": "string",
}

# A person as every source is conformed to: who, from where, living where.
PERSON = {"source_consumer_id": "string", "source_system": "string", **CONSUMER_FIELDS, **PLACE}

CONSUMERS = {"id": "string", **CONSUMER_FIELDS}

ADDRESS_FIELDS = {
    "address_1": "string",
    "address_2": "string",
    "address_3": "string",
    "address_4": "string",
    "city": "string",
    "state_region": "string",
    "int_region": "string",
    "country": "string",
    "postal_code": "string",
    "latitude": "string",
    "longitude": "string",
}

ADDRESSES = {**ADDRESS_FIELDS, "id": "string"}

CONSUMER_ADDRESSES = {"consumer_id": "string", "address_id": "string", "id": "string"}

# A visit: one person's part in one event, as every source is conformed to.
VISIT = {
    "name_first": "string",
    "name_last": "string",
    "email": "string",
    "address_1": "string",
    "city": "string",
    "state_region": "string",
    "postal_code": "string",
    "country": "string",
    "date_rsvped": "timestamp",
    "attending": "boolean",
    "checked_in": "boolean",
    "vip": "boolean",
    "on_waitlist": "boolean",
    "source_event_id": "string",
    "event_name": "string",
    "event_description": "string",
    "venue_name": "string",
    "start_time": "timestamp",
    "end_time": "timestamp",
    "rsvp_open": "boolean",
    "has_waitlist": "boolean",
    "rsvp_closed_at": "timestamp",
}

EVENTS = {
    "id": "string",
    "source_event_id": "string",
    "event_name": "string",
    "event_description": "string",
    "venue_name": "string",
    "address_id": "string",
    "start_time": "timestamp",
    "end_time": "timestamp",
    "rsvp_open": "boolean",
    "has_waitlist": "boolean",
    "rsvp_closed_at": "timestamp",
}

CONSUMER_EVENTS = {
    "event_id": "string",
    "consumer_id": "string",
    "date_rsvped": "timestamp",
    "attending": "boolean",
    "checked_in": "boolean",
    "vip": "boolean",
    "on_waitlist": "boolean",
    "id": "string",
}

SOURCE_SYSTEM = {"id": "int", "name": "string", "url": "string", "platform": "string"}

ORDER_TOTALS = {
    "total_discount": "double",
    "total_gross_sub": "double",
    "total_taxable_sub": "double",
    "total_non_taxable_sub": "double",
    "total_tax": "double",
    "total_ship": "double",
    "total": "double",
}

ITEM_FIELDS = {
    "source_product_id": "string",
    "product_name": "string",
    "quantity": "double",
    "unit_price": "double",
    "item_discount": "double",
    "category": "string",
    "sub_category": "string",
    "sub_class": "string",
    "variation_size": "string",
}

ORDER_PLACE = ("address_1", "address_2", "city", "state_region", "country")

# One line of one order, as every source is conformed to.
ORDER_LINE = {
    "name_first": "string",
    "name_last": "string",
    "email": "string",
    "source_system": "string",
    "source_instance": "string",
    "source_order_id": "string",
    "order_date": "timestamp",
    "campaign": "string",
    "site": "string",
    **ORDER_TOTALS,
    **ITEM_FIELDS,
    "event_name": "string",
    "event_datetime": "timestamp",
    "venue_name": "string",
    **{f"shipping_{c}": "string" for c in ORDER_PLACE},
    **{f"billing_{c}": "string" for c in ORDER_PLACE},
}

ORDERS = {
    "id": "string",
    "consumer_id": "string",
    "source_system_id": "int",
    "source_order_id": "string",
    "address_shipping_id": "string",
    "address_billing_id": "string",
    "order_date": "timestamp",
    "campaign": "string",
    "site": "string",
    **ORDER_TOTALS,
}

ORDER_ITEMS = {
    "order_id": "string",
    "source_product_id": "string",
    "event_id": "string",
    **{c: t for c, t in ITEM_FIELDS.items() if c != "source_product_id"},
    "id": "string",
}

CAMPAIGN_FIELDS = {
    "source_campaign_id": "string",
    "campaign_name": "string",
    "template_id": "int",
    "message_medium": "string",
    "created_by_user_id": "string",
    "updated_by_user_id": "string",
    "campaign_state": "string",
    "campaign_type": "string",
}

MARKETING_CAMPAIGNS = {"id": "string", **CAMPAIGN_FIELDS}

ACTION_FIELDS = {
    "marketing_action_type": "string",
    "click_url": "string",
    "message_name": "string",
    "message_subscription_policy": "string",
    "proxy_source": "string",
    "consumer_ip": "string",
}

LIST_FIELDS = {"list_name": "string", "list_description": "string", "list_type": "string"}

# The engagement log: one action of one person, with the campaign and list it concerns.
ENGAGEMENT = {
    "name_first": "string",
    "name_last": "string",
    "email": "string",
    **CAMPAIGN_FIELDS,
    **ACTION_FIELDS,
    "list_id": "string",
    **LIST_FIELDS,
    "created_at": "string",
}

CONSUMER_MARKETING_ACTIONS = {"consumer_id": "string", "campaign_id": "string", **ACTION_FIELDS, "id": "string"}

MARKETING_LISTS = {**LIST_FIELDS, "id": "string"}

CAMPAIGN_MARKETING_LISTS = {"id": "string", "campaign_id": "string", "marketing_list_id": "string"}

MARKETING_ACTION_LIST = {"action_id": "string", "list_id": "string", "id": "string"}

DATAMART = {
    "consumers": CONSUMERS,
    "addresses": ADDRESSES,
    "consumer_addresses": CONSUMER_ADDRESSES,
    "events": EVENTS,
    "consumer_events": CONSUMER_EVENTS,
    "source_system": SOURCE_SYSTEM,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "marketing_campaigns": MARKETING_CAMPAIGNS,
    "consumer_marketing_actions": CONSUMER_MARKETING_ACTIONS,
    "marketing_lists": MARKETING_LISTS,
    "campaign_marketing_lists": CAMPAIGN_MARKETING_LISTS,
    "marketing_action_list": MARKETING_ACTION_LIST,
}
