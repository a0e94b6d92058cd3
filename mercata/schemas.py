"""Column contracts of raw, staging and mart tables. Importing needs no session."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DataType, DateType, DecimalType,
                               IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)

TEXT, INT, LONG, DATE, BOOL = StringType(), IntegerType(), LongType(), DateType(), BooleanType()
TIME, MONEY = TimestampNTZType(), DecimalType(18, 2)


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


NESTED_EVENT = _schema(
    event_date=TEXT, event_timestamp=LONG, event_name=TEXT, user_pseudo_id=TEXT,
    event_params=ArrayType(_schema(key=TEXT, value=_schema(string_value=TEXT, int_value=LONG))),
    traffic_source=_schema(source=TEXT, medium=TEXT, name=TEXT), device=_schema(category=TEXT),
    geo=_schema(country=TEXT), ecommerce=_schema(transaction_id=TEXT),
    items=ArrayType(_schema(item_id=TEXT, item_name=TEXT, item_category=TEXT, price=MONEY,
                            quantity=INT)))

RAW_EVENTS = _schema(
    event_date=TEXT, event_timestamp=LONG, event_name=TEXT, user_pseudo_id=TEXT,
    ga_session_id=LONG, page_location=TEXT, traffic_source=TEXT, traffic_medium=TEXT,
    campaign_name=TEXT, device_category=TEXT, country=TEXT, transaction_id=TEXT,
    items_value=MONEY, session_id=TEXT)
RAW_ITEMS = _schema(
    event_date=TEXT, event_timestamp=LONG, user_pseudo_id=TEXT, ga_session_id=LONG,
    event_name=TEXT, transaction_id=TEXT, item_id=TEXT, item_name=TEXT, item_category=TEXT,
    price=MONEY, quantity=INT, session_id=TEXT)

STAGED_EVENTS = _schema(
    event_date=DATE, event_datetime=TIME, event_name=TEXT, user_pseudo_id=TEXT,
    ga_session_id=LONG, session_id=TEXT, page_location=TEXT, traffic_source=TEXT,
    traffic_medium=TEXT, campaign_name=TEXT, device_category=TEXT, country=TEXT,
    transaction_id=TEXT, items_value=MONEY, is_flagged_incomplete_purchase=BOOL)
STAGED_ITEMS = _schema(
    event_date=DATE, event_datetime=TIME, user_pseudo_id=TEXT, ga_session_id=LONG,
    session_id=TEXT, event_name=TEXT, transaction_id=TEXT, item_id=TEXT, item_name=TEXT,
    item_category=TEXT, price=MONEY, quantity=INT)

CHANNELS = _schema(channel_id=INT, channel_name=TEXT, channel_type=TEXT)
CAMPAIGNS = _schema(campaign_id=INT, channel_id=INT, campaign_name=TEXT, start_date=DATE,
                    end_date=DATE, budget=MONEY)
AD_SPEND = _schema(spend_id=INT, channel_id=INT, campaign_id=INT, spend_date=DATE, amount=MONEY)

CUSTOMERS = _schema(customer_id=TEXT, first_seen_date=DATE, country=TEXT)
PRODUCTS = _schema(product_id=TEXT, product_name=TEXT, category=TEXT, base_price=MONEY)
SESSIONS = _schema(session_id=TEXT, customer_id=TEXT, session_date=DATE, traffic_source=TEXT,
                   traffic_medium=TEXT, campaign_name=TEXT, device_category=TEXT)
ORDERS = _schema(order_id=TEXT, customer_id=TEXT, session_id=TEXT, order_date=DATE,
                 order_status=TEXT, order_total=MONEY)
EVENTS = _schema(session_id=TEXT, event_name=TEXT, event_datetime=TIME, product_id=TEXT)
ORDER_ITEMS = _schema(order_id=TEXT, product_id=TEXT, quantity=INT, unit_price=MONEY)
TOUCHPOINTS = _schema(customer_id=TEXT, order_id=TEXT, channel_id=INT, touchpoint_timestamp=TIME,
                      touchpoint_order=INT)
CHANNEL_ATTRIBUTION = _schema(channel_id=INT, attribution_model=TEXT,
                              attributed_revenue=DecimalType(28, 2), attributed_orders=LONG)
QUALITY_LOG = _schema(run_timestamp=TimestampType(), check_name=TEXT, table_name=TEXT,
                      status=TEXT, details=TEXT)
