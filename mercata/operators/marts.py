"""Staging tables to star-schema marts.

"First" and "latest" rows are ranked with a group limit that is applied before the
shuffle too: a session, product or transaction with much of the data is reduced to one
row per input split before anything moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.operators.keys import first_per_key


def _first(df: DataFrame, key: str, payload: dict[str, Column], ts: str,
           tiebreak: Sequence[str]) -> DataFrame:
    """Payload of the earliest row per key; rows without time come last. Equal times are
    settled by ``tiebreak`` (columns that tell rows apart) or, without one, by the payload."""
    order = [F.col(ts).asc_nulls_last(), *(tiebreak or payload.values())]
    return (first_per_key(df, [key], order)
            .select(key, *[c.alias(n) for n, c in payload.items()]))


def mart_channels(staged: DataFrame) -> DataFrame:
    return staged.select("channel_id", "channel_name", "channel_type").distinct()


def mart_campaigns(staged: DataFrame) -> DataFrame:
    return staged.select("campaign_id", "channel_id", "campaign_name", "start_date",
                         "end_date", "budget").distinct()


def mart_ad_spend(staged: DataFrame) -> DataFrame:
    return staged.select("spend_id", "channel_id", "campaign_id", "spend_date",
                         "amount").distinct()


def mart_products(items: DataFrame) -> DataFrame:
    """Latest row per item gives its name, category and base price.

    A row without time never wins over one that has it; equal times go to the
    highest price, then the last name."""
    latest = [F.desc_nulls_last(c) for c in ("event_datetime", "price", "item_name",
                                             "item_category")]
    return first_per_key(items, ["item_id"], latest).select(
        F.col("item_id").alias("product_id"), F.col("item_name").alias("product_name"),
        F.col("item_category").alias("category"), F.col("price").alias("base_price"))


def mart_customers(events: DataFrame) -> DataFrame:
    """First day seen and the alphabetically last country of each user."""
    return (events.groupBy(F.col("user_pseudo_id").alias("customer_id"))
            .agg(F.min("event_date").alias("first_seen_date"),
                 F.max("country").alias("country")))


def mart_sessions(events: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The first event of a session sets its date, channel, campaign and device."""
    return _first(
        events.where("session_id IS NOT NULL"), "session_id",
        {"customer_id": F.col("user_pseudo_id"), "session_date": F.col("event_date"),
         **{c: F.col(c) for c in ("traffic_source", "traffic_medium", "campaign_name",
                                  "device_category")}},
        "event_datetime", tiebreak)


def mart_events(events: DataFrame) -> DataFrame:
    """Events that belong to a session; no product is recorded on this level."""
    return (events.where("session_id IS NOT NULL")
            .select("session_id", "event_name", "event_datetime",
                    F.lit(None).cast("string").alias("product_id")))


def mart_orders(events: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """One completed order per transaction, from its earliest purchase event."""
    bought = events.where("event_name = 'purchase' AND transaction_id IS NOT NULL")
    return _first(
        bought, "transaction_id",
        {"customer_id": F.col("user_pseudo_id"), "session_id": F.col("session_id"),
         "order_date": F.col("event_date"), "order_status": F.lit("completed"),
         "order_total": F.col("items_value")},
        "event_datetime", tiebreak).withColumnRenamed("transaction_id", "order_id")


def mart_order_items(items: DataFrame) -> DataFrame:
    return (items.where("event_name = 'purchase' AND transaction_id IS NOT NULL")
            .select(F.col("transaction_id").alias("order_id"),
                    F.col("item_id").alias("product_id"), "quantity",
                    F.col("price").alias("unit_price")))
