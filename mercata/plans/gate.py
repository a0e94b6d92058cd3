"""Load gate: each mart against its contract, parents before the tables that refer to them.

A row that breaks a rule goes to quarantine with its reason; rows that refer to it are
orphans, so nothing that is loaded points at a refused row. Every rule is checked for all
rows: repeated keys refuse all their rows, as which one is right is not known.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mercata import schemas
from mercata.operators import quality
from mercata.sources import writers


class Contract(NamedTuple):
    """Columns, required columns, primary key, references (column, table, its key), and columns
    that are unique besides the key."""
    schema: StructType
    required: tuple[str, ...]
    key: str | None = None
    references: tuple[tuple[str, str, str], ...] = ()
    unique: tuple[str, ...] = ()


# Required columns, keys and references of the marts, parents first.
CONTRACTS = {
    "customers": Contract(schemas.CUSTOMERS, ("first_seen_date",), "customer_id"),
    "products": Contract(schemas.PRODUCTS, ("product_name", "base_price"), "product_id"),
    # Two channels of one name would multiply the rows of every join on it.
    "marketing_channels": Contract(schemas.CHANNELS, ("channel_name", "channel_type"), "channel_id",
                                   unique=("channel_name",)),
    "sessions": Contract(schemas.SESSIONS, ("customer_id", "session_date"), "session_id",
                         (("customer_id", "customers", "customer_id"),)),
    "campaigns": Contract(schemas.CAMPAIGNS,
                          ("channel_id", "campaign_name", "start_date", "end_date"), "campaign_id",
                          (("channel_id", "marketing_channels", "channel_id"),)),
    "orders": Contract(schemas.ORDERS, ("customer_id", "order_date", "order_total"), "order_id",
                       (("customer_id", "customers", "customer_id"),
                        ("session_id", "sessions", "session_id"))),
    "events": Contract(schemas.EVENTS, ("session_id", "event_name", "event_datetime"), None,
                       (("session_id", "sessions", "session_id"),
                        ("product_id", "products", "product_id"))),
    "order_items": Contract(schemas.ORDER_ITEMS,
                            ("order_id", "product_id", "quantity", "unit_price"), None,
                            (("order_id", "orders", "order_id"),
                             ("product_id", "products", "product_id"))),
    "ad_spend": Contract(schemas.AD_SPEND, ("channel_id", "campaign_id", "spend_date", "amount"),
                         "spend_id", (("channel_id", "marketing_channels", "channel_id"),
                                      ("campaign_id", "campaigns", "campaign_id"))),
}


# Tables made of the marts; a touchpoint may be on a channel that is not known.
RESULT_CONTRACTS = {
    "customer_touchpoints": Contract(
        schemas.TOUCHPOINTS, ("customer_id", "order_id", "touchpoint_timestamp", "touchpoint_order"), None,
        (("customer_id", "customers", "customer_id"), ("order_id", "orders", "order_id"),
         ("channel_id", "marketing_channels", "channel_id"))),
    "channel_attribution": Contract(schemas.CHANNEL_ATTRIBUTION, ("attribution_model",), None,
                                    (("channel_id", "marketing_channels", "channel_id"),)),
    "data_quality_log": Contract(schemas.QUALITY_LOG, ("run_timestamp", "check_name", "table_name", "status")),
}


class Gated(NamedTuple):
    loaded: dict[str, DataFrame]
    refused: dict[str, DataFrame]  # with ``reason``


def gate(tables: Mapping[str, DataFrame], keep: Callable[[str, DataFrame], DataFrame],
         contracts: Mapping[str, Contract] = CONTRACTS, parents: Mapping[str, DataFrame] | None = None) -> Gated:
    """``keep(name, frame)`` writes a frame and returns it as read again: a table is computed
    once, and once more with the reason of each row. ``parents`` are tables loaded before."""
    loaded, refused = {}, {}
    for table, c in contracts.items():
        if table not in tables:
            continue
        rows = keep(f"{table}-candidates", writers.conform_schema(tables[table], c.schema))
        known = {**(parents or {}), **loaded}
        marked = keep(f"{table}-marked", quality.mark_violations(
            rows, not_null=c.required, pk=c.key, unique=c.unique,
            fks=[(column, known[parent], key) for column, parent, key in c.references],
            keep=lambda name, df, table=table: keep(f"{table}-{name}", df)))
        loaded[table] = marked.where("reason IS NULL").drop("reason")
        refused[table] = marked.where("reason IS NOT NULL")
    return Gated(loaded, refused)


def summary(refused: Mapping[str, DataFrame]) -> DataFrame:
    """Rows in quarantine per table and reason."""
    return reduce(DataFrame.unionByName, [
        df.groupBy("reason").agg(F.count("*").alias("rows"))
        .select(F.lit(table).alias("table_name"), "reason", "rows")
        for table, df in refused.items()])
