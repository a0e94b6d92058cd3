"""Raw frames to marts to views: the step order of a full refresh, as plain functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.operators import analytics, attribution, marts, quality, touchpoints


def build_marts(events: DataFrame, items: DataFrame, channels: DataFrame, campaigns: DataFrame,
                ad_spend: DataFrame, tiebreak: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Star schema from cleaned staging frames, as candidates: the load gate refuses orders
    without a total, their line items, and whatever else breaks a contract."""
    return {
        "marketing_channels": marts.mart_channels(channels),
        "campaigns": marts.mart_campaigns(campaigns),
        "ad_spend": marts.mart_ad_spend(ad_spend),
        "products": marts.mart_products(items),
        "customers": marts.mart_customers(events),
        "sessions": marts.mart_sessions(events, tiebreak),
        "events": marts.mart_events(events),
        "orders": marts.mart_orders(events, tiebreak),
        "order_items": marts.mart_order_items(items),
    }


def comparison(m: dict[str, DataFrame], multi_touch: DataFrame) -> DataFrame:
    """Last click next to the multi-touch results, which may be stored ones."""
    last = attribution.last_click(m["orders"], m["sessions"], m["marketing_channels"])
    return attribution.attribution_comparison(last, multi_touch, m["marketing_channels"])


def build_views(m: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The seven analytics views over stored marts, the touchpoint table and the
    multi-touch results."""
    ltv = analytics.customer_ltv(m["sessions"], m["orders"])
    multi_touch = attribution.attribute_journeys(m["orders"], m["sessions"],
                                                 m["marketing_channels"])
    return {
        "vw_funnel_conversion": analytics.funnel_conversion(m["events"], m["sessions"]),
        "vw_channel_cac_roas": analytics.channel_cac_roas(
            m["marketing_channels"], m["ad_spend"], m["orders"], m["sessions"]),
        "vw_cohort_retention": analytics.cohort_retention(m["orders"]),
        "vw_customer_ltv": ltv,
        "vw_customer_segments": analytics.customer_segments(
            analytics.customer_ltv(m["sessions"], m["orders"], ordered=False)),
        "vw_pricing_analytics": analytics.pricing_analytics(m["order_items"], m["products"]),
        "vw_attribution_comparison": comparison(m, multi_touch),
        "channel_attribution": multi_touch,
        "customer_touchpoints": touchpoints.build_touchpoints(
            m["orders"], m["sessions"], m["marketing_channels"]),
    }


def register_views(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def quality_checks(m: dict[str, DataFrame], date_from: str, date_to: str) -> quality.QualityReport:
    """The 23 checks over the marts."""
    return quality.dq_report(quality.all_checks(
        m, quality.NULL_RULES, quality.value_rules(date_from, date_to), quality.KEY_RULES, quality.PARENT_RULES))


def presentable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as ISO text: the same on every client."""
    out = []
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind == "decimal":
            c = c.cast("double")
        elif kind == "date":
            c = c.cast("string")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(c.alias(f.name))
    return df.select(*out)
