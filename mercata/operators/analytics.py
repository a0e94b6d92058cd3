"""The analytics views: funnel, acquisition cost, cohorts, lifetime value, pricing.

Views take ``ordered``: a presentation order is a global sort, which a caller that
reads the result further can leave out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercata.functions.columns import channel_key, percent, safe_ratio
from mercata.operators.attribution import orders_by_channel
from mercata.operators.keys import first_per_key

# Funnel stages in order, and the VIP thresholds.
STAGES = ("view_item", "add_to_cart", "begin_checkout", "purchase")
VIP_ORDERS, VIP_LTV = 4, 500
# Rate columns: (name, reached stage, starting stage).
RATES = (("view_to_cart_rate_pct", "add_to_cart", "view_item"),
         ("cart_to_checkout_rate_pct", "begin_checkout", "add_to_cart"),
         ("checkout_to_purchase_rate_pct", "purchase", "begin_checkout"),
         ("overall_conversion_rate_pct", "purchase", "view_item"))


def funnel_conversion(events: DataFrame, sessions: DataFrame, ordered: bool = True) -> DataFrame:
    """Distinct customers per stage and channel, and step rates in percent.

    The stages a session reached are one bit mask, or-ed per session before the join
    and per (channel, customer) after it. So each event row is shuffled at most once,
    combined on the map side, and four distinct counts cost no row expansion.
    """
    bit = F.lit(0)
    for i, stage in enumerate(STAGES):
        bit = F.when(F.col("event_name") == stage, 1 << i).otherwise(bit)
    reached = (events.where("session_id IS NOT NULL").groupBy("session_id")
               .agg(F.bit_or(bit).alias("mask")))
    channel = ["traffic_source", "traffic_medium"]
    customers = (reached
                 .join(sessions.select("session_id", "customer_id", *channel), "session_id")
                 .groupBy(*channel, "customer_id").agg(F.bit_or("mask").alias("mask")))
    counts = customers.groupBy(*channel).agg(*[
        F.count_if((F.col("mask").bitwiseAND(1 << i) != 0) & F.col("customer_id").isNotNull())
        .alias(f"{stage}_customers") for i, stage in enumerate(STAGES)])
    out = counts.select("*", *[
        percent(F.col(f"{reached_}_customers"), F.col(f"{start}_customers")).alias(name)
        for name, reached_, start in RATES])
    return out.orderBy(F.desc("view_item_customers"), *channel) if ordered else out


def spend_by_channel(ad_spend: DataFrame) -> DataFrame:
    return ad_spend.groupBy("channel_id").agg(F.sum("amount").alias("total_spend"))


def first_session(sessions: DataFrame) -> DataFrame:
    """First session row of each customer by (date, id)."""
    return first_per_key(sessions.where("customer_id IS NOT NULL"), ["customer_id"],
                         [F.asc_nulls_last("session_date"), "session_id"])


def new_paying_customers(sessions: DataFrame, orders: DataFrame,
                         channels: DataFrame) -> DataFrame:
    """Customers with an order, counted on the channel of their first session."""
    payers = orders.select("customer_id").distinct()
    per_name = (first_session(sessions.select("customer_id", "session_date", "session_id",
                                              "traffic_source", "traffic_medium"))
                .join(payers, "customer_id", "left_semi")
                .groupBy(channel_key(F.col("traffic_source"), F.col("traffic_medium"))
                         .alias("_key"))
                .agg(F.count("*").alias("n")))
    return (per_name.join(channels.select(F.lower("channel_name").alias("_key"), "channel_id"),
                          "_key")
            .groupBy("channel_id").agg(F.sum("n").alias("new_paying_customers")))


def channel_cac_roas(channels: DataFrame, ad_spend: DataFrame, orders: DataFrame,
                     sessions: DataFrame, ordered: bool = True) -> DataFrame:
    """Spend, orders, revenue and new payers of every channel; cost per new payer and
    return on spend for paid channels only."""
    sums = (channels.select("channel_id", "channel_name", "channel_type")
            .join(spend_by_channel(ad_spend), "channel_id", "left")
            .join(orders_by_channel(orders, sessions, channels), "channel_id", "left")
            .join(new_paying_customers(sessions, orders, channels), "channel_id", "left"))

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    def if_paid(c: Column) -> Column:
        return F.when(F.col("channel_type") == "paid", c)

    out = sums.select(
        "channel_id", "channel_name", "channel_type", or_zero("total_spend"),
        or_zero("total_orders"), or_zero("total_revenue"), or_zero("new_paying_customers"),
        if_paid(safe_ratio(F.col("total_spend"), F.col("new_paying_customers"))).alias("cac"),
        if_paid(safe_ratio(F.col("total_revenue"), F.col("total_spend"))).alias("roas"))
    return out.orderBy(F.desc("total_revenue"), "channel_id") if ordered else out


def cohort_retention(orders: DataFrame, ordered: bool = True) -> DataFrame:
    """Customers active n months after the month of their first order.

    Orders are first reduced to one row per customer and month, on the map side too.
    The window that finds the first month then sees one row per calendar month of a
    customer, and the final count needs no distinct.
    """
    months = (orders.where("customer_id IS NOT NULL")
              .select("customer_id", F.trunc("order_date", "month").alias("month")).distinct())
    cohort = F.min("month").over(Window.partitionBy("customer_id"))

    def serial(c: Column) -> Column:
        return F.year(c) * 12 + F.month(c)

    out = (months.withColumn("cohort_month", cohort)
           .groupBy("cohort_month", (serial(F.col("month")) - serial(F.col("cohort_month")))
                    .alias("month_number"))
           .agg(F.count("*").alias("active_customers")))
    return out.orderBy("cohort_month", "month_number") if ordered else out


def customer_ltv(sessions: DataFrame, orders: DataFrame, ordered: bool = True) -> DataFrame:
    """Acquisition channel and realised order value of every customer with a session."""
    bought = (orders.where("customer_id IS NOT NULL").groupBy("customer_id")
              .agg(F.count("*").alias("n"), F.sum("order_total").alias("revenue"),
                   F.min("order_date").alias("first_order_date"),
                   F.max("order_date").alias("last_order_date")))
    first = first_session(sessions.select("customer_id", "session_date", "session_id",
                                          "traffic_source", "traffic_medium"))
    out = first.join(bought, "customer_id", "left").select(
        "customer_id", F.col("traffic_source").alias("acquisition_source"),
        F.col("traffic_medium").alias("acquisition_medium"),
        F.col("session_date").alias("acquisition_date"),
        F.coalesce("n", F.lit(0)).alias("total_orders"),
        F.coalesce("revenue", F.lit(0)).alias("historical_ltv"),
        "first_order_date", "last_order_date",
        safe_ratio(F.col("revenue"), F.col("n")).alias("average_order_value"))
    return out.orderBy(F.desc("historical_ltv"), "customer_id") if ordered else out


def customer_segments(ltv: DataFrame, vip_orders: int = VIP_ORDERS,
                      vip_ltv: float = VIP_LTV) -> DataFrame:
    """First matching segment of each customer; VIP is tested first."""
    n = F.col("total_orders")
    segment = (F.when((n >= vip_orders) | (F.col("historical_ltv") >= vip_ltv), "VIP")
               .when((n == 0) | n.isNull(), "No Purchase")
               .when(n == 1, "One-Time Buyer")
               .when(n.between(2, 3), "Repeat Customer")
               .otherwise("Unknown"))
    return ltv.select("customer_id", "acquisition_source", "acquisition_medium",
                      "total_orders", "historical_ltv", segment.alias("segment"))


def pricing_analytics(order_items: DataFrame, products: DataFrame,
                      ordered: bool = True) -> DataFrame:
    """Orders, revenue, average price and depth of discount of every product sold.

    The distinct order count is planned as (product, order) first, so one product with
    much of the sales is spread over its orders.
    """
    sold = order_items.groupBy("product_id").agg(
        F.count_distinct("order_id").alias("times_purchased"),
        F.sum(F.col("quantity") * F.col("unit_price")).alias("product_revenue"),
        F.sum("unit_price").alias("_price_sum"), F.count("unit_price").alias("_prices"))
    base = F.col("base_price").cast("decimal(18,2)")
    n = F.col("_prices").cast("decimal(14,0)")
    # (base - average) / base, multiplied out so that only one division rounds.
    off = (base * n - F.col("_price_sum").cast("decimal(24,2)")) * 100 / F.nullif(base * n, F.lit(0))
    out = sold.join(products, "product_id").select(
        "product_id", "product_name", "category", "base_price",
        safe_ratio(F.col("_price_sum"), F.col("_prices")).alias("avg_selling_price"),
        F.round(F.greatest(off, F.lit(0).cast("decimal(1,0)")), 2).alias("discount_pct"),
        "times_purchased", "product_revenue")
    return out.orderBy(F.desc("product_revenue"), "product_id") if ordered else out


def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """First n rows; ``order`` must end in a unique column."""
    return df.orderBy(*order).limit(n)


def top_channels_by_views(funnel: DataFrame, n: int = 5) -> DataFrame:
    named = funnel.select(F.concat("traffic_source", F.lit(" / "), "traffic_medium")
                          .alias("channel_name"), "view_item_customers")
    return top_n(named, [F.desc("view_item_customers"), "channel_name"], n)


def top_conversion(funnel: DataFrame, n: int = 8) -> DataFrame:
    named = funnel.select(F.concat("traffic_source", F.lit(" / "), "traffic_medium")
                          .alias("channel_name"), "overall_conversion_rate_pct")
    return top_n(named, [F.desc_nulls_last("overall_conversion_rate_pct"), "channel_name"], n)


def discount_vs_volume(pricing: DataFrame) -> DataFrame:
    return pricing.select("discount_pct", "times_purchased")
