"""Last-click, linear and time-decay revenue attribution.

The models exist twice: ``linear`` / ``time_decay`` read a stored touchpoint table,
``attribute_journeys`` computes both straight from orders and sessions. The latter
never builds a row per order: orders of one customer and day share their journey, so
they are summed first and credited together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercata.functions.columns import channel_key, exact_sum
from mercata.operators.touchpoints import LOOKBACK, journeys, match_channel, orders_per_day

HALF_LIFE_DAYS = 7.0  # fixed value
MODEL_ORDER = ("last_click", "linear", "time_decay")
COLUMNS = ("channel_id", "attribution_model", "attributed_revenue", "attributed_orders")


def _labelled(df: DataFrame, model: str) -> DataFrame:
    return df.select(
        "channel_id", F.lit(model).alias("attribution_model"),
        F.round("attributed_revenue", 2).cast("decimal(28,2)").alias("attributed_revenue"),
        "attributed_orders")


def decay_weight(days: Column, half_life_days: float = HALF_LIFE_DAYS) -> Column:
    return F.power(F.lit(0.5), F.greatest(days, F.lit(0)) / F.lit(float(half_life_days)))


def _share_of(total: Column, parts: Column) -> Column:
    """total / parts at ten decimals."""
    return (total.cast("decimal(28,2)") / parts.cast("decimal(10,0)")).cast("decimal(28,10)")


def last_click(orders: DataFrame, sessions: DataFrame, channels: DataFrame) -> DataFrame:
    """All credit to the channel of the session the order was placed in."""
    return _labelled(orders_by_channel(orders, sessions, channels).select(
        "channel_id", F.col("total_revenue").alias("attributed_revenue"),
        F.col("total_orders").alias("attributed_orders")), "last_click")


def orders_by_channel(orders: DataFrame, sessions: DataFrame, channels: DataFrame) -> DataFrame:
    """Orders and revenue per channel of the ordering session.

    Orders (one row per order_id) are summed per session, then per channel name,
    before the join to sessions and channels respectively: neither a session nor a
    channel holding much of the data makes a large join group.
    """
    per_session = (orders.where("session_id IS NOT NULL").groupBy("session_id")
                   .agg(F.count("*").alias("n"), F.sum("order_total").alias("revenue")))
    named = sessions.select("session_id", channel_key(
        F.col("traffic_source"), F.col("traffic_medium")).alias("_key"))
    per_name = (per_session.join(named, "session_id").where("_key IS NOT NULL").groupBy("_key")
                .agg(F.sum("n").alias("n"), F.sum("revenue").alias("revenue")))
    return (per_name.join(channels.select(F.lower("channel_name").alias("_key"), "channel_id"),
                          "_key")
            .groupBy("channel_id")
            .agg(F.sum("n").alias("total_orders"), F.sum("revenue").alias("total_revenue")))


# --- from a stored touchpoint table --------------------------------------

def _credited(tp: DataFrame, orders: DataFrame, credit: Column, model: str) -> DataFrame:
    touches = (tp.where("channel_id IS NOT NULL")
               .select("order_id", "channel_id", F.to_date("touchpoint_timestamp").alias("touched"))
               .join(orders.select("order_id", "order_total", "order_date"), "order_id"))
    # Per order and channel first: an order then counts once per channel.
    per_order = (touches.withColumn("credit", credit.cast("decimal(28,10)"))
                 .groupBy("order_id", "channel_id").agg(F.sum("credit").alias("credit")))
    return _labelled(per_order.groupBy("channel_id").agg(
        F.coalesce(exact_sum(F.col("credit")), F.lit(0)).alias("attributed_revenue"),
        F.count("*").alias("attributed_orders")), model)


def linear(tp: DataFrame, orders: DataFrame) -> DataFrame:
    """Equal credit to every touch with a known channel. An order has at most k
    touches, so the window over it is small."""
    n = F.count("*").over(Window.partitionBy("order_id"))
    return _credited(tp, orders, _share_of(F.col("order_total"), n), "linear")


def time_decay(tp: DataFrame, orders: DataFrame,
               half_life_days: float = HALF_LIFE_DAYS) -> DataFrame:
    """Credit halves with every ``half_life_days`` before the order, normalised per order."""
    w = decay_weight(F.datediff("order_date", "touched"), half_life_days)
    share = w / F.sum(w).over(Window.partitionBy("order_id"))
    return _credited(tp, orders, F.col("order_total").cast("double") * share, "time_decay")


# --- from orders and sessions --------------------------------------------

def attribute_journeys(orders: DataFrame, sessions: DataFrame, channels: DataFrame,
                       k: int = LOOKBACK,
                       half_life_days: float = HALF_LIFE_DAYS) -> DataFrame:
    """Linear and time-decay attribution in one pass over orders and sessions."""
    visits = match_channel(
        sessions.select("customer_id", "session_date", "session_id", "traffic_source",
                        "traffic_medium"), channels).drop("traffic_source", "traffic_medium")
    per_day = orders_per_day(orders, F.sum("order_total").alias("total"))
    known = F.filter("touches", lambda t: t["channel_id"].isNotNull())
    weighted = F.transform(known, lambda t: F.struct(
        t["channel_id"].alias("channel_id"),
        decay_weight(F.datediff(F.col("order_date"), t["session_date"]), half_life_days)
        .alias("w")))
    touches = (
        journeys(per_day, visits, k)
        .select("n_orders", "total", weighted.alias("known"))
        .where(F.size("known") > 0)
        # Per journey, in a select of its own: beside the explode it would be
        # evaluated once per touch.
        .select("n_orders", "total", "known", F.size("known").alias("n"),
                F.aggregate("known", F.lit(0.0), lambda acc, t: acc + t["w"]).alias("w_sum"),
                F.transform("known", lambda t: t["channel_id"]).alias("ids"))
        .select("n_orders", "total", "n", "w_sum", "ids",
                F.posexplode("known").alias("pos", "touch"))
        .select(F.col("touch.channel_id").alias("channel_id"), "n", "total",
                # A channel seen twice in a journey counts the orders once.
                F.when(F.array_position("ids", F.col("touch.channel_id")) == F.col("pos") + 1,
                       F.col("n_orders")).otherwise(0).alias("orders"),
                (F.col("total").cast("double") * F.col("touch.w") / F.col("w_sum"))
                .alias("decayed")))
    # Totals of journeys of equal length are added exactly and divided once.
    per_length = touches.groupBy("channel_id", "n").agg(
        F.sum("total").alias("total"), exact_sum(F.col("decayed")).alias("decayed"),
        F.sum("orders").alias("orders"))
    per_channel = per_length.groupBy("channel_id").agg(
        F.coalesce(F.sum(_share_of(F.col("total"), F.col("n"))), F.lit(0)).alias("linear"),
        F.coalesce(F.sum("decayed"), F.lit(0)).alias("time_decay"),
        F.sum("orders").alias("attributed_orders"))
    models = F.array(*[F.struct(F.lit(m).alias("attribution_model"),
                                F.round(m, 2).cast("decimal(28,2)").alias("attributed_revenue"))
                       for m in ("linear", "time_decay")])
    return (per_channel.select("channel_id", "attributed_orders", F.explode(models).alias("m"))
            .select("channel_id", "m.*", "attributed_orders").select(*COLUMNS))


# --- together ------------------------------------------------------------

def channel_attribution(*models: DataFrame) -> DataFrame:
    """Results of several models stacked."""
    return reduce(DataFrame.unionByName, [m.select(*COLUMNS) for m in models])


def attribution_comparison(last: DataFrame, stored: DataFrame, channels: DataFrame,
                           ordered: bool = True) -> DataFrame:
    """Last click next to the stored models, with channel names."""
    out = (channel_attribution(last, stored)
           .join(channels.select("channel_id", "channel_name"), "channel_id")
           .select("channel_name", "attribution_model",
                   F.round("attributed_revenue", 2).alias("attributed_revenue"),
                   "attributed_orders"))
    if not ordered:
        return out
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, MODEL_ORDER)),
                                                F.col("attribution_model")), F.lit(0)),
                      F.lit(len(MODEL_ORDER) + 1))
    return out.orderBy("channel_name", rank)


def attribution_pivot(comparison: DataFrame) -> DataFrame:
    """One row per channel, one revenue column per model, and the percentage by which
    the multi-touch models differ from last click."""
    wide = (comparison.groupBy("channel_name")
            .pivot("attribution_model", list(MODEL_ORDER)).agg(F.sum("attributed_revenue")))

    def uplift(model: str) -> Column:
        base = F.col("last_click")
        return F.round((F.col(model) - base).cast("decimal(20,2)") * 100
                       / F.nullif(base.cast("decimal(16,2)"), F.lit(0)), 2)

    return wide.select("channel_name", *MODEL_ORDER, uplift("linear").alias("linear_uplift_pct"),
                       uplift("time_decay").alias("time_decay_uplift_pct"))
