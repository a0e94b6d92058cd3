"""Customer journeys: the last k sessions before each order.

The direct form joins every order of a customer with every session of the customer
and keeps k of them, which is quadratic for a busy customer. Here nothing is paired:

1. Dates are the grain of the comparison, so all orders of one customer and day have
   the same journey, and of one customer and day only the k latest sessions can ever
   be used. Both are reduced to that grain with map-side pruning or combining.
2. After that a customer has at most k + 1 rows per calendar day, however much of the
   data is theirs, and a window over the customer is bounded.
3. In that window sessions are numbered, and each order day collects the numbers
   c-k+1 .. c with a range frame, c being the count of sessions so far.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercata.functions.columns import channel_key
from mercata.operators.keys import ROWS_PER_SALT, salts

LOOKBACK = 10  # fixed value: touchpoints kept per order


def match_channel(df: DataFrame, channels: DataFrame, how: str = "left") -> DataFrame:
    """Add ``channel_id`` by the case-insensitive name ``source / medium``.

    Rows without a matching channel keep a NULL id. Spark broadcasts the dimension if
    its bytes are below the threshold; adaptive execution splits hot channels otherwise.
    """
    names = channels.select(F.lower("channel_name").alias("_key"), "channel_id")
    keyed = df.withColumn("_key", channel_key(F.col("traffic_source"), F.col("traffic_medium")))
    return keyed.join(names, "_key", how).drop("_key")


def last_sessions_per_day(sessions: DataFrame, k: int = LOOKBACK) -> DataFrame:
    """The k last sessions of each customer and day, by session id.

    The rank limit is applied before the shuffle as well, so each input split sends
    at most k rows per customer and day.
    """
    w = (Window.partitionBy("customer_id", "session_date")
         .orderBy(F.col("session_id").desc()))
    return (sessions
            .where("customer_id IS NOT NULL AND session_date IS NOT NULL")
            .withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= k).drop("_nth"))


def orders_per_day(orders: DataFrame, *extra: Column) -> DataFrame:
    """Orders summed to customer and day: n_orders and whatever ``extra`` adds."""
    return (orders.where("customer_id IS NOT NULL AND order_date IS NOT NULL")
            .groupBy("customer_id", "order_date")
            .agg(F.count("*").alias("n_orders"), *extra))


def candidate_counts(orders: DataFrame, sessions: DataFrame) -> DataFrame:
    """customer_id, order_date, n_orders, candidates: how many sessions up to and on
    the order day qualify as touchpoints, counted from daily sums without pairing."""
    per_day = (sessions.where("customer_id IS NOT NULL AND session_date IS NOT NULL")
               .groupBy("customer_id", F.col("session_date").alias("day"))
               .agg(F.count("*").alias("n_sessions")))
    days = orders_per_day(orders).withColumnRenamed("order_date", "day")
    so_far = (Window.partitionBy("customer_id").orderBy("day")
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return (per_day.unionByName(days, allowMissingColumns=True)
            .withColumn("candidates", F.coalesce(F.sum("n_sessions").over(so_far), F.lit(0)))
            .where("n_orders IS NOT NULL AND candidates > 0")
            .select("customer_id", F.col("day").alias("order_date"), "n_orders", "candidates"))


def journeys(orders_by_day: DataFrame, sessions: DataFrame, k: int = LOOKBACK) -> DataFrame:
    """One row per customer and order day that has a session on or before it.

    ``orders_by_day`` comes from ``orders_per_day``; its columns are kept, and
    ``touches`` is added: at most k structs (session_date, session_id and the other
    session columns), oldest first.
    """
    payload = [c for c in sessions.columns if c not in ("customer_id", "session_date", "session_id")]
    measures = [c for c in orders_by_day.columns if c not in ("customer_id", "order_date")]
    visits = last_sessions_per_day(sessions, k).select(
        "customer_id", F.col("session_date").alias("day"), "session_id",
        F.struct("session_date", "session_id", *payload).alias("touch"))
    days = orders_by_day.withColumnRenamed("order_date", "day")

    # Sessions of a day sort before its order row (NULL session ids last).
    in_order = (Window.partitionBy("customer_id")
                .orderBy("day", F.col("session_id").asc_nulls_last())
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last_k = (Window.partitionBy("customer_id").orderBy("nth").rangeBetween(-(k - 1), 0))
    return (visits.unionByName(days, allowMissingColumns=True)
            .withColumn("nth", F.count("touch").over(in_order))
            .withColumn("touches", F.collect_list("touch").over(last_k))
            .where(F.col("n_orders").isNotNull() & (F.col("nth") > 0))
            .select("customer_id", F.col("day").alias("order_date"), *measures, "touches"))


def order_journeys(orders: DataFrame, sessions: DataFrame, k: int = LOOKBACK,
                   rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """One row per order with its ``touches``.

    Journeys go back to the orders by customer and day. A day with more than
    ``rows_per_salt`` orders of one customer is split into salts, its journey copied
    once per salt. There are at most |orders| / rows_per_salt such days, a short list
    that is safe to broadcast; all other rows join unsalted.
    """
    per_day = orders_per_day(orders)
    key = ["customer_id", "order_date"]
    walks = journeys(per_day, sessions, k).select(
        *key, "touches",
        F.explode(F.sequence(F.lit(0), salts(F.col("n_orders"), rows_per_salt) - 1))
        .alias("_salt"))
    hot = (per_day.where(F.col("n_orders") > rows_per_salt)
           .select(*key, salts(F.col("n_orders"), rows_per_salt).alias("_salts")))
    salted = (orders.join(F.broadcast(hot), key, "left")
              .withColumn("_salt", F.coalesce(
                  F.pmod(F.xxhash64("order_id"), F.col("_salts")).cast("int"), F.lit(0)))
              .drop("_salts"))
    return salted.join(walks, [*key, "_salt"]).drop("_salt")


def last_k_sessions(orders: DataFrame, sessions: DataFrame, k: int = LOOKBACK) -> DataFrame:
    """One row per order and touch: the order and session columns and
    ``touchpoint_order``, 1 for the oldest of the last k sessions."""
    walks = order_journeys(orders.select("order_id", "customer_id", "order_date"), sessions, k)
    return (walks.select("customer_id", "order_id", "order_date",
                         F.posexplode("touches").alias("_pos", "_touch"))
            .select("customer_id", "order_id", "order_date", "_touch.*",
                    (F.col("_pos") + 1).alias("touchpoint_order")))


def build_touchpoints(orders: DataFrame, sessions: DataFrame, channels: DataFrame,
                      k: int = LOOKBACK) -> DataFrame:
    """The touchpoint table: customer_id, order_id, channel_id (NULL when unknown),
    touchpoint_timestamp, touchpoint_order."""
    visits = match_channel(
        sessions.select("customer_id", "session_date", "session_id", "traffic_source",
                        "traffic_medium"), channels).drop("traffic_source", "traffic_medium")
    return (last_k_sessions(orders, visits, k)
            .select("customer_id", "order_id", "channel_id",
                    F.col("session_date").cast("timestamp_ntz").alias("touchpoint_timestamp"),
                    "touchpoint_order"))


def touchpoint_summary(tp: DataFrame) -> DataFrame:
    """Touchpoints in all, per order, and without a channel. Every order has exactly
    one touchpoint numbered 1, so orders are counted without a distinct."""
    orders = F.count_if(F.col("touchpoint_order") == 1)
    return tp.agg(
        F.count("*").alias("total_touchpoints"),
        F.coalesce(F.round(F.count("*").cast("decimal(20,0)")
                           / F.nullif(orders.cast("decimal(20,0)"), F.lit(0)), 2),
                   F.lit(0).cast("decimal(20,2)")).alias("avg_touchpoints_per_order"),
        F.count_if(F.col("channel_id").isNull()).alias("unmatched_channels"))
