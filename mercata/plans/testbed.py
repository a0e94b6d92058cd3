"""The test tables in the shapes the operators read.

Two families that never meet by date: E is made from ``events`` (sessions, funnel,
attribution, spend), O from the order tables (cohorts, lifetime value, pricing).
Every frame is derived from whole tables; ``oracle.py`` states the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.functions.columns import money, session_key, ts_to_micros
from mercata.operators import channels as ch
from mercata.operators import marts

EVENT_NAME = {"view": "view_item", "click": "add_to_cart", "signup": "begin_checkout",
              "purchase": "purchase", "error": "page_view"}
# Source and medium by k % 6; class 5 has no channel row, class 3 comes in two spellings.
CLASSES = (("google", "organic"), ("google", "cpc"), ("(direct)", "(none)"),
           ("<Other>", "referral"), ("newsletter", "email"), ("unknown", "unknown"))
CHANNEL_ROWS = [(1, "google / organic", "organic"), (2, "google / cpc", "paid"),
                (3, "(direct) / (none)", "direct"), (4, "<other> / referral", "referral"),
                (5, "newsletter / email", "email")]
COUNTRIES = ("United States", "Canada", "India", "Germany")
DEVICES = ("desktop", "mobile", "tablet")
TARGET_CAC = 25


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pick(values, index: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), index)


# --- family E ------------------------------------------------------------

def _event_name() -> Column:
    name = F.lit(None).cast("string")
    for event_type, event_name in EVENT_NAME.items():
        name = F.when(F.col("event_type") == event_type, event_name).otherwise(name)
    return name


def _day_number(day: str) -> Column:
    """2024-01-05 as the whole number 20240105."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def base_events(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf, "events").select(
        "event_id", "ts", F.to_date("ts").alias("event_date"),
        F.col("user_id").cast("string").alias("user_pseudo_id"),
        _event_name().alias("event_name"), money(F.col("value")).alias("value"), k.alias("k"))


def _source(k: Column) -> Column:
    return F.when(k % 12 == 9, "<other>").otherwise(_pick([s for s, _ in CLASSES], k % 6))


def _medium(k: Column) -> Column:
    return _pick([m for _, m in CLASSES], k % 6)


def staged_events(spark: SparkSession, sf: str) -> DataFrame:
    """Clean flat events, plus ``event_id`` to break ties."""
    k, bought = F.col("k"), F.col("event_name") == "purchase"
    day_number = _day_number("event_date")
    return base_events(spark, sf).select(
        "event_id", "event_date", F.col("ts").alias("event_datetime"), "event_name",
        "user_pseudo_id", day_number.alias("ga_session_id"),
        session_key(F.col("user_pseudo_id"), day_number).alias("session_id"),
        F.concat(F.lit("https://shop.example/p/"), k.cast("string")).alias("page_location"),
        _source(k).alias("traffic_source"), _medium(k).alias("traffic_medium"),
        F.when(k % 6 == 1, "spring_sale").otherwise("(not set)").alias("campaign_name"),
        _pick(DEVICES, k % 3).alias("device_category"),
        _pick(COUNTRIES, k % 4).alias("country"),
        F.when(bought, F.concat(F.lit("T"), F.col("event_id").cast("string")))
        .alias("transaction_id"),
        F.when(bought, F.col("value")).alias("items_value"),
        F.lit(False).alias("is_flagged_incomplete_purchase"))


def _items(k: Column, event_id: Column, value: Column) -> Column:
    """0 to 2 items per event; some have no price."""
    def item(i: Column) -> Column:
        number = (k * 7 + i * 13) % 50
        price = F.when((event_id + i) % 19 != 0, (value + i).cast("decimal(18,2)"))
        return F.struct(
            F.concat(F.lit("SKU"), number.cast("string")).alias("item_id"),
            F.concat(F.lit("Item "), number.cast("string")).alias("item_name"),
            F.concat(F.lit("cat"), (number % 5).cast("string")).alias("item_category"),
            price.alias("price"), (1 + (event_id + i) % 3).cast("int").alias("quantity"))

    n = k % 3
    numbers = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(numbers, item)


def nested_events(spark: SparkSession, sf: str) -> DataFrame:
    """The nested export shape; every eleventh event lacks its session id."""
    k, eid = F.col("k"), F.col("event_id")
    day = _day_number("event_date").cast("string")

    def param(key: str, text: Column, number: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), F.struct(
            text.cast("string").alias("string_value"),
            number.cast("bigint").alias("int_value")).alias("value"))

    params = F.array(
        param("page_location", F.concat(F.lit("https://shop.example/p/"), k.cast("string")),
              F.lit(None)),
        param("ga_session_id", F.lit(None), day))
    return base_events(spark, sf).select(
        "event_id", day.alias("event_date"), ts_to_micros(F.col("ts")).alias("event_timestamp"),
        "event_name", "user_pseudo_id",
        F.when(eid % 11 == 0, F.slice(params, 1, 1)).otherwise(params).alias("event_params"),
        F.struct(_source(k).alias("source"), _medium(k).alias("medium"),
                 F.when(k % 6 == 1, "spring_sale").otherwise("(not set)").alias("name"))
        .alias("traffic_source"),
        F.struct(_pick(DEVICES, k % 3).alias("category")).alias("device"),
        F.struct(_pick(COUNTRIES, k % 4).alias("country")).alias("geo"),
        F.struct(F.when(F.col("event_name") == "purchase",
                        F.concat(F.lit("T"), eid.cast("string"))).alias("transaction_id"))
        .alias("ecommerce"),
        _items(k, eid, F.col("value")).alias("items"))


def staged_items(spark: SparkSession, sf: str) -> DataFrame:
    """Clean flat items of all but page views."""
    item = F.explode(_items(F.col("k"), F.col("event_id"), F.col("value")))
    day_number = _day_number("event_date")
    return (base_events(spark, sf).where("event_name <> 'page_view'")
            .select("*", item.alias("item"))
            .select("event_date", F.col("ts").alias("event_datetime"), "user_pseudo_id",
                    day_number.alias("ga_session_id"),
                    session_key(F.col("user_pseudo_id"), day_number).alias("session_id"),
                    "event_name",
                    F.when(F.col("event_name") == "purchase",
                           F.concat(F.lit("T"), F.col("event_id").cast("string")))
                    .alias("transaction_id"),
                    "item.item_id", "item.item_name", "item.item_category",
                    F.coalesce("item.price", F.lit(0).cast("decimal(18,2)")).alias("price"),
                    "item.quantity"))


def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    """Flat raw events with dirt, and ``line_no`` for the order of the file."""
    eid = F.col("event_id")

    def unless(step: int, c: Column) -> Column:
        return F.when(eid % step != 0, c)

    clean = staged_events(spark, sf).select(
        (eid * 2).alias("line_no"),
        F.when(eid % 97 == 0, "2024-13-99")
        .otherwise(_day_number("event_date").cast("string")).alias("event_date"),
        ts_to_micros(F.col("event_datetime")).alias("event_timestamp"), "event_name",
        unless(101, F.col("user_pseudo_id")).alias("user_pseudo_id"), "ga_session_id",
        "page_location", unless(17, F.col("traffic_source")).alias("traffic_source"),
        unless(19, F.col("traffic_medium")).alias("traffic_medium"), "campaign_name",
        "device_category", unless(31, F.col("country")).alias("country"),
        unless(13, F.col("transaction_id")).alias("transaction_id"),
        F.when(eid % 29 == 0, -F.col("items_value")).otherwise(F.col("items_value"))
        .cast("decimal(18,2)").alias("items_value"),
        unless(101, F.col("session_id")).alias("session_id"))
    again = (clean.where(F.col("line_no") % 46 == 0)
             .withColumns({"line_no": F.col("line_no") + 1, "campaign_name": F.lit("repeated")}))
    return clean.unionByName(again)


def raw_items(spark: SparkSession, sf: str) -> DataFrame:
    """Flat raw items with dirt and repeated lines."""
    eid = F.col("event_id")
    item = F.posexplode(_items(F.col("k"), eid, F.col("value")))
    day_number = _day_number("event_date")
    clean = (base_events(spark, sf).where("event_name <> 'page_view'")
             .select("*", item.alias("pos", "item"))
             .select((eid * 8 + F.col("pos") * 2).alias("line_no"),
                     _day_number("event_date").cast("string").alias("event_date"),
                     ts_to_micros(F.col("ts")).alias("event_timestamp"), "user_pseudo_id",
                     day_number.alias("ga_session_id"), "event_name",
                     F.when(F.col("event_name") == "purchase",
                            F.concat(F.lit("T"), eid.cast("string"))).alias("transaction_id"),
                     F.when(eid % 37 != 0, F.col("item.item_id")).alias("item_id"),
                     F.when(eid % 41 != 0, F.col("item.item_name")).alias("item_name"),
                     "item.item_category",
                     F.when(eid % 43 == 0, -F.col("item.price")).otherwise(F.col("item.price"))
                     .cast("decimal(18,2)").alias("price"),
                     F.when(eid % 47 == 0, -F.col("item.quantity"))
                     .when(eid % 53 == 0, 0).otherwise(F.col("item.quantity")).alias("quantity"),
                     session_key(F.col("user_pseudo_id"), day_number).alias("session_id")))
    again = (clean.where(F.floor(F.col("line_no") / 8) % 23 == 0)
             .withColumns({"line_no": F.col("line_no") + 1, "item_category": F.lit("repeated")}))
    return clean.unionByName(again)


def channel_rows(spark: SparkSession) -> DataFrame:
    """The channel dimension used for look-ups (five rows)."""
    rows = ", ".join(f"({i}, '{name}', '{kind}')" for i, name, kind in CHANNEL_ROWS)
    return spark.sql("SELECT * FROM VALUES " + rows
                     + " AS c(channel_id, channel_name, channel_type)")


def staged_channels(spark: SparkSession, sf: str) -> DataFrame:
    """Channel rows as found in the events: one per user and class, many repeated."""
    cls = F.col("k") % 6
    return (base_events(spark, sf).where(cls < 5)
            .select((cls + 1).alias("channel_id"),
                    F.lower(F.concat(_source(F.col("k")), F.lit(" / "), _medium(F.col("k"))))
                    .alias("channel_name"),
                    F.when(F.col("event_id") % 7 != 0, _pick([t for _, _, t in CHANNEL_ROWS], cls))
                    .alias("channel_type"),
                    F.col("event_id").alias("line_no")))


def raw_campaigns(spark: SparkSession, sf: str) -> DataFrame:
    """One campaign per paid k; every fifth has its dates exchanged, one lacks a channel."""
    k = F.col("k")
    paid = (base_events(spark, sf).where("k % 6 = 1").groupBy("k")
            .agg(F.min("event_date").alias("d"), F.sum("value").alias("budget")))
    first = F.date_trunc("month", F.col("d")).cast("date")
    lo, hi = F.date_add(first, k % 20), F.date_add(F.date_add(first, k % 20), k % 9)
    return paid.select(
        k.alias("campaign_id"), F.when(k != 31, 2).cast("int").alias("channel_id"),
        F.concat(F.lit("google / cpc - Campaign "), k.cast("string")).alias("campaign_name"),
        F.when(k % 5 == 0, hi).otherwise(lo).cast("string").alias("start_date"),
        F.when(k % 5 == 0, lo).otherwise(hi).cast("string").alias("end_date"),
        F.col("budget").cast("decimal(18,2)").alias("budget"))


def campaigns(spark: SparkSession, sf: str) -> DataFrame:
    from mercata.operators.clean import clean_campaigns
    return clean_campaigns(raw_campaigns(spark, sf)).rows


def daily_spend(spark: SparkSession, sf: str) -> DataFrame:
    """Paid channel: per day half the value of its cart events."""
    return (base_events(spark, sf).where("k % 6 = 1 AND event_name = 'add_to_cart'")
            .groupBy((F.col("k") % 6 + 1).alias("channel_id"), "event_date")
            .agg(F.sum("value").alias("v"))
            .select("channel_id", F.col("event_date").alias("spend_date"),
                    F.round(F.col("v").cast("decimal(20,2)") / 2, 2).cast("decimal(18,2)")
                    .alias("amount")))


def ad_spend(spark: SparkSession, sf: str) -> DataFrame:
    return ch.assign_campaign(daily_spend(spark, sf), campaigns(spark, sf)).select(
        _day_number("spend_date").cast("int").alias("spend_id"), "channel_id",
        "campaign_id", "spend_date", "amount")


def raw_ad_spend(spark: SparkSession, sf: str) -> DataFrame:
    """Spend lines per cart event of the paid channel: repeated days, bad amounts."""
    return (base_events(spark, sf).where("k % 6 = 1 AND event_name = 'add_to_cart'")
            .select(F.col("event_id").alias("line_no"), F.lit(2).alias("channel_id"),
                    F.col("k").alias("campaign_id"),
                    F.col("event_date").cast("string").alias("spend_date"),
                    F.when(F.col("event_id") % 3 == 0, -F.col("value"))
                    .when(F.col("event_id") % 5 != 0, F.col("value"))
                    .cast("decimal(18,2)").alias("amount")))


def e_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return marts.mart_sessions(staged_events(spark, sf), ["event_id"])


def e_events(spark: SparkSession, sf: str) -> DataFrame:
    return marts.mart_events(staged_events(spark, sf))


def e_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders: every purchase event is one transaction, so no grouping is needed. The
    filter is on the stored column and reaches the Parquet scan."""
    day = _day_number("order_date")
    return (table(spark, sf, "events").where("event_type = 'purchase'")
            .select(F.concat(F.lit("T"), F.col("event_id").cast("string")).alias("order_id"),
                    F.col("user_id").cast("string").alias("customer_id"),
                    F.to_date("ts").alias("order_date"), money(F.col("value")).alias("order_total"))
            .select("order_id", "customer_id",
                    session_key(F.col("customer_id"), day).alias("session_id"), "order_date",
                    F.lit("completed").alias("order_status"), "order_total"))


# --- family O ------------------------------------------------------------

def o_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.concat(F.col("o_custkey").cast("string"), F.lit("_"),
                 _day_number("o_orderdate").cast("string")).alias("session_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
        money(F.col("o_totalprice")).alias("order_total"))


def o_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """One session per customer and order day; priority of its lowest order key sets
    the channel class."""
    cls = F.substring("o_orderpriority", 1, 1).cast("int") - 1
    first = F.min(F.struct("o_orderkey", cls.alias("cls")))
    return (table(spark, sf, "orders")
            .groupBy("o_custkey", F.to_date("o_orderdate").alias("session_date"))
            .agg(first.alias("f"))
            .select(F.concat(F.col("o_custkey").cast("string"), F.lit("_"),
                             _day_number("session_date").cast("string")).alias("session_id"),
                    F.col("o_custkey").cast("string").alias("customer_id"), "session_date",
                    _pick([s for s, _ in CLASSES], F.col("f.cls")).alias("traffic_source"),
                    _pick([m for _, m in CLASSES], F.col("f.cls")).alias("traffic_medium")))


def o_customers(spark: SparkSession, sf: str) -> DataFrame:
    seen = (table(spark, sf, "orders").groupBy("o_custkey")
            .agg(F.to_date(F.min("o_orderdate")).alias("first_seen_date")))
    return (table(spark, sf, "customer")
            .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(seen, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select(F.col("c_custkey").cast("string").alias("customer_id"), "first_seen_date",
                    F.col("n_name").alias("country")))


def o_products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), money(F.col("p_retailprice")).alias("base_price"))


def o_order_items(spark: SparkSession, sf: str) -> DataFrame:
    """Sold at list price less the line's discount."""
    cents = F.col("p_retailprice").cast("decimal(18,2)") * (
        F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    return (table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_discount")
            .join(table(spark, sf, "part").select("p_partkey", "p_retailprice"),
                  F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_orderkey").cast("string").alias("order_id"),
                    F.col("l_partkey").cast("string").alias("product_id"),
                    F.col("l_quantity").cast("int").alias("quantity"),
                    F.round(cents, 2).cast("decimal(18,2)").alias("unit_price")))
