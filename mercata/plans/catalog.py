"""One query per operator over the test tables. ``oracle.py`` has the matching SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from mercata import schemas
from mercata.functions import columns as c
from mercata.functions import grounding as g
from mercata.operators import (analytics, attribution, budget, channels, clean, marts, quality,
                               stats, touchpoints)
from mercata.plans import gate
from mercata.plans import testbed as t
from mercata.plans import views as v
from mercata.session import scratch_folder
from mercata.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FIRST_DAY, LAST_DAY = "1995-06-01", "2001-01-31"  # allowed order dates in the checks


def query(f: Query) -> Query:
    """Register ``f`` under its name."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return v.presentable(f(spark, sf))
    QUERIES[f.__name__] = run
    return f


# --- sources -------------------------------------------------------------

def _stored_export(spark, sf) -> str:
    """Daily shards of two shapes: early ones lack ``geo`` and have narrow quantities. Some events
    have a name that no scan keeps."""
    path = scratch_folder(spark, "events")
    nested = t.nested_events(spark, sf).withColumn(
        "event_name", F.when(F.col("event_id") % 13 == 0, "session_start").otherwise(F.col("event_name")))
    item = lambda kind: F.transform("items", lambda i: i.withField("quantity", i["quantity"].cast(kind)))
    early = F.col("event_date") < "20240115"
    writers.write_partitioned(nested.where(early).drop("geo").withColumn("items", item("int")), path, "event_date")
    writers.write_partitioned(nested.where(~early).withColumn("items", item("bigint")), path, "event_date", mode="append")
    return path


EXPORT = StructType([*schemas.NESTED_EVENT.fields, StructField("event_id", LongType())])


def _units() -> Column:
    return F.aggregate("items", F.lit(0).cast("bigint"), lambda n, i: n + i["quantity"])


@query
def scan_events_nested(spark, sf):
    scan = readers.scan_events(spark, _stored_export(spark, sf), "20240108", "20240121", schema=EXPORT)
    return scan.select("event_id", "event_date", "event_timestamp", "event_name", "user_pseudo_id",
                       F.col("geo.country").alias("country"), F.size("items").alias("n_items"), _units().alias("units"))


@query
def scan_items_nested(spark, sf):
    scan = readers.scan_events(spark, _stored_export(spark, sf), "20240105", "20240118",
                               readers.ITEM_EVENT_NAMES, schema=EXPORT)
    return scan.select("event_id", "event_date", "event_name", F.size("items").alias("n_items"), _units().alias("units"))


@query
def read_csv_typed(spark, sf):
    path = scratch_folder(spark, "raw-csv")
    writers.write_csv(t.raw_events(spark, sf), path)
    return readers.read_csv(spark, path, schemas.RAW_EVENTS)


@query
def read_csv_records(spark, sf):
    """Texts with quotes and line breaks, written as CSV and read back by many tasks."""
    path = scratch_folder(spark, "texts-csv")
    writers.write_csv(t.table(spark, sf, "documents").select("doc_id", "lang", "text"), path)
    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType())])
    return readers.read_csv(spark, path, schema, multiline=True).select(
        "doc_id", "lang", F.char_length("text").alias("length"), F.md5(F.col("text").cast("binary")).alias("digest"))


@query
def read_columns(spark, sf):
    return readers.read_columns(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_custkey"])


@query
def read_view(spark, sf):
    analytics.pricing_analytics(t.o_order_items(spark, sf), t.o_products(spark, sf),
                                ordered=False).createOrReplaceTempView("vw_pricing_analytics")
    return readers.read_view(spark, "vw_pricing_analytics", where="discount_pct >= 5",
                             order=[F.desc("product_revenue"), F.col("product_id")], limit=50,
                             columns=["product_id", "discount_pct", "product_revenue"])


# --- sinks ---------------------------------------------------------------

@query
def write_csv(spark, sf):
    path = scratch_folder(spark, "csv")
    writers.write_csv(t.o_order_items(spark, sf), path)
    return (readers.read_csv(spark, path, schemas.ORDER_ITEMS)
            .groupBy("product_id").agg(F.count("*").alias("n"), F.sum("quantity").alias("units"),
                                       F.sum("unit_price").alias("price_sum")))


@query
def full_refresh(spark, sf):
    """The last version, after one of other rows and a run that fails while it writes."""
    path, orders = scratch_folder(spark, "orders"), t.o_orders(spark, sf)
    writers.full_refresh(orders.where("order_total < 100000"), path)
    writers.full_refresh(orders, path)
    fails = F.when(F.col("order_total") > 0, F.raise_error(F.lit("refused"))).otherwise(F.col("order_id"))
    try:
        writers.full_refresh(orders.withColumn("order_id", fails), path)
    except PySparkException as e:
        if "refused" not in str(e):
            raise
    return writers.read_table(spark, path)


@query
def append_log(spark, sf):
    path = scratch_folder(spark, "quality-log")
    m = _order_marts(spark, sf)
    for run in ("monday", "tuesday", "monday"):  # a run that is repeated adds nothing
        writers.append_log(quality.dq_report(quality.null_checks(m)).log, path, run)
    return writers.read_table(spark, path).drop("run_timestamp")


@query
def conform_schema(spark, sf):
    lacking = t.staged_items(spark, sf).drop("event_datetime").withColumn("extra", F.lit(1))
    return writers.conform_schema(lacking, schemas.STAGED_ITEMS)


@query
def row_counts(spark, sf):
    return writers.row_counts({
        "stg_marketing_channels": t.staged_channels(spark, sf),
        "stg_campaigns": t.campaigns(spark, sf), "stg_ad_spend": t.ad_spend(spark, sf),
        "stg_ga4_events": t.staged_events(spark, sf), "stg_ga4_items": t.staged_items(spark, sf)})


# --- nested extraction ---------------------------------------------------

@query
def event_param(spark, sf):
    p = F.col("event_params")
    return t.nested_events(spark, sf).select(
        "event_id", c.event_param(p, "ga_session_id").alias("ga_session_id"),
        c.event_param(p, "page_location", "string_value").alias("page_location"))


@query
def items_value(spark, sf):
    return t.nested_events(spark, sf).select(
        "event_id", c.items_value(F.col("items")).alias("items_value"))


@query
def explode_items(spark, sf):
    return readers.explode_items(t.nested_events(spark, sf)
                                 .where(F.col("event_name").isin(*readers.ITEM_EVENT_NAMES)))


@query
def flatten_struct(spark, sf):
    return readers.flatten_events(t.nested_events(spark, sf))


@query
def session_key(spark, sf):
    return t.nested_events(spark, sf).select("event_id", c.session_key(
        F.col("user_pseudo_id"), c.event_param(F.col("event_params"), "ga_session_id"))
        .alias("session_id"))


# --- cleaning ------------------------------------------------------------

@query
def parse_date_coerce(spark, sf):
    return t.raw_events(spark, sf).select(
        "line_no", c.parse_date(F.col("event_date")).alias("event_date"))


@query
def epoch_micros(spark, sf):
    return t.raw_events(spark, sf).select(
        "line_no", c.micros_to_ts(F.col("event_timestamp")).alias("event_datetime"))


@query
def dedup_first(spark, sf):
    return clean.dedup_first(t.raw_events(spark, sf), clean.EVENT_KEY, ["line_no"])


@query
def drop_null_keys(spark, sf):
    return clean.drop_null_keys(t.raw_events(spark, sf), ["user_pseudo_id", "event_name"]) \
        .select("line_no", "user_pseudo_id", "event_name")


@query
def fill_unknown(spark, sf):
    return clean.fill_unknown(t.raw_events(spark, sf), clean.EVENT_FILL) \
        .select("line_no", *clean.EVENT_FILL)


@query
def negative_to_null(spark, sf):
    return t.raw_events(spark, sf).select(
        "line_no", c.negative_to_null(F.col("items_value")).alias("items_value"))


@query
def invalid_to_default(spark, sf):
    return t.raw_items(spark, sf).select(
        "line_no", c.invalid_to_default(F.col("price"), 0).alias("price"),
        c.invalid_to_default(F.col("quantity"), 1).alias("quantity"))


@query
def flag_incomplete_purchase(spark, sf):
    return clean.flag_incomplete_purchase(t.raw_events(spark, sf)) \
        .select("line_no", "event_name", "transaction_id", "is_flagged_incomplete_purchase")


@query
def swap_inverted_dates(spark, sf):
    parsed = t.raw_campaigns(spark, sf).withColumns({
        d: c.parse_date(F.col(d), "yyyy-MM-dd") for d in ("start_date", "end_date")})
    return clean.swap_inverted_dates(parsed)


@query
def cleaning_log(spark, sf):
    return clean.cleaning_log(
        clean.clean_events(t.raw_events(spark, sf), ["line_no"]),
        clean.clean_channels(t.staged_channels(spark, sf), ["line_no"]),
        clean.clean_campaigns(t.raw_campaigns(spark, sf)),
        clean.clean_ad_spend(t.raw_ad_spend(spark, sf), ["line_no"]),
        clean.clean_items(t.raw_items(spark, sf), ["line_no"]))


@query
def clean_ga4_events(spark, sf):
    return writers.conform_schema(
        clean.clean_events(t.raw_events(spark, sf), ["line_no"]).rows, schemas.STAGED_EVENTS)


@query
def clean_ga4_items(spark, sf):
    return writers.conform_schema(
        clean.clean_items(t.raw_items(spark, sf), ["line_no"]).rows, schemas.STAGED_ITEMS)


@query
def clean_ad_spend(spark, sf):
    return clean.clean_ad_spend(t.raw_ad_spend(spark, sf), ["line_no"]).rows


# --- channels and spend --------------------------------------------------

@query
def channel_dimension(spark, sf):
    return channels.channel_dimension(t.raw_events(spark, sf), ["line_no"])


@query
def channel_type(spark, sf):
    return (t.staged_events(spark, sf)
            .select("event_id", c.channel_type(F.col("traffic_medium")).alias("channel_type")))


@query
def paying_customers_by_channel(spark, sf):
    return channels.paying_customers_by_channel(t.raw_events(spark, sf))


def _dimension(spark, sf) -> DataFrame:
    return channels.channel_dimension(t.staged_events(spark, sf), ["event_id"])


@query
def calibrated_spend(spark, sf):
    paying = channels.payers_by_channel(t.staged_events(spark, sf))
    return channels.calibrated_spend(_dimension(spark, sf), paying, t.TARGET_CAC)


@query
def proportional_allocation(spark, sf):
    """Each order's share of its customer's account balance, by order value."""
    orders = t.table(spark, sf, "orders").join(
        t.table(spark, sf, "customer").select("c_custkey", "c_acctbal"),
        F.col("o_custkey") == F.col("c_custkey"))
    out = channels.allocate(orders, "o_totalprice", "c_acctbal", "o_custkey")
    return out.select("o_orderkey", "o_custkey", F.round("share", 10).alias("share"), "amount")


@query
def dow_seasonality(spark, sf):
    """Spend curve over the days that have events, the busiest day doubled."""
    per_day = t.base_events(spark, sf).groupBy(F.col("event_date").alias("spend_date")) \
        .agg(F.count("*").alias("n"))
    days = per_day.agg(F.struct(F.min("spend_date").alias("lo"), F.max("spend_date").alias("hi"))
                       .alias("s")).scalar()
    curve = channels.daily_spend_curve(spark, days["lo"], days["hi"],
                                       spikes={"2024-01-15": 2.0})
    return curve.join(per_day, "spend_date", "left")


@query
def assign_active_campaign(spark, sf):
    return channels.assign_campaign(t.daily_spend(spark, sf), t.campaigns(spark, sf))


@query
def planned_ad_spend(spark, sf):
    """Spend of January for the paid channel found in the events."""
    events = t.staged_events(spark, sf)
    dimension = _dimension(spark, sf)
    paid = dimension.where("channel_type = 'paid'").select("channel_id", "channel_name")
    camps = (t.campaigns(spark, sf).drop("channel_id")
             .withColumn("channel_name", F.regexp_extract("campaign_name", "^(.*) - ", 1))
             .join(paid, "channel_name"))
    return channels.planned_ad_spend(events, dimension, camps, "2024-01-01", "2024-01-31", t.TARGET_CAC)


# --- marts ---------------------------------------------------------------

@query
def mart_channels(spark, sf):
    return marts.mart_channels(clean.clean_channels(t.staged_channels(spark, sf),
                                                    ["line_no"]).rows)


@query
def mart_campaigns(spark, sf):
    rows = t.campaigns(spark, sf)
    return marts.mart_campaigns(rows.unionByName(rows))


@query
def mart_ad_spend(spark, sf):
    rows = t.ad_spend(spark, sf)
    return marts.mart_ad_spend(rows.unionByName(rows))


@query
def mart_products(spark, sf):
    return marts.mart_products(t.staged_items(spark, sf))


@query
def mart_customers(spark, sf):
    return marts.mart_customers(t.staged_events(spark, sf))


@query
def mart_sessions(spark, sf):
    return t.e_sessions(spark, sf)


@query
def mart_events(spark, sf):
    return t.e_events(spark, sf)


@query
def mart_orders(spark, sf):
    cleaned = clean.clean_events(t.raw_events(spark, sf), ["line_no"]).rows
    return marts.mart_orders(cleaned, ["line_no"])


@query
def mart_order_items(spark, sf):
    return marts.mart_order_items(t.staged_items(spark, sf))


@query
def enforce_constraints(spark, sf):
    """Orders from dirty events: valid, or the reason why they are refused."""
    cleaned = clean.clean_events(t.raw_events(spark, sf), ["line_no"]).rows
    sessions = marts.mart_sessions(cleaned, ["line_no"]).where(F.col("traffic_source") != "unknown")
    marked = quality.mark_violations(
        marts.mart_orders(cleaned, ["line_no"]),
        not_null=["order_id", "customer_id", "order_date", "order_total"], pk="order_id",
        fks=[("session_id", sessions, "session_id")])
    return marked.select("order_id", F.coalesce("reason", F.lit("valid")).alias("reason"),
                         "order_total")


@query
def mart_quarantine(spark, sf):
    """Rows that the load gate refuses in marts of the dirty files, by table and reason."""
    events = clean.clean_events(t.raw_events(spark, sf), ["line_no"]).rows
    items = clean.clean_items(t.raw_items(spark, sf), ["line_no"]).rows
    folder = scratch_folder(spark, "gate")

    def keep(name: str, df: DataFrame) -> DataFrame:
        return writers.stored(df, f"{folder}/{name}")

    found = gate.gate({
        "customers": marts.mart_customers(events), "products": marts.mart_products(items),
        "marketing_channels": t.channel_rows(spark),
        "sessions": marts.mart_sessions(events, ["line_no"]),
        "campaigns": t.raw_campaigns(spark, sf), "orders": marts.mart_orders(events, ["line_no"]),
        "events": marts.mart_events(events), "order_items": marts.mart_order_items(items),
        "ad_spend": t.raw_ad_spend(spark, sf).withColumnRenamed("line_no", "spend_id")}, keep)
    return gate.summary(found.refused)


# --- views ---------------------------------------------------------------

def _funnel(spark, sf, ordered=True) -> DataFrame:
    return analytics.funnel_conversion(t.e_events(spark, sf), t.e_sessions(spark, sf), ordered)


def _cac_roas(spark, sf, ordered=True) -> DataFrame:
    return analytics.channel_cac_roas(t.channel_rows(spark), t.ad_spend(spark, sf),
                                      t.e_orders(spark, sf), t.e_sessions(spark, sf), ordered)


def _ltv(spark, sf, ordered=True) -> DataFrame:
    return analytics.customer_ltv(t.o_sessions(spark, sf), t.o_orders(spark, sf), ordered)


def _pricing(spark, sf, ordered=True) -> DataFrame:
    return analytics.pricing_analytics(t.o_order_items(spark, sf), t.o_products(spark, sf),
                                       ordered)


@query
def funnel_conversion(spark, sf):
    return _funnel(spark, sf)


@query
def channel_cac_roas(spark, sf):
    return _cac_roas(spark, sf)


@query
def spend_by_channel(spark, sf):
    return analytics.spend_by_channel(t.ad_spend(spark, sf))


@query
def orders_by_channel(spark, sf):
    return attribution.orders_by_channel(t.e_orders(spark, sf), t.e_sessions(spark, sf),
                                         t.channel_rows(spark))


@query
def first_session(spark, sf):
    return analytics.first_session(t.e_sessions(spark, sf))


@query
def new_paying_customers(spark, sf):
    return analytics.new_paying_customers(t.e_sessions(spark, sf), t.e_orders(spark, sf),
                                          t.channel_rows(spark))


@query
def cohort_retention(spark, sf):
    return analytics.cohort_retention(t.o_orders(spark, sf))


@query
def customer_ltv(spark, sf):
    return _ltv(spark, sf)


@query
def customer_segments(spark, sf):
    return analytics.customer_segments(_ltv(spark, sf, False), vip_orders=12, vip_ltv=3_000_000)


@query
def pricing_analytics(spark, sf):
    return _pricing(spark, sf)


# --- touchpoints and attribution -----------------------------------------

def _attributed(spark, sf) -> DataFrame:
    return attribution.attribute_journeys(t.e_orders(spark, sf), t.e_sessions(spark, sf),
                                          t.channel_rows(spark))


def _last_click(spark, sf) -> DataFrame:
    return attribution.last_click(t.e_orders(spark, sf), t.e_sessions(spark, sf),
                                  t.channel_rows(spark))


def _touchpoints(spark, sf) -> DataFrame:
    return touchpoints.build_touchpoints(t.e_orders(spark, sf), t.e_sessions(spark, sf),
                                         t.channel_rows(spark))


@query
def touchpoint_candidates(spark, sf):
    return touchpoints.candidate_counts(t.e_orders(spark, sf), t.e_sessions(spark, sf))


@query
def last_k_touchpoints(spark, sf):
    return touchpoints.last_k_sessions(t.e_orders(spark, sf), t.e_sessions(spark, sf).select(
        "customer_id", "session_date", "session_id"))


@query
def touchpoint_order(spark, sf):
    return _touchpoints(spark, sf)


@query
def match_channel(spark, sf):
    return touchpoints.match_channel(t.e_sessions(spark, sf), t.channel_rows(spark)) \
        .select("session_id", "traffic_source", "traffic_medium", "channel_id")


@query
def touchpoint_summary(spark, sf):
    return touchpoints.touchpoint_summary(_touchpoints(spark, sf))


@query
def attribution_last_click(spark, sf):
    return _last_click(spark, sf)


@query
def attribution_linear(spark, sf):
    return attribution.linear(_touchpoints(spark, sf), t.e_orders(spark, sf))


@query
def attribution_time_decay(spark, sf):
    return attribution.time_decay(_touchpoints(spark, sf), t.e_orders(spark, sf))


@query
def channel_attribution(spark, sf):
    return _attributed(spark, sf)


@query
def attribution_comparison(spark, sf):
    return attribution.attribution_comparison(_last_click(spark, sf), _attributed(spark, sf),
                                              t.channel_rows(spark))


@query
def attribution_pivot(spark, sf):
    return attribution.attribution_pivot(attribution.attribution_comparison(
        _last_click(spark, sf), _attributed(spark, sf), t.channel_rows(spark), ordered=False))


# --- data quality --------------------------------------------------------

def _order_marts(spark, sf) -> dict[str, DataFrame]:
    return {"customers": t.o_customers(spark, sf), "orders": t.o_orders(spark, sf),
            "order_items": t.o_order_items(spark, sf), "products": t.o_products(spark, sf),
            "sessions": t.o_sessions(spark, sf), "ad_spend": t.ad_spend(spark, sf),
            "campaigns": t.raw_campaigns(spark, sf)}


def _dirty_marts(spark, sf) -> dict[str, DataFrame]:
    """Marts of the raw events before cleaning, loaded twice in part."""
    raw = t.raw_events(spark, sf)
    bought = raw.where("event_name = 'purchase'")
    return {
        "customers": raw.where("country IS NOT NULL").select(
            F.col("user_pseudo_id").alias("customer_id")),
        "orders": bought.select(F.col("transaction_id").alias("order_id"),
                                F.col("user_pseudo_id").alias("customer_id"),
                                F.col("items_value").alias("order_total"),
                                c.parse_date(F.col("event_date")).alias("order_date")),
        "order_items": t.raw_items(spark, sf).where("event_name = 'purchase'").select(
            F.col("transaction_id").alias("order_id"), F.col("item_id").alias("product_id"),
            "quantity", F.col("price").alias("unit_price")),
        "products": t.staged_items(spark, sf).where("price > 100").select(
            F.col("item_id").alias("product_id"), F.col("price").alias("base_price")),
        "sessions": raw.select("session_id", F.col("user_pseudo_id").alias("customer_id")),
        "ad_spend": t.raw_ad_spend(spark, sf),
        "campaigns": t.raw_campaigns(spark, sf)}


@query
def dq_nulls(spark, sf):
    return quality.null_checks(_dirty_marts(spark, sf))


@query
def dq_duplicate_keys(spark, sf):
    return quality.duplicate_key_checks(_dirty_marts(spark, sf))


@query
def dq_orphans(spark, sf):
    return quality.orphan_checks(_dirty_marts(spark, sf))


@query
def dq_invalid_values(spark, sf):
    return quality.invalid_value_checks(_dirty_marts(spark, sf),
                                        quality.value_rules("2024-01-03", "2024-01-28"))


@query
def dq_report(spark, sf):
    return v.quality_checks(_order_marts(spark, sf), FIRST_DAY, LAST_DAY).log \
        .drop("run_timestamp")


@query
def dq_summary(spark, sf):
    return v.quality_checks(_order_marts(spark, sf), FIRST_DAY, LAST_DAY).summary


# --- budget and grounding ------------------------------------------------

def _performance(spark, sf) -> DataFrame:
    return budget.channel_performance(_cac_roas(spark, sf, False), _attributed(spark, sf))


@query
def channel_performance(spark, sf):
    return _performance(spark, sf).withColumn("marginal_roas_signal",
                                              F.round("marginal_roas_signal", 8))


@query
def budget_recommendation(spark, sf):
    return budget.recommend(_performance(spark, sf)).select(
        "channel_name", "roas", "recommend_direction", "suggested_change_pct")


@query
def render_explanation(spark, sf):
    return budget.render_explanation(budget.recommend(_performance(spark, sf))) \
        .select("channel_name", "prompt", "response")


@query
def extract_numbers(spark, sf):
    return t.table(spark, sf, "documents").select(
        "doc_id", F.posexplode(g.extract_numbers(F.col("text"))).alias("pos", "number"))


@query
def unverified_numbers(spark, sf):
    """First number in the text of each page that is not in its address."""
    shown = F.regexp_replace(F.regexp_replace("html", "(?s)^.*<body[^>]*>", ""), "<[^>]*>", " ")
    return t.table(spark, sf, "pages").select(
        "page_id", g.first_unverified(shown, F.col("url")).alias("number"))


@query
def metric_mislabel(spark, sf):
    return t.table(spark, sf, "documents").select(
        "doc_id", g.mislabelled(F.col("text"), "the").alias("flagged"))


def _order_explanations(spark, sf) -> DataFrame:
    """One explanation per order: exact, 1% off, 5% off, or without the metric; returns on both
    sides of both bounds and on them."""
    o = t.table(spark, sf, "orders")
    total = F.col("o_totalprice").cast("decimal(18,2)")
    key = F.col("o_orderkey")
    base = o.select(
        "o_orderkey", F.col("o_orderpriority").alias("channel_name"),
        F.round(total / 10, 2).alias("total_spend"), total.alias("attributed_revenue_linear"),
        F.get(F.array(*[F.lit(r).cast("decimal(18,2)") for r in ("10", "0.5", "0.8", "1.5", "1.51")]),
              (key % 5).cast("int")).alias("roas"),
        (key % 50 + 10).cast("decimal(18,2)").alias("cac"))
    recs = budget.render_explanation(budget.recommend(base))
    factor = F.when(key % 4 == 1, F.lit("1.01")).when(key % 4 == 2, F.lit("1.05")).otherwise("1")
    off = F.round(F.col("attributed_revenue_linear") * factor.cast("decimal(3,2)"), 2)

    def spoken(amount: Column) -> Column:
        return c.plain_number(amount)

    said = F.replace(F.col("response"), spoken(F.col("attributed_revenue_linear")), spoken(off))
    short = F.concat(F.lit("Spent $"), spoken(F.col("total_spend")), F.lit("."))
    return recs.withColumn("response", F.when(key % 4 == 3, short).otherwise(said))


@query
def validation_status(spark, sf):
    return budget.validate_explanations(_order_explanations(spark, sf))


# --- statistics and rankings ---------------------------------------------

def _payers(spark, sf) -> DataFrame:
    return _ltv(spark, sf, False).where("total_orders > 0")


@query
def top_channels_by_views(spark, sf):
    return analytics.top_channels_by_views(_funnel(spark, sf, False))


@query
def top_conversion(spark, sf):
    return analytics.top_conversion(_funnel(spark, sf, False))


def _rounded(df: DataFrame, digits: int) -> DataFrame:
    return df.select(*[F.round(f.name, digits).alias(f.name)
                       if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


@query
def ltv_describe(spark, sf):
    return _rounded(stats.describe_values(_payers(spark, sf), "historical_ltv"), 4)


@query
def ltv_skew(spark, sf):
    return _rounded(stats.adjusted_skewness(_payers(spark, sf), "historical_ltv"), 8)


@query
def ltv_histogram(spark, sf):
    return _rounded(stats.histogram(_payers(spark, sf), "historical_ltv"), 4)


@query
def discount_vs_volume(spark, sf):
    return analytics.discount_vs_volume(_pricing(spark, sf, False))


@query
def top_ltv(spark, sf):
    return analytics.top_n(_ltv(spark, sf, False), [F.desc("historical_ltv"), "customer_id"], 5) \
        .select("customer_id", F.col("acquisition_source").alias("traffic_source"),
                "total_orders", "historical_ltv", "average_order_value")


@query
def top_products(spark, sf):
    return analytics.top_n(_pricing(spark, sf, False), [F.desc("product_revenue"), "product_id"],
                           5) \
        .select("product_name", "base_price", "avg_selling_price", "discount_pct",
                "times_purchased", "product_revenue")


@query
def paid_channels(spark, sf):
    return _cac_roas(spark, sf, False).where("cac IS NOT NULL") \
        .select("channel_id", "total_spend", "total_revenue", "new_paying_customers", "cac",
                "roas").orderBy(F.desc_nulls_last("roas"), "channel_id")


@query
def cohort_head(spark, sf):
    return analytics.top_n(analytics.cohort_retention(t.o_orders(spark, sf), ordered=False),
                           ["cohort_month", "month_number"], 10)
