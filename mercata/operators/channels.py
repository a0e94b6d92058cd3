"""Channel dimension, spend calibration and allocation, campaign assignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.functions.columns import channel_key, channel_type
from mercata.operators.keys import ROWS_PER_SALT, first_seen_ids, join_by_key
from mercata.session import scratch_folder

# Spend multiplier per weekday, Monday first.
WEEKDAY_MULTIPLIERS = (1.2, 1.2, 1.1, 1.1, 1.0, 0.7, 0.7)


def _named(events: DataFrame) -> DataFrame:
    return events.na.fill("unknown", ["traffic_source", "traffic_medium"])


def channel_dimension(events: DataFrame, order_by: Sequence[str], scratch: str | None = None) -> DataFrame:
    """One row per lowered (source, medium): channel_id, channel_name, channel_type. Ids are 1..n in
    the order in which channels first appear by ``order_by`` (the order of the file).

    Names are lowered before they are made distinct, so spellings that differ only
    in case are one channel and a join on the name never multiplies rows.
    """
    named = _named(events).select(
        F.lower("traffic_medium").alias("medium"), *order_by,
        channel_key(F.col("traffic_source"), F.col("traffic_medium")).alias("channel_name"))
    return first_seen_ids(named, "channel_name", order_by, "channel_id",
                          scratch or scratch_folder(events.sparkSession, "channels"), [F.min("medium").alias("medium")]).select(
        "channel_id", "channel_name", channel_type(F.col("medium")).alias("channel_type"))


def paying_customers_by_channel(events: DataFrame) -> DataFrame:
    """Distinct purchasers per (source, medium)."""
    return (_named(events).where("event_name = 'purchase'")
            .groupBy(F.col("traffic_source").alias("source"),
                     F.col("traffic_medium").alias("medium"))
            .agg(F.count_distinct("user_pseudo_id").alias("paying_customers")))


def payers_by_channel(events: DataFrame) -> DataFrame:
    """Distinct purchasers per channel key: spellings of one channel share their customers."""
    return (_named(events).where("event_name = 'purchase'")
            .groupBy(channel_key(F.col("traffic_source"), F.col("traffic_medium")).alias("channel_name"))
            .agg(F.count_distinct("user_pseudo_id").alias("paying_customers")))


def calibrated_spend(channels: DataFrame, paying: DataFrame, target_cac) -> DataFrame:
    """Spend that buys each paid channel its paying customers (``payers_by_channel``) at
    ``target_cac`` each."""
    cac = F.lit(str(target_cac)).cast("decimal(18,2)")
    return (channels.where("channel_type = 'paid'")
            .join(paying, "channel_name", "left")
            .select("channel_id",
                    (F.coalesce(F.col("paying_customers"), F.lit(0)).cast("decimal(18,0)") * cac)
                    .cast("decimal(18,2)").alias("total_spend")))


def allocate(df: DataFrame, weight: str, total: str | Column, by: str,
             rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Add ``share`` (weight within its ``by`` group) and ``amount`` (share of total).

    The group sum is pre-aggregated and joined, not a window: a group with much of the
    data is summed in parts, joined in parts, and never gathered in one task.
    """
    total = F.col(total) if isinstance(total, str) else total
    # Weights are summed as decimals, so the share does not depend on row order.
    sums = df.groupBy(by).agg(F.sum(F.col(weight).cast("decimal(28,10)")).alias("_sum"),
                              F.count("*").alias("count"))
    share = F.col(weight).cast("double") / F.nullif(F.col("_sum").cast("double"), F.lit(0.0))
    return (join_by_key(df, sums.drop("count"), by, "inner", rows_per_salt,
                        sums.select(by, "count"))
            .withColumn("share", share)
            .withColumn("amount", F.round((F.col("share") * total.cast("double"))
                                          .cast("decimal(28,10)"), 2).cast("decimal(18,2)"))
            .drop("_sum"))


def weekday_weight(day: Column, multipliers=WEEKDAY_MULTIPLIERS) -> Column:
    """Multiplier of the weekday of ``day``."""
    return F.get(F.array(*[F.lit(float(m)) for m in multipliers]), F.weekday(day))


def daily_spend_curve(spark: SparkSession, start: str | Column, end: str | Column,
                      multipliers=WEEKDAY_MULTIPLIERS,
                      spikes: Mapping[str, float] | None = None) -> DataFrame:
    """Calendar of spend_date and weight; ``spikes`` multiplies single days."""
    days = spark.range(1).select(F.explode(F.sequence(
        *[(F.lit(d) if isinstance(d, str) else d).cast("date") for d in (start, end)]))
        .alias("spend_date"))
    weight = weekday_weight(F.col("spend_date"), multipliers)
    for day, factor in (spikes or {}).items():
        weight = weight * F.when(F.col("spend_date") == F.lit(day).cast("date"),
                                 F.lit(float(factor))).otherwise(F.lit(1.0))
    return days.withColumn("weight", F.greatest(weight, F.lit(0.0)))


def assign_campaign(daily: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Campaign of each (channel, day) spend row: the lowest id active that day, else
    the channel's lowest id. Spend of a channel without campaigns is left out.

    A campaign without start or end is never active. The interval is turned into days first (clipped to the days spent on), so the
    join is on equality and a channel's rows are not paired with all its campaigns.
    """
    span = daily.agg(F.struct(F.min("spend_date").alias("lo"),
                              F.max("spend_date").alias("hi")).alias("s")).scalar()
    clipped = (campaigns.select("*", span.alias("s"))
               .select("channel_id", "campaign_id",
                       F.greatest("start_date", "s.lo").alias("lo"),
                       F.least("end_date", "s.hi").alias("hi"))
               .where("start_date IS NOT NULL AND end_date IS NOT NULL AND lo <= hi"))
    active = (clipped.select("channel_id", "campaign_id",
                             F.explode(F.sequence("lo", "hi")).alias("spend_date"))
              .groupBy("channel_id", "spend_date").agg(F.min("campaign_id").alias("_active")))
    first = campaigns.groupBy("channel_id").agg(F.min("campaign_id").alias("_first"))
    return (daily.join(first, "channel_id")
            .join(active, ["channel_id", "spend_date"], "left")
            .select("channel_id", F.coalesce("_active", "_first").alias("campaign_id"),
                    "spend_date", "amount"))


def planned_ad_spend(events: DataFrame, dimension: DataFrame, campaigns: DataFrame, start: str, end: str,
                     target_cac) -> DataFrame:
    """Daily spend of every paid channel of ``dimension``: the spend that buys its paying customers at
    ``target_cac``, spread over the days by weekday and booked on the campaign active
    that day. Channels without a paying customer are not spent on."""
    totals = calibrated_spend(dimension, payers_by_channel(events), target_cac)
    days = F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")))
    curve = (totals.where("total_spend > 0")
             .select("channel_id", "total_spend", days.alias("spend_date"))
             .withColumn("weight", F.greatest(weekday_weight(F.col("spend_date")), F.lit(0.0))))
    daily = allocate(curve, "weight", "total_spend", "channel_id")
    return assign_campaign(daily.select("channel_id", "spend_date", "amount"), campaigns)
