"""Cleaning of raw event, item, channel, campaign and spend files.

Each ``clean_*`` reads its file once: the first row of a key is an aggregate that counts the
copies and repairs of the key as well, so that the log is taken from the cleaned rows on their
way to the table, and no task keeps all copies of a key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mercata.functions.columns import (invalid_to_default, is_incomplete_purchase, micros_to_ts,
                                       negative_to_null, parse_date)
from mercata.operators.keys import COPIES, first_counted, first_per_key

# Keys that make a row a duplicate, columns filled, fill texts.
EVENT_KEY = ("user_pseudo_id", "event_name", "event_timestamp")
ITEM_KEY = ("user_pseudo_id", "event_name", "event_timestamp", "item_id")
CHANNEL_KEY = ("channel_id",)
SPEND_KEY = ("channel_id", "campaign_id", "spend_date")
EVENT_FILL = {"traffic_source": "unknown", "traffic_medium": "unknown",
              "campaign_name": "unknown", "device_category": "unknown", "country": "unknown",
              "session_id": "unknown_session"}
ITEM_FILL = {"item_name": "unknown", "item_category": "unknown"}
CHANNEL_FILL = {"channel_type": "unknown"}
LOG_COUNTS = ("rows_in", "rows_out", "duplicates_removed", "nulls_fixed", "invalid_values_fixed")


def dedup_first(df: DataFrame, keys: Sequence[str],
                order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first by ``order_by`` (the order of the file)."""
    return first_per_key(df, keys, order_by)


def drop_null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def fill_unknown(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    return df.na.fill(dict(values))


def flag_incomplete_purchase(df: DataFrame) -> DataFrame:
    return df.withColumn("is_flagged_incomplete_purchase", is_incomplete_purchase(
        F.col("event_name"), F.col("transaction_id")))


def swap_inverted_dates(df: DataFrame, start: str = "start_date",
                        end: str = "end_date") -> DataFrame:
    """Exchange the two dates where the end lies before the start."""
    inverted = F.col(end) < F.col(start)
    return df.withColumns({
        start: F.when(inverted, F.col(end)).otherwise(F.col(start)),
        end: F.when(inverted, F.col(start)).otherwise(F.col(end))})


# --- the five files, and the log ------------------------------------------

class Cleaned(NamedTuple):
    """A cleaned file. ``seen`` has one row per key, those that will be dropped too, with the
    number of its copies and of their repairs; ``finish`` makes the cleaned rows of it."""
    file: str
    seen: DataFrame
    counts: Mapping[str, Column]
    finish: Callable[[DataFrame], DataFrame]

    def _counts(self) -> list[Column]:
        return [F.coalesce(self.counts.get(n, F.lit(None)), F.lit(0)).cast("bigint").alias(n) for n in LOG_COUNTS]

    @property
    def rows(self) -> DataFrame:
        return self.finish(self.seen)

    @property
    def log(self) -> DataFrame:
        """The counts by a pass of their own."""
        counted = [n for n in LOG_COUNTS if n in self.counts]
        return (self.seen.agg(*[self.counts[n].alias(n) for n in counted])
                .select(F.lit(self.file).alias("file"), *[
                    (F.coalesce(n, F.lit(0)) if n in counted else F.lit(0)).cast("bigint").alias(n) for n in LOG_COUNTS]))

    def observed(self) -> tuple[DataFrame, Observation]:
        """The cleaned rows, and the counts, which the first job on these rows fills in.

        They are taken behind the last shuffle of the rows, where a row is seen once, so what a
        lost executor makes Spark compute again is not counted twice.
        """
        watch = Observation()
        return self.finish(self.seen.observe(watch, *[c.alias(n) for n, c in self.counts.items()])), watch


def cleaning_log(*results: Cleaned) -> DataFrame:
    """One row per file: rows in and out, duplicates, filled NULLs, repaired values."""
    return reduce(DataFrame.unionByName, [r.log for r in results])


def observed_log(spark: SparkSession, watched: Mapping[str, Observation]) -> DataFrame:
    """The same from the observations of rows that were written."""
    rows = [F.struct(F.lit(file).alias("file"), *[F.lit(int(found.get(n) or 0)).cast("bigint").alias(n) for n in LOG_COUNTS])
            for file, found in ((f, w.get) for f, w in watched.items())]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _often(*conditions: Column) -> Column:
    """How many of the conditions a row meets."""
    return reduce(lambda a, b: a + b, [F.when(c, 1).otherwise(0) for c in conditions])


def clean_events(raw: DataFrame, order_by: Sequence[str],
                 file: str = "ga4_events.csv") -> Cleaned:
    """Parse, de-duplicate, drop rows without user or name, fill, repair, flag."""
    keep = F.col("user_pseudo_id").isNotNull() & F.col("event_name").isNotNull()

    def finish(unique: DataFrame) -> DataFrame:
        return flag_incomplete_purchase(fill_unknown(unique.where(keep).select(*raw.columns), EVENT_FILL)).withColumns({
            "event_date": parse_date(F.col("event_date")),
            "event_datetime": micros_to_ts(F.col("event_timestamp")),
            "items_value": negative_to_null(F.col("items_value"))})

    return Cleaned(file, first_counted(raw, EVENT_KEY, order_by), {
        "rows_in": F.sum(COPIES), "rows_out": F.count_if(keep), "duplicates_removed": F.sum(F.col(COPIES) - 1),
        "nulls_fixed": F.sum(F.when(keep, _often(*[F.col(c).isNull() for c in EVENT_FILL]))),
        "invalid_values_fixed": F.count_if(keep & (F.col("items_value") < 0))}, finish)


def clean_items(raw: DataFrame, order_by: Sequence[str],
                file: str = "ga4_items.csv") -> Cleaned:
    """Drop rows without item, fill, repair price and quantity, then de-duplicate."""
    has_item = F.col("item_id").isNotNull()
    invalid = [F.col(c).isNull() | (F.col(c) < 0) for c in ("price", "quantity")]
    repaired = fill_unknown(
        raw.withColumns({"_filled": F.when(has_item, _often(*[F.col(c).isNull() for c in ITEM_FILL])),
                         "_repaired": F.when(has_item, _often(*invalid))}), ITEM_FILL).withColumns({
        "price": invalid_to_default(F.col("price"), 0).cast(raw.schema["price"].dataType),
        "quantity": invalid_to_default(F.col("quantity"), 1)})

    def finish(unique: DataFrame) -> DataFrame:
        return unique.where(has_item).select(*raw.columns).withColumns({
            "event_date": parse_date(F.col("event_date")),
            "event_datetime": micros_to_ts(F.col("event_timestamp"))})

    return Cleaned(file, first_counted(repaired, ITEM_KEY, order_by, ["_filled", "_repaired"]), {
        "rows_in": F.sum(COPIES), "rows_out": F.count_if(has_item),
        "duplicates_removed": F.sum(F.when(has_item, F.col(COPIES) - 1)),
        "nulls_fixed": F.sum("_filled"), "invalid_values_fixed": F.sum("_repaired")}, finish)


def clean_channels(raw: DataFrame, order_by: Sequence[str],
                   file: str = "marketing_channels.csv") -> Cleaned:
    return Cleaned(file, first_counted(raw, CHANNEL_KEY, order_by), {
        "rows_in": F.sum(COPIES), "rows_out": F.count("*"), "duplicates_removed": F.sum(F.col(COPIES) - 1),
        "nulls_fixed": F.sum(_often(*[F.col(c).isNull() for c in CHANNEL_FILL]))},
        lambda unique: fill_unknown(unique.select(*raw.columns), CHANNEL_FILL))


def clean_campaigns(raw: DataFrame, file: str = "campaigns.csv") -> Cleaned:
    """Parse dates, swap inverted ranges, drop rows without campaign or channel id."""
    parsed = raw.withColumns({c: parse_date(F.col(c), "yyyy-MM-dd")
                              for c in ("start_date", "end_date")})
    mapped = F.col("campaign_id").isNotNull() & F.col("channel_id").isNotNull()
    return Cleaned(file, parsed, {
        "rows_in": F.count("*"), "rows_out": F.count_if(mapped),
        "invalid_values_fixed": F.count_if(F.col("end_date") < F.col("start_date"))},
        lambda rows: drop_null_keys(swap_inverted_dates(rows), ["campaign_id", "channel_id"]))


def clean_ad_spend(raw: DataFrame, order_by: Sequence[str],
                   file: str = "ad_spend.csv") -> Cleaned:
    """Parse dates, zero invalid amounts, then one row per channel, campaign and day."""
    repaired = raw.withColumns({
        "_repaired": _often(F.col("amount").isNull() | (F.col("amount") < 0)),
        "spend_date": parse_date(F.col("spend_date"), "yyyy-MM-dd"),
        "amount": invalid_to_default(F.col("amount"), 0).cast(raw.schema["amount"].dataType)})
    return Cleaned(file, first_counted(repaired, SPEND_KEY, order_by, ["_repaired"]), {
        "rows_in": F.sum(COPIES), "rows_out": F.count("*"), "duplicates_removed": F.sum(F.col(COPIES) - 1),
        "invalid_values_fixed": F.sum("_repaired")}, lambda unique: unique.select(*raw.columns))
