from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from frames import got
from mercata.operators import channels as ch
from mercata.operators.keys import first_seen_ids
from mercata.session import scratch_folder


def events(frame, rows):
    return frame("user_pseudo_id STRING, traffic_source STRING, traffic_medium STRING, "
                 "event_name STRING, line_no INT", [(*r, i) for i, r in enumerate(rows)])


def test_spellings_are_one_channel(frame):
    out = ch.channel_dimension(events(frame, [
        ("u", "<Other>", "referral", "x"), ("u", "<other>", "Referral", "x"),
        ("u", None, "cpc", "x"), ("u", "google", None, "x")]), ["line_no"])
    assert got(out, "channel_name", "channel_type") == [
        ("<other> / referral", "referral"), ("google / unknown", "other"),
        ("unknown / cpc", "paid")]
    assert sorted(r.channel_id for r in out.collect()) == [1, 2, 3]


def test_channels_are_numbered_as_they_first_appear(frame):
    rows = [("u", "b", "x", "e"), ("u", "a", "x", "e"), ("u", "B", "X", "e"), ("u", None, None, "e"), ("u", "a", "y", "e")]
    for parts in (1, 5):
        out = ch.channel_dimension(events(frame, rows).repartition(parts), ["line_no"])
        assert got(out, "channel_id", "channel_name") == [(1, "b / x"), (2, "a / x"), (3, "unknown / unknown"), (4, "a / y")]
    assert got(ch.channel_dimension(events(frame, []), ["line_no"])) == []


def test_first_seen_ids_do_not_depend_on_partitions(spark):
    df = spark.range(60000).select(F.concat(F.lit("k"), F.xxhash64(F.col("id") % 20000).cast("string")).alias("name"), "id")
    out = []
    for parts in (3, 7):
        ids = first_seen_ids(df.repartition(parts), "name", ["id"], "n", scratch_folder(spark, "ids")).orderBy("n").collect()
        out.append([(r["name"], r["n"]) for r in ids])
    want = [r["name"] for r in df.where("id < 20000").orderBy("id").collect()]
    assert out[0] == out[1] == [(name, i + 1) for i, name in enumerate(want)]


def test_calibrated_spend(frame):
    ev = events(frame, [("u", "google", "cpc", "purchase"), ("u", "google", "cpc", "purchase"),
                        ("v", "Google", "cpc", "purchase"), ("w", "bing", "cpc", "view_item"),
                        ("u", "GOOGLE", "cpc", "purchase"), ("x", "google", "organic", "purchase")])
    dim = ch.channel_dimension(ev, ["line_no"])
    paying = ch.payers_by_channel(ev)  # u bought under two spellings of one channel
    out = ch.calibrated_spend(dim, paying, "20.50").join(dim, "channel_id")
    assert got(out, "channel_name", "total_spend") == [("bing / cpc", D("0.00")),
                                                       ("google / cpc", D("41.00"))]


def test_allocation_scales_to_the_total(frame):
    df = frame("g STRING, w DOUBLE, t DOUBLE", [("a", 1, 100), ("a", 3, 100), ("b", 2, 7), ("c", 0, 5)])
    assert got(ch.allocate(df, "w", "t", "g"), "g", "share", "amount") == [
        ("a", 0.25, D("25.00")), ("a", 0.75, D("75.00")), ("b", 1.0, D("7.00")), ("c", None, None)]


def test_hot_group_is_split_without_changing_the_shares(spark):
    df = spark.range(0, 500, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"),
        (F.col("id") + 1.0).alias("w"), F.lit(100.0).alias("t"))
    assert got(ch.allocate(df, "w", "t", "g", rows_per_salt=20)) == got(ch.allocate(df, "w", "t", "g"))


def test_spend_curve(spark):
    out = ch.daily_spend_curve(spark, "2024-01-01", "2024-01-07", spikes={"2024-01-03": 2.0})
    assert [w for _, w in got(out)] == pytest.approx([1.2, 1.2, 2.2, 1.1, 1.0, 0.7, 0.7])
    floor = ch.daily_spend_curve(spark, "2024-01-01", "2024-01-01", multipliers=[-1.0] * 7)
    assert got(floor) == [(date(2024, 1, 1), 0.0)]


def test_campaign_of_each_day(frame):
    daily = frame("channel_id INT, spend_date DATE, amount DECIMAL(18;2)", [
        (1, "2024-01-01", 1), (1, "2024-01-05", 2), (1, "2024-01-09", 3), (2, "2024-01-05", 4)])
    camps = frame("campaign_id INT, channel_id INT, start_date DATE, end_date DATE", [
        (7, 1, "2024-01-04", "2024-01-06"), (8, 1, "2024-01-05", "2024-01-09"),
        (9, 1, "1900-01-01", "1900-01-02"), (5, 3, "2024-01-01", "9999-12-31")])
    assert got(ch.assign_campaign(daily, camps), "channel_id", "campaign_id", "amount") == [
        (1, 7, D("1.00")), (1, 7, D("2.00")), (1, 8, D("3.00"))]


def test_channel_without_campaign_has_no_row(frame):
    daily = frame("channel_id INT, spend_date DATE, amount DECIMAL(18;2)", [(2, "2024-01-05", 4)])
    camps = frame("campaign_id INT, channel_id INT, start_date DATE, end_date DATE",
                  [(7, 1, "2024-01-04", "2024-01-06")])
    assert got(ch.assign_campaign(daily, camps)) == []
