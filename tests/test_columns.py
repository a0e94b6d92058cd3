from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from frames import got
from mercata import schemas
from mercata.functions import columns as c
from mercata.sources import readers


def nested(spark, rows):
    return spark.createDataFrame(rows, schemas.NESTED_EVENT)


def event(params=(), items=(), name="purchase", user="u1", txn="T1"):
    return ("20240105", 1_704_412_800_000_000, name, user,
            [(k, (s, i)) for k, s, i in params], ("google", "cpc", "sale"), ("mobile",),
            ("Canada",), (txn,), [("i", "n", "c", p, q) for p, q in items])


def test_event_param_missing_key_is_null(spark):
    df = nested(spark, [event([("ga_session_id", None, 7), ("page_location", "http://x", None)]),
                        event([("other", "x", None)]), event()])
    ids = [r[0] for r in df.select(c.event_param(F.col("event_params"), "ga_session_id")).collect()]
    pages = [r[0] for r in df.select(c.event_param(F.col("event_params"), "page_location",
                                                   "string_value")).collect()]
    assert ids == [7, None, None] and pages == ["http://x", None, None]


@pytest.mark.parametrize("items, want", [
    ([], None), ([(None, 2)], None), ([(D("1.50"), 2), (None, 3), (D("2.00"), 1)], D("5.00")),
    ([(D("1.50"), None)], None)])
def test_items_value(spark, items, want):
    assert nested(spark, [event(items=items)]).select(
        c.items_value(F.col("items"))).first()[0] == want


def test_explode_drops_events_without_items(spark):
    df = readers.explode_items(nested(spark, [event([("ga_session_id", None, 7)],
                                                    [(D("1"), 1), (D("2"), 2)]), event()]))
    assert got(df, "session_id", "price", "quantity") == [("u1_7", D("1.00"), 1),
                                                          ("u1_7", D("2.00"), 2)]


def test_flatten(spark):
    row = readers.flatten_events(nested(spark, [event([("ga_session_id", None, 7)])])).first()
    assert (row.traffic_source, row.campaign_name, row.device_category, row.country,
            row.transaction_id, row.items_value, row.session_id) == \
        ("google", "sale", "mobile", "Canada", "T1", None, "u1_7")


def test_session_key_without_id_or_user(frame):
    df = frame("u STRING, g BIGINT", [("a", 1), ("a", None), (None, 1)])
    assert [r[0] for r in df.select(c.session_key(F.col("u"), F.col("g"))).collect()] == \
        ["a_1", "a_<NA>", None]


def test_dates_and_times_that_do_not_parse(spark, frame):
    df = frame("d STRING, m STRING", [("20240105", "1704412800000001"), ("2024-13-99", "x"),
                                      (None, None)])
    out = df.select(c.parse_date(F.col("d")), c.micros_to_ts(F.col("m"))).collect()
    assert [tuple(r) for r in out] == [
        (date(2024, 1, 5), datetime(2024, 1, 5, 0, 0, 0, 1)), (None, None), (None, None)]


def test_time_does_not_depend_on_session_zone(spark, frame):
    df = frame("m BIGINT", [(1704412800000000,)])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ts = df.select(c.micros_to_ts(F.col("m")).alias("t"))
        assert ts.first()[0] == datetime(2024, 1, 5)
        assert ts.select(c.ts_to_micros(F.col("t"))).first()[0] == 1704412800000000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_repairs_keep_zero(frame):
    df = frame("x INT", [(0,), (-1,), (None,), (5,)])
    assert [r[0] for r in df.select(c.invalid_to_default(F.col("x"), 1)).collect()] == [0, 1, 1, 5]
    assert [r[0] for r in df.select(c.negative_to_null(F.col("x"))).collect()] == [0, None, None, 5]


@pytest.mark.parametrize("medium, kind", [
    ("CPC", "paid"), ("paid email", "paid"), ("Email", "email"), ("organic", "organic"),
    ("(none)", "direct"), ("direct", "direct"), ("referral", "referral"), ("<Other>", "other")])
def test_channel_type(spark, medium, kind):
    assert spark.range(1).select(c.channel_type(F.lit(medium))).first()[0] == kind


def test_rounding_is_half_up_on_exact_values(frame):
    df = frame("a BIGINT, b BIGINT", [(1, 8), (1, 3), (201, 20000), (1, 0)])
    assert [r[0] for r in df.select(c.percent(F.col("a"), F.col("b"))).collect()] == \
        [D("12.50"), D("33.33"), D("1.01"), None]
    m = frame("a DECIMAL(18;2), b BIGINT", [("10.01", 2), ("0.05", 2), ("1", 0)])
    assert [r[0] for r in m.select(c.safe_ratio(F.col("a"), F.col("b"))).collect()] == \
        [D("5.01"), D("0.03"), None]


def test_plain_number(frame):
    df = frame("a DECIMAL(18;2)", [("38.50",), ("100.00",), ("1656.42",), ("12345678901.10",)])
    assert [r[0] for r in df.select(c.plain_number(F.col("a"))).collect()] == \
        ["38.5", "100.0", "1656.42", "12345678901.1"]
