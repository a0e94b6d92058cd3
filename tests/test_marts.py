from datetime import date
from decimal import Decimal as D

import pytest

from frames import got
from mercata.operators import marts, quality
from mercata.plans import gate, views
from mercata.session import scratch_folder
from mercata.sources import writers

EVENTS = ("event_id INT, event_date DATE, event_datetime TIMESTAMP_NTZ, event_name STRING, "
          "user_pseudo_id STRING, session_id STRING, traffic_source STRING, traffic_medium STRING, "
          "campaign_name STRING, device_category STRING, country STRING, transaction_id STRING, "
          "items_value DECIMAL(18;2)")


def ev(i, ts, name="view_item", user="u", sess="u_1", source="s", txn=None, value=None, country="A"):
    day = ts[:10] if ts else "2024-01-09"
    return (i, day, ts, name, user, sess, source, "m", "c", "d", country, txn, value)


def test_first_event_sets_the_session(frame):
    out = marts.mart_sessions(frame(EVENTS, [
        ev(3, "2024-01-01 10:00:00", source="later id"), ev(2, "2024-01-01 10:00:00", source="first"),
        ev(1, None, source="no time"), ev(4, "2024-01-02 10:00:00", sess=None),
        ev(5, None, sess="only", source="undated")]), ["event_id"])
    assert got(out, "session_id", "traffic_source") == [("only", "undated"), ("u_1", "first")]


def test_equal_times_are_settled_without_tiebreak_columns(frame):
    rows = [ev(1, "2024-01-01 10:00:00", source="b"), ev(2, "2024-01-01 10:00:00", source="a")]
    assert got(marts.mart_sessions(frame(EVENTS, rows)), "traffic_source") == [("a",)]
    assert got(marts.mart_sessions(frame(EVENTS, rows[::-1])), "traffic_source") == [("a",)]


def test_latest_price(frame):
    out = marts.mart_products(frame(
        "item_id STRING, item_name STRING, item_category STRING, price DECIMAL(18;2), "
        "event_datetime TIMESTAMP_NTZ", [
            ("a", "old", "c", 9, "2024-01-01 00:00:00"), ("a", "new", "c", 5, "2024-01-02 00:00:00"),
            ("a", "untimed", "c", 99, None), ("a", "new cheap", "c", 4, "2024-01-02 00:00:00")]))
    assert got(out) == [("a", "new", "c", D("5.00"))]


def test_customers_take_the_last_country_by_name(frame):
    out = marts.mart_customers(frame(EVENTS, [ev(1, "2024-01-02 00:00:00", country="Zambia"),
                                              ev(2, "2024-01-05 00:00:00", country="Austria")]))
    assert got(out) == [("u", date(2024, 1, 2), "Zambia")]


def test_orders_and_quarantine(frame, spark):
    events = frame(EVENTS, [
        ev(1, "2024-01-02 00:00:00", "purchase", txn="T1", value=5),
        ev(2, "2024-01-01 00:00:00", "purchase", txn="T1", value=4),
        ev(3, "2024-01-01 00:00:00", "purchase", txn="T2"),
        ev(4, "2024-01-01 00:00:00", "purchase"), ev(5, "2024-01-01 00:00:00", txn="T3", value=1)])
    items = frame("event_name STRING, transaction_id STRING, item_id STRING, item_name STRING, "
                  "item_category STRING, event_datetime TIMESTAMP_NTZ, quantity INT, "
                  "price DECIMAL(18;2)", [
                      ("purchase", "T1", "a", "n", "c", None, 1, 1),
                      ("purchase", "T2", "a", "n", "c", None, 1, 1),
                      ("purchase", None, "a", "n", "c", None, 1, 1),
                      ("view_item", "T1", "a", "n", "c", None, 1, 1)])
    channels = frame("channel_id INT, channel_name STRING, channel_type STRING",
                     [(1, "s / m", "paid"), (1, "s / m", "paid")])
    camps = frame("campaign_id INT, channel_id INT, campaign_name STRING, start_date DATE, "
                  "end_date DATE, budget DECIMAL(18;2)", [(1, 1, "x", "2024-01-01", "2024-01-31", None)])
    spend = frame("spend_id INT, channel_id INT, campaign_id INT, spend_date DATE, "
                  "amount DECIMAL(18;2)", [(1, 1, 1, "2024-01-01", 2)])
    folder = scratch_folder(spark, "gate")
    gated = gate.gate(views.build_marts(events, items, channels, camps, spend, ["event_id"]),
                      lambda name, df: writers.stored(df, f"{folder}/{name}"))
    m = gated.loaded
    assert got(m["orders"], "order_id", "order_total", "order_status") == [
        ("T1", D("4.00"), "completed")]
    assert got(gated.refused["orders"], "order_id", "reason") == [("T2", "null order_total")]
    assert got(m["order_items"], "order_id") == [("T1",)]
    assert got(gated.refused["order_items"], "order_id", "reason") == [("T2", "orphan order_id")]
    assert m["marketing_channels"].count() == 1 and m["events"].count() == 5
    v = views.build_views(m)
    assert got(v["vw_channel_cac_roas"], "total_spend", "total_orders", "cac", "roas") == [
        (D("2.00"), 1, D("2.00"), D("2.00"))]
    views.register_views(v)
    assert views.quality_checks(m, "2024-01-01", "2024-01-31").summary.first().total == 23


def test_gate_fails_or_splits(frame):
    parents = frame("id STRING", [("p",), ("p",)])
    df = frame("k STRING, fk STRING, v INT", [
        ("a", "p", 1), ("b", "p", None), ("c", "p", 1), ("c", None, 2), ("d", "lost", 1),
        ("e", None, 1)])
    rules = dict(not_null=["v"], pk="k", fks=[("fk", parents, "id")])
    with pytest.raises(quality.ConstraintViolation, match="duplicate k: 2 rows; null v: 1 rows"):
        quality.enforce(df, **rules)
    valid, refused = quality.enforce(df, **rules, on_violation="quarantine")
    assert got(valid) == [("a", "p", 1), ("e", None, 1)]
    assert got(refused, "k", "reason") == [("b", "null v"), ("c", "duplicate k"),
                                           ("c", "duplicate k"), ("d", "orphan fk")]
    assert quality.enforce(valid, **rules) is valid


def test_hot_keys_are_split_without_changing_the_result(frame, spark):
    rows = [("hot" if i % 3 else f"k{i}", "far" if i % 2 else None, i) for i in range(300)]
    df = frame("k STRING, fk STRING, v INT", rows).repartition(7)
    parents = frame("id STRING", [("near",)])
    reasons = [got(quality.mark_violations(df, not_null=["v"], pk="k", fks=[("fk", parents, "id")],
                                           rows_per_salt=n)) for n in (5, 1000)]
    assert reasons[0] == reasons[1] and len(reasons[0]) == 300
    assert {r[3] for r in reasons[0]} == {"duplicate k", "orphan fk", None}
