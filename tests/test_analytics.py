from datetime import date
from decimal import Decimal as D

import pytest

from frames import got
from mercata.operators import analytics as a

SESSIONS = ("session_id STRING, customer_id STRING, session_date DATE, traffic_source STRING, "
            "traffic_medium STRING")
ORDERS = ("order_id STRING, customer_id STRING, session_id STRING, order_date DATE, "
          "order_total DECIMAL(18;2)")


def test_funnel(frame):
    sessions = frame(SESSIONS, [("1", "u", "2024-01-01", "g", "o"), ("2", "v", "2024-01-01", "g", "o"),
                                ("3", "w", "2024-01-01", "x", "y"), ("4", "z", "2024-01-01", "n", "n"),
                                ("5", "u", "2024-01-02", "g", "o")])
    events = frame("session_id STRING, event_name STRING", [
        ("1", "view_item"), ("1", "view_item"), ("5", "view_item"), ("1", "purchase"),
        ("2", "purchase"), ("3", "page_view"), (None, "view_item"), ("9", "view_item")])
    out = a.funnel_conversion(events, sessions)
    # More buyers than viewers is over 100; a channel of page views only has no rates;
    # a session without events does not appear.
    assert got(out) == [
        ("g", "o", 1, 0, 0, 2, D("0.00"), None, None, D("200.00")),
        ("x", "y", 0, 0, 0, 0, None, None, None, None)]


def test_cac_and_roas(frame):
    channels = frame("channel_id INT, channel_name STRING, channel_type STRING", [
        (1, "G / CPC", "paid"), (2, "bing / cpc", "paid"), (3, "g / organic", "organic"),
        (4, "m / cpc", "paid")])
    spend = frame("channel_id INT, amount DECIMAL(18;2)", [(1, 10), (1, 5), (3, 4), (4, 3)])
    sessions = frame(SESSIONS, [
        ("s1", "u", "2024-01-01", "g", "cpc"), ("s2", "u", "2024-01-02", "g", "organic"),
        ("s3", "v", "2024-01-01", "g", "cpc"), ("s4", "v", "2024-01-01", "bing", "cpc"),
        ("s5", "w", "2024-01-01", "G", "Organic")])
    orders = frame(ORDERS, [("o1", "u", "s2", "2024-01-02", 30), ("o2", "v", "s4", "2024-01-01", 8),
                            ("o3", "v", "s3", "2024-01-01", 7)])
    out = a.channel_cac_roas(channels, spend, orders, sessions)
    assert got(out, "channel_id", "total_spend", "total_orders", "total_revenue",
               "new_paying_customers", "cac", "roas") == [
        (1, D("15.00"), 1, D("7.00"), 2, D("7.50"), D("0.47")),
        (2, D("0.00"), 1, D("8.00"), 0, None, None),   # paid, no spend
        (3, D("4.00"), 1, D("30.00"), 0, None, None),  # spend on a channel that is not paid
        (4, D("3.00"), 0, D("0.00"), 0, None, None)]   # no new payers


def test_first_session_breaks_ties_by_id(frame):
    out = a.first_session(frame(SESSIONS, [("b", "u", "2024-01-01", "x", "x"),
                                           ("a", "u", "2024-01-01", "y", "y"),
                                           ("0", "u", None, "z", "z")]))
    assert got(out, "customer_id", "session_id") == [("u", "a")]


def test_cohorts_across_a_year_end(frame):
    out = a.cohort_retention(frame(ORDERS, [
        ("1", "u", "", "2023-12-31", 1), ("2", "u", "", "2024-01-01", 1),
        ("3", "u", "", "2024-01-09", 1), ("4", "v", "", "2023-12-01", 1),
        ("5", "w", "", "2024-01-02", 1), ("6", "v", "", "2024-12-01", 1)]))
    assert got(out) == [(date(2023, 12, 1), 0, 2), (date(2023, 12, 1), 1, 1),
                        (date(2023, 12, 1), 12, 1), (date(2024, 1, 1), 0, 1)]


def test_ltv_keeps_visitors(frame):
    sessions = frame(SESSIONS, [("1", "u", "2024-01-01", "g", "o"), ("2", "v", "2024-01-01", "g", "o")])
    orders = frame(ORDERS, [("o", "u", "1", "2024-01-01", "10.01"), ("p", "u", "1", "2024-01-03", "0")])
    out = a.customer_ltv(sessions, orders)
    assert got(out, "customer_id", "total_orders", "historical_ltv", "first_order_date",
               "average_order_value") == [
        ("u", 2, D("10.01"), date(2024, 1, 1), D("5.01")), ("v", 0, D("0.00"), None, None)]


@pytest.mark.parametrize("orders, ltv, segment", [
    (2, 500, "VIP"), (4, 1, "VIP"), (0, 0, "No Purchase"), (None, 0, "No Purchase"),
    (1, 499, "One-Time Buyer"), (2, 10, "Repeat Customer"), (3, 10, "Repeat Customer"),
    (-1, 0, "Unknown"), (0, 500, "VIP")])
def test_segments(frame, orders, ltv, segment):
    df = frame("customer_id STRING, acquisition_source STRING, acquisition_medium STRING, "
               "total_orders BIGINT, historical_ltv DECIMAL(18;2)", [("u", "s", "m", orders, ltv)])
    assert a.customer_segments(df).first().segment == segment


def test_pricing(frame):
    products = frame("product_id STRING, product_name STRING, category STRING, "
                     "base_price DECIMAL(18;2)", [("a", "A", "c", 10), ("b", "B", "c", 10),
                                                  ("z", "Z", "c", 0), ("unsold", "U", "c", 1)])
    items = frame("order_id STRING, product_id STRING, quantity INT, unit_price DECIMAL(18;2)", [
        ("1", "a", 10, 8), ("1", "a", 1, 9), ("2", "a", 1, 7), ("1", "b", 1, 12), ("1", "z", 1, 5),
        ("1", "gone", 1, 1)])
    assert got(a.pricing_analytics(items, products), "product_id", "avg_selling_price",
               "discount_pct", "times_purchased", "product_revenue") == [
        ("a", D("8.00"), D("20.00"), 2, D("96.00")), ("b", D("12.00"), D("0.00"), 1, D("12.00")),
        ("z", D("5.00"), D("0.00"), 1, D("5.00"))]


def test_rankings(frame):
    funnel = frame("traffic_source STRING, traffic_medium STRING, view_item_customers INT, "
                   "overall_conversion_rate_pct DECIMAL(10;2)", [
                       ("a", "x", 1, None), ("b", "x", 5, 2), ("c", "x", 5, 9)])
    assert [r.channel_name for r in a.top_channels_by_views(funnel, 2).collect()] == ["b / x", "c / x"]
    assert [r.channel_name for r in a.top_conversion(funnel).collect()] == ["c / x", "b / x", "a / x"]
