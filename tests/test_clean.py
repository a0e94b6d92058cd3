from decimal import Decimal as D

from frames import got
from mercata.operators import clean


def raw_events(frame, rows):
    return frame("line_no INT, event_date STRING, event_timestamp BIGINT, event_name STRING, "
                 "user_pseudo_id STRING, traffic_source STRING, traffic_medium STRING, "
                 "campaign_name STRING, device_category STRING, country STRING, "
                 "transaction_id STRING, items_value DOUBLE, session_id STRING", rows)


def test_events_are_cleaned_in_the_stated_order(frame):
    raw = raw_events(frame, [
        (1, "20240105", 10, "purchase", "u", None, "cpc", "c", "d", "x", None, -5, "u_1"),
        (2, "20240105", 10, "purchase", "u", "late", "cpc", "c", "d", "x", "T", 5, "u_1"),
        (3, "bad", 11, "view_item", None, "s", "m", "c", "d", "x", None, None, None),
        (4, "bad", 11, "view_item", None, "s", "m", "c", "d", "x", None, None, None),
        (5, "20240106", 12, "purchase", "v", "s", None, "c", "d", None, "T2", 0, "v_1")])
    out = clean.clean_events(raw, ["line_no"])
    assert got(out.rows, "line_no", "traffic_source", "traffic_medium", "country", "items_value",
               "is_flagged_incomplete_purchase") == [
        (1, "unknown", "cpc", "x", None, True), (5, "s", "unknown", "unknown", 0.0, False)]
    # Equal NULL keys are duplicates; they are removed before rows without user are.
    assert got(out.log) == [("ga4_events.csv", 5, 2, 2, 3, 1)]


def test_items_are_repaired_before_duplicates_go(frame):
    raw = frame("line_no INT, event_date STRING, event_timestamp BIGINT, user_pseudo_id STRING, "
                "event_name STRING, item_id STRING, item_name STRING, item_category STRING, "
                "price DECIMAL(18;2), quantity INT", [
                    (1, "20240105", 1, "u", "view_item", "a", None, "c", -1, 0),
                    (2, "20240105", 1, "u", "view_item", "a", "n", "c", None, None),
                    (3, "20240105", 1, "u", "view_item", None, None, None, None, None)])
    out = clean.clean_items(raw, ["line_no"])
    assert got(out.rows, "line_no", "item_name", "price", "quantity") == [
        (1, "unknown", D("0.00"), 0)]
    assert got(out.log) == [("ga4_items.csv", 3, 1, 1, 1, 3)]


def test_dedup_keeps_first_and_null_keys_match(frame):
    df = frame("n INT, k STRING, p STRING", [(2, "a", "late"), (1, "a", "early"), (4, None, "y"),
                                             (3, None, "x")])
    assert got(clean.dedup_first(df, ["k"], ["n"])) == [(1, "a", "early"), (3, None, "x")]


def test_swap_leaves_null_dates(frame):
    df = frame("start_date DATE, end_date DATE", [
        ("2024-01-05", "2024-01-01"), (None, "2024-01-01"), ("2024-01-05", None),
        ("2024-01-01", "2024-01-05")])
    out = [tuple(str(v) for v in r) for r in clean.swap_inverted_dates(df).collect()]
    assert out == [("2024-01-01", "2024-01-05"), ("None", "2024-01-01"), ("2024-01-05", "None"),
                   ("2024-01-01", "2024-01-05")]


def test_channels_campaigns_and_spend(frame):
    ch = clean.clean_channels(frame("channel_id INT, channel_name STRING, channel_type STRING, n INT",
                                    [(1, "a", None, 1), (1, "a", "paid", 2), (2, "b", "x", 3)]), ["n"])
    assert got(ch.rows, "channel_id", "channel_type") == [(1, "unknown"), (2, "x")]
    ca = clean.clean_campaigns(frame(
        "campaign_id INT, channel_id INT, start_date STRING, end_date STRING",
        [(1, 1, "2024-01-05", "2024-01-01"), (2, None, "2024-01-05", "2024-01-01"),
         (3, 1, "oops", "2024-01-01")]))
    assert ca.rows.count() == 2
    sp = clean.clean_ad_spend(frame(
        "n INT, channel_id INT, campaign_id INT, spend_date STRING, amount DECIMAL(18;2)",
        [(1, 1, 1, "2024-01-01", -3), (2, 1, 1, "2024-01-01", 9), (3, 1, 1, "2024-01-02", None)]),
        ["n"])
    assert got(sp.rows, "n", "amount") == [(1, D("0.00")), (3, D("0.00"))]
    assert got(clean.cleaning_log(ch, ca, sp)) == [
        ("ad_spend.csv", 3, 2, 1, 0, 2), ("campaigns.csv", 3, 2, 0, 0, 2),
        ("marketing_channels.csv", 3, 2, 1, 1, 0)]
