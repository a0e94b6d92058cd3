"""Journeys and attribution against the direct form on random data."""

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from frames import got
from mercata.operators import attribution as at
from mercata.operators import touchpoints as tp

SESSIONS = ("session_id STRING, customer_id STRING, session_date DATE, traffic_source STRING, "
            "traffic_medium STRING")
ORDERS = ("order_id STRING, customer_id STRING, session_id STRING, order_date DATE, "
          "order_total DECIMAL(18;2)")
CHANNELS = [(1, "G / Organic", "organic"), (2, "g / cpc", "paid"), (3, "d / (none)", "direct")]
PAIRS = [("g", "organic"), ("g", "cpc"), ("d", "(none)"), ("odd", "odd"), (None, "x")]
START = date(2024, 1, 1)


def random_data(seed, hot=False):
    r = random.Random(seed)
    people = ["u", "v", "w", "x"]

    def person():
        return "u" if hot and r.random() < 0.6 else r.choice(people)

    days = 6 if hot else 40
    sessions = [(f"s{i:03}", person(), str(START + timedelta(r.randrange(days))), *r.choice(PAIRS))
                for i in range(120)]
    orders = [(f"o{i:03}", person(), r.choice(sessions)[0], str(START + timedelta(r.randrange(days))),
               f"{r.randrange(1, 9999) / 100:.2f}") for i in range(60)]
    return sessions, orders


def naive(sessions, orders, k=10):
    """(order_id, session_id, position), every session of every order looked at."""
    out = []
    for o in orders:
        mine = sorted((s[2], s[0]) for s in sessions if s[1] == o[1] and s[2] <= o[3])[-k:]
        out += [(o[0], sid, i) for i, (_, sid) in enumerate(mine, 1)]
    return sorted(out)


@pytest.fixture(scope="module", params=[(1, False), (2, True)])
def data(request, frame):
    sessions, orders = random_data(*request.param)
    return sessions, orders, frame(SESSIONS, sessions), frame(ORDERS, orders), \
        frame("channel_id INT, channel_name STRING, channel_type STRING", CHANNELS)


@pytest.mark.parametrize("k", [1, 3, 10])
def test_last_k_equals_the_direct_join(data, k):
    sessions, orders, s, o, _ = data
    out = tp.last_k_sessions(o, s.select("customer_id", "session_date", "session_id"), k)
    assert got(out, "order_id", "session_id", "touchpoint_order") == naive(sessions, orders, k)


def test_salted_join_gives_the_same_rows(data):
    sessions, orders, s, o, _ = data
    walks = tp.order_journeys(o.select("order_id", "customer_id", "order_date"),
                              s.select("customer_id", "session_date", "session_id"),
                              rows_per_salt=2)
    flat = walks.select("order_id", F.posexplode("touches").alias("p", "t")) \
        .select("order_id", "t.session_id", (F.col("p") + 1).alias("p"))
    assert got(flat) == naive(sessions, orders)


def test_large_dimension_is_joined_by_key(data, spark):
    _, _, s, _, ch = data
    small = got(tp.match_channel(s, ch), "session_id", "channel_id")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        large = got(tp.match_channel(s, ch), "session_id", "channel_id")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert large == small and len(large) == 120


def test_candidate_counts(data):
    sessions, orders, s, o, _ = data
    want = {}
    for oid, person, _, day, _ in orders:
        n = sum(1 for x in sessions if x[1] == person and x[2] <= day)
        if n:
            done, _ = want.get((person, day), (0, 0))
            want[person, day] = (done + 1, n)
    out = tp.candidate_counts(o, s).collect()
    assert {(r.customer_id, str(r.order_date)): (r.n_orders, r.candidates) for r in out} == want


def credits(data, weigh):
    sessions, orders, *_ = data
    where = {s[0]: s for s in sessions}
    ids = {("g", "organic"): 1, ("g", "cpc"): 2, ("d", "(none)"): 3}
    per_order = defaultdict(list)
    for oid, sid, _ in naive(sessions, orders):
        channel = ids.get((where[sid][3], where[sid][4]))
        if channel:
            per_order[oid].append((channel, date.fromisoformat(where[sid][2])))
    revenue, count = defaultdict(float), defaultdict(set)
    for oid, _, _, day, total in orders:
        touches = per_order[oid]
        weights = [weigh((date.fromisoformat(day) - d).days) for _, d in touches]
        for (channel, _), w in zip(touches, weights):
            revenue[channel] += float(total) * w / sum(weights)
            count[channel].add(oid)
    return {c: (pytest.approx(revenue[c], abs=0.0051), len(count[c])) for c in revenue}


@pytest.mark.parametrize("model, weigh", [("linear", lambda d: 1.0),
                                          ("time_decay", lambda d: 0.5 ** (d / 7))])
def test_models_from_journeys_and_from_the_table(data, model, weigh):
    _, _, s, o, ch = data
    fused = at.attribute_journeys(o, s, ch).where(F.col("attribution_model") == model)
    table = getattr(at, model)(tp.build_touchpoints(o, s, ch), o)
    want = credits(data, weigh)
    for out in (fused, table):
        assert {r.channel_id: (float(r.attributed_revenue), r.attributed_orders)
                for r in out.collect()} == want


def test_order_totals_are_conserved(data):
    _, _, s, o, ch = data
    touches = tp.build_touchpoints(o, s, ch)
    reached = touches.where("channel_id IS NOT NULL").select("order_id").distinct()
    total = o.join(reached, "order_id").agg(F.sum("order_total")).first()[0]
    for model in (at.linear(touches, o), at.time_decay(touches, o)):
        given = model.agg(F.sum("attributed_revenue")).first()[0]
        assert abs(given - total) <= D("0.02")


def small(frame, sessions, orders):
    ch = frame("channel_id INT, channel_name STRING, channel_type STRING", CHANNELS)
    s, o = frame(SESSIONS, sessions), frame(ORDERS, orders)
    return {(r.attribution_model, r.channel_id): (r.attributed_revenue, r.attributed_orders)
            for r in at.attribute_journeys(o, s, ch).collect()}


def test_unknown_touch_gives_its_share_to_the_others(frame):
    out = small(frame, [("1", "u", "2024-01-01", "odd", "odd"), ("2", "u", "2024-01-02", "g", "cpc")],
                [("o", "u", "2", "2024-01-02", "9.99")])
    assert out == {("linear", 2): (D("9.99"), 1), ("time_decay", 2): (D("9.99"), 1)}


def test_only_unknown_touches_or_none_give_nothing(frame):
    assert small(frame, [("1", "u", "2024-01-01", "odd", "odd"), ("2", "v", "2024-01-05", "g", "cpc")],
                 [("o", "u", "1", "2024-01-01", 5), ("p", "v", "2", "2024-01-04", 5)]) == {}


def test_half_cents_round_up_and_half_life_is_seven_days(frame):
    out = small(frame, [("1", "u", "2024-01-01", "g", "cpc"), ("2", "u", "2024-01-08", "d", "(none)")],
                [("o", "u", "2", "2024-01-08", "0.15")])
    assert out == {("linear", 2): (D("0.08"), 1), ("linear", 3): (D("0.08"), 1),
                   ("time_decay", 2): (D("0.05"), 1), ("time_decay", 3): (D("0.10"), 1)}


def test_summary_comparison_and_pivot(frame):
    ch = frame("channel_id INT, channel_name STRING, channel_type STRING", CHANNELS)
    s = frame(SESSIONS, [("1", "u", "2024-01-01", "g", "cpc"), ("2", "u", "2024-01-01", "G", "Organic"),
                         ("3", "u", "2024-01-01", "odd", "odd")])
    o = frame(ORDERS, [("o", "u", "1", "2024-01-01", 10), ("p", "u", "9", "2024-01-02", 6)])
    touches = tp.build_touchpoints(o, s, ch)
    assert got(tp.touchpoint_summary(touches)) == [(6, D("3.00"), 2)]
    assert got(tp.touchpoint_summary(touches.limit(0))) == [(0, D("0.00"), 0)]
    out = at.attribution_comparison(at.last_click(o, s, ch), at.attribute_journeys(o, s, ch), ch)
    assert [tuple(r) for r in out.collect()] == [
        ("G / Organic", "linear", D("8.00"), 2), ("G / Organic", "time_decay", D("8.00"), 2),
        ("g / cpc", "last_click", D("10.00"), 1), ("g / cpc", "linear", D("8.00"), 2),
        ("g / cpc", "time_decay", D("8.00"), 2)]
    assert got(at.attribution_pivot(out)) == [
        ("G / Organic", None, D("8.00"), D("8.00"), None, None),
        ("g / cpc", D("10.00"), D("8.00"), D("8.00"), D("-20.00"), D("-20.00"))]
