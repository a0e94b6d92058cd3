from collections import Counter

import pytest

from mercata.plans import gate
from mercata.session import scratch_folder

DAY, TIME = "2024-01-05", "2024-01-05 10:00:00"
GOOD = {
    "customers": [("c", DAY, None)],
    "products": [("p", "P", None, "1.00")],
    "marketing_channels": [(1, "g / cpc", "paid")],
    "sessions": [("s", "c", DAY, None, None, None, None)],
    "campaigns": [(1, 1, "x", DAY, DAY, None)],
    "orders": [("o", "c", "s", DAY, None, "5.00"), ("o2", "c", None, DAY, None, "0.00")],
    "events": [("s", "view_item", TIME, None), ("s", "purchase", TIME, "p")],
    "order_items": [("o", "p", 1, "5.00"), ("o", "p", 1, "5.00")],
    "ad_spend": [(1, 1, 1, DAY, "2.00")],
}
# One row (two for a repeated key) for each rule.
BAD = {
    "customers": [((None, DAY, None), "null customer_id"), (("n", None, None), "null first_seen_date"),
                  (("d", DAY, "A"), "duplicate customer_id"), (("d", DAY, "B"), "duplicate customer_id")],
    "products": [((None, "P", None, "1"), "null product_id"), (("n", None, None, "1"), "null product_name"),
                 (("m", "P", None, None), "null base_price"), (("d", "P", None, "1"), "duplicate product_id"),
                 (("d", "P", None, "1"), "duplicate product_id")],
    "marketing_channels": [((None, "a", "b"), "null channel_id"), ((2, None, "b"), "null channel_name"),
                           ((3, "a", None), "null channel_type"), ((4, "a", "b"), "duplicate channel_id"),
                           ((4, "a", "c"), "duplicate channel_id")],
    "sessions": [((None, "c", DAY, *[None] * 4), "null session_id"), (("t", None, DAY, *[None] * 4), "null customer_id"),
                 (("u", "c", None, *[None] * 4), "null session_date"), (("v", "n", DAY, *[None] * 4), "orphan customer_id"),
                 (("d", "c", DAY, *[None] * 4), "duplicate session_id"), (("d", "c", DAY, "x", *[None] * 3), "duplicate session_id")],
    "campaigns": [((None, 1, "x", DAY, DAY, None), "null campaign_id"), ((2, None, "x", DAY, DAY, None), "null channel_id"),
                  ((3, 1, None, DAY, DAY, None), "null campaign_name"), ((4, 1, "x", None, DAY, None), "null start_date"),
                  ((5, 1, "x", DAY, None, None), "null end_date"), ((6, 3, "x", DAY, DAY, None), "orphan channel_id"),
                  ((7, 1, "x", DAY, DAY, "1"), "duplicate campaign_id"), ((7, 1, "x", DAY, DAY, "2"), "duplicate campaign_id")],
    "orders": [((None, "c", "s", DAY, None, "5"), "null order_id"), (("a", None, "s", DAY, None, "5"), "null customer_id"),
               (("b", "c", "s", None, None, "5"), "null order_date"), (("e", "c", "s", DAY, None, None), "null order_total"),
               (("f", "d", "s", DAY, None, "5"), "orphan customer_id"), (("g", "c", "u", DAY, None, "5"), "orphan session_id"),
               (("d", "c", "s", DAY, None, "5"), "duplicate order_id"), (("d", "c", "s", DAY, None, "6"), "duplicate order_id")],
    "events": [((None, "x", TIME, None), "null session_id"), (("s", None, TIME, None), "null event_name"),
               (("s", "x", None, None), "null event_datetime"), (("v", "x", TIME, None), "orphan session_id"),
               (("s", "x", TIME, "m"), "orphan product_id")],
    "order_items": [((None, "p", 1, "1"), "null order_id"), (("o", None, 1, "1"), "null product_id"),
                    (("o", "p", None, "1"), "null quantity"), (("o", "p", 1, None), "null unit_price"),
                    (("g", "p", 1, "1"), "orphan order_id"), (("o", "d", 1, "1"), "orphan product_id")],
    "ad_spend": [((None, 1, 1, DAY, "1"), "null spend_id"), ((2, None, 1, DAY, "1"), "null channel_id"),
                 ((3, 1, None, DAY, "1"), "null campaign_id"), ((4, 1, 1, None, "1"), "null spend_date"),
                 ((5, 1, 1, DAY, None), "null amount"), ((6, 2, 1, DAY, "1"), "orphan channel_id"),
                 ((7, 1, 6, DAY, "1"), "orphan campaign_id"), ((8, 1, 1, DAY, "1"), "duplicate spend_id"),
                 ((8, 1, 1, DAY, "3"), "duplicate spend_id")],
}


def marts(spark, rows):
    out = {}
    for table, c in gate.CONTRACTS.items():
        text = ", ".join(f"{n} STRING" for n in c.schema.names)
        data = [tuple(None if v is None else str(v) for v in r) for r in rows[table]]
        out[table] = spark.createDataFrame(data, text)  # types come from the contract
    return out


def kept(spark):
    folder = scratch_folder(spark, "gate")

    def keep(name, df):
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")
    return keep


def test_one_bad_row_for_each_rule(spark):
    rows = {t: GOOD[t] + [r for r, _ in BAD[t]] for t in GOOD}
    found = gate.gate(marts(spark, rows), kept(spark))
    assert {t: df.count() for t, df in found.loaded.items()} == {t: len(r) for t, r in GOOD.items()}
    assert all(found.loaded[t].schema.simpleString() == c.schema.simpleString() for t, c in gate.CONTRACTS.items())
    want = Counter((t, reason) for t, bad in BAD.items() for _, reason in bad)
    assert {(r["table_name"], r["reason"]): r["rows"] for r in gate.summary(found.refused).collect()} == want


@pytest.mark.parametrize("rows", [GOOD, {t: [] for t in GOOD}], ids=["good", "empty"])
def test_nothing_to_refuse(spark, rows):
    found = gate.gate(marts(spark, rows), kept(spark))
    assert gate.summary(found.refused).count() == 0
    assert {t: df.count() for t, df in found.loaded.items()} == {t: len(r) for t, r in rows.items()}
