"""Plan shapes the operators are written for."""

import pytest

from mercata.operators import analytics, clean, touchpoints
from mercata.plans import testbed as t
from mercata.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
WRITES = {"scan_events_nested", "scan_items_nested", "read_csv_typed", "write_csv", "full_refresh",
          "append_log"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_pairing_and_no_python(spark, name):
    p = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "Python" not in p and "Pandas" not in p


def test_first_rows_are_limited_before_the_shuffle(spark):
    for df in (clean.dedup_first(t.raw_events(spark, SF), clean.EVENT_KEY, ["line_no"]),
               t.e_sessions(spark, SF),
               analytics.first_session(t.e_sessions(spark, SF)),
               touchpoints.last_sessions_per_day(t.e_sessions(spark, SF))):
        p = plan(df)
        assert "WindowGroupLimit" in p and ", Partial" in p and ", Final" in p


def test_scans_read_only_what_is_used(spark):
    p = plan(QUERIES["read_columns"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in p
    p = plan(t.e_orders(spark, SF))
    assert "EqualTo(event_type,purchase)" in p and "props" not in p


def test_small_dimension_is_broadcast_and_sessions_do_not_move(spark):
    sessions = t.e_sessions(spark, SF)
    moved = plan(sessions).count("Exchange hashpartitioning")
    p = plan(touchpoints.match_channel(sessions, t.channel_rows(spark)))
    assert "BroadcastHashJoin" in p and p.count("Exchange hashpartitioning") == moved


def test_funnel_needs_no_row_expansion(spark):
    assert "Expand" not in plan(QUERIES["funnel_conversion"](spark, SF))
