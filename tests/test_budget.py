import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frames import got
from mercata.functions import grounding as g
from mercata.operators import budget as b


@pytest.mark.parametrize("roas, direction, change", [
    ("1.51", "Increase", 15), ("1.50", "Maintain", 0), ("0.80", "Maintain", 0),
    ("0.79", "Decrease", -20), (None, "Maintain", 0)])
def test_recommendation(frame, roas, direction, change):
    row = b.recommend(frame("roas DECIMAL(10;2)", [(roas,)])).first()
    assert (row.recommend_direction, row.suggested_change_pct) == (direction, change)


def performance(frame):
    cac = frame("channel_id INT, channel_name STRING, total_spend DECIMAL(18;2), "
                "total_revenue DECIMAL(18;2), cac DECIMAL(18;2), roas DECIMAL(18;2)", [
                    (1, "google / cpc", "1656.42", "2136.78", "38.50", "1.29"),
                    (2, "direct", 0, 5, None, None), (3, "bing / cpc", 100, 0, 10, 0)])
    attribution = frame("channel_id INT, attribution_model STRING, "
                        "attributed_revenue DECIMAL(18;2)", [
                            (1, "linear", "2702.50"), (1, "time_decay", 1), (2, "linear", 9)])
    return b.channel_performance(cac, attribution)


def test_performance_keeps_paid_channels(frame):
    out = performance(frame)
    rows = got(out, "channel_id", "attributed_revenue_linear", "marginal_roas_signal")
    assert [(r[0], None if r[1] is None else float(r[1])) for r in rows] == [(1, 2702.5), (3, None)]
    assert rows[0][2] == pytest.approx(2702.5 / 1656.42) and rows[1][2] is None


def test_the_dictated_sentence_is_flagged_as_mislabelled(frame):
    recs = b.recommend(performance(frame)).where("channel_id = 1")
    rendered = b.render_explanation(recs)
    assert rendered.first().response == (
        "google / cpc spent $1656.42 and generated $2702.5 in attributed revenue, resulting in a "
        "ROAS of 1.29 and a CAC of $38.5. Based on this ROAS, the recommendation is to Maintain "
        "spend by 0%.")
    assert b.validate_explanations(rendered).first().validation_status == g.STATUS_MISLABELLED


@pytest.mark.parametrize("prompt, response, status", [
    ("a 10 b 200", "we spent 10.1", g.STATUS_PASSED), ("a 10 b 200", "we spent 10.25", g.STATUS_UNVERIFIED),
    ("a 10 b 200", "about 203", g.STATUS_PASSED), ("a 10 b 200", "about 203.1", g.STATUS_UNVERIFIED),
    ("1,234.5", "-1234.5", g.STATUS_PASSED), ("none", "no numbers", g.STATUS_PASSED),
    ("0", "0.05", g.STATUS_PASSED), ("", "5", g.STATUS_UNVERIFIED),
    ("5", "roas is $5", g.STATUS_MISLABELLED), ("5 9", "$9 or roas 7", g.STATUS_UNVERIFIED)])
def test_status(frame, prompt, response, status):
    df = frame("channel_name STRING, recommend_direction STRING, suggested_change_pct INT, "
               "prompt STRING, response STRING", [("c", "Maintain", 0, prompt, response)])
    assert b.validate_explanations(df).first().validation_status == status


def plain_numbers(text):
    return [abs(float(m)) for m in re.findall(r"-?\d+\.?\d*", text.replace(",", ""))]


def plain_first_bad(response, prompt):
    for n in plain_numbers(response):
        if not any(abs(n - p) <= 0.1 or (p != 0 and abs(n - p) / p <= 0.015)
                   for p in plain_numbers(prompt)):
            return n
    return None


def plain_mislabelled(text):
    words = text.split()
    hits = [i for i, w in enumerate(words) if "ROAS" in w.upper()]
    return any("$" in w for i in hits for w in words[max(0, i - 5):i + 6])


TOKENS = st.lists(st.sampled_from(
    ["ROAS", "roas,", "$5", "$", "x", "1,234.5", "38.", "-7", "7.05", "0", "100", "101.4", "1.2.3",
     "a$ROASb", "٣", "é12", " ", "\x1f", "\n", "　", "--5", ".5", "日本"]), max_size=14)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(TOKENS, TOKENS), min_size=25, max_size=25))
def test_text_checks_against_plain_python(spark, pairs):
    rows = [(" ".join(r), " ".join(p)) for r, p in pairs]
    out = spark.createDataFrame(rows, "r STRING, p STRING").select(
        "r", "p", g.extract_numbers(F.col("r")).alias("n"),
        g.first_unverified(F.col("r"), F.col("p")).alias("bad"),
        g.mislabelled(F.col("r")).alias("mis")).collect()
    for row in out:
        assert row.n == plain_numbers(row.r)
        assert row.bad == plain_first_bad(row.r, row.p)
        assert row.mis == plain_mislabelled(row.r)
