import pytest
from frames import got
from pyspark.sql import functions as F

from compare import differences, oracle_connection

from mercata.plans import oracle, refresh, testbed, views
from mercata.session import scratch_folder
from mercata.sources import snapshots, writers

SF = "/root/testdata/sf0.001"


def run(spark, target, export, date_to="20240131", run=None):
    return refresh.refresh(
        spark, export, target, date_from="20240101", date_to=date_to, run=run,
        channels=testbed.channel_rows(spark), campaigns=testbed.raw_campaigns(spark, SF),
        ad_spend=testbed.ad_spend(spark, SF).withColumn(
            "spend_date", F.col("spend_date").cast("string")))


def test_refresh_fails_whole_and_can_be_repeated(spark, monkeypatch):
    export, target = scratch_folder(spark, "export"), scratch_folder(spark, "warehouse")
    writers.write_partitioned(testbed.nested_events(spark, SF), export, "event_date")
    first = run(spark, target, export, "20240110", "nightly")
    store = snapshots.Store(spark, target)
    before = {t: store.read(t).count() for t in store.tables()}
    checks = views.quality_checks
    monkeypatch.setattr(views, "quality_checks", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):  # after most tables were written
        run(spark, target, export, "20240131", "nightly")
    assert store.current() == 1 and {t: store.read(t).count() for t in store.tables()} == before
    monkeypatch.setattr(views, "quality_checks", checks)
    second = run(spark, target, export, "20240131", "nightly")
    assert second.version == 2 and store.read("data_quality_log").count() == 23  # of the repeated run only
    assert second.marts["events"].count() > first.marts["events"].count() == before["marts/events"]
    assert store.read("marts/events", 1).count() == before["marts/events"]
    assert second.quality_summary.first().total == 23
    # Purchases without a priced item have no total; their items have no order then.
    assert {(r.table_name, r.reason) for r in second.quarantine.collect()} == {
        ("orders", "null order_total"), ("order_items", "orphan order_id")}
    assert second.marts["customers"].count() == 15
    assert got(store.read("cleaning_log")) == got(second.cleaning_log)
    assert {r.file for r in second.cleaning_log.collect()} == {
        "ga4_events.csv", "ga4_items.csv", "marketing_channels.csv", "campaigns.csv",
        "ad_spend.csv"}
    # Sessions in the export lack their id in part, so they are compared on what does
    # not depend on it: spend per channel and the products.
    con = oracle_connection(SF)
    assert differences(
        views.presentable(spark.table("vw_channel_cac_roas").select("channel_id", "total_spend")),
        con, oracle.with_ctes("""SELECT channel_id, COALESCE(CAST(SUM(amount) AS DOUBLE), 0)
            AS total_spend FROM chan LEFT JOIN spend USING (channel_id) GROUP BY 1""",
                              "chan", "spend")) is None
    assert differences(views.presentable(second.marts["products"]), con,
                       oracle.build()["mart_products"]) is None
    total = spark.table("vw_attribution_comparison").groupBy("attribution_model") \
        .agg({"attributed_orders": "sum"}).count()
    assert total == 3


def test_refused_rows_are_counted(spark, frame):
    """Orders without a total and channels of one name show in the counts of a refresh."""
    export, target = scratch_folder(spark, "export"), scratch_folder(spark, "warehouse")
    dirty = testbed.nested_events(spark, SF).withColumn("items", F.when(F.col("event_id") % 3 != 0, F.col("items")))
    writers.write_partitioned(dirty, export, "event_date")
    channels = frame("channel_id INT, channel_name STRING, channel_type STRING", [
        (1, "google / organic", "organic"), (2, "google / cpc", "paid"), (3, "b / m", "other"), (4, "b / m", "other")])
    out = refresh.refresh(
        spark, export, target, date_from="20240101", date_to="20240131", channels=channels,
        campaigns=testbed.raw_campaigns(spark, SF),
        ad_spend=testbed.ad_spend(spark, SF).withColumn("spend_date", F.col("spend_date").cast("string")))
    refused = {(r.table_name, r.reason): r.rows for r in out.quarantine.collect()}
    assert refused["marketing_channels", "duplicate channel_name"] == 2
    assert refused["orders", "null order_total"] > 0
    assert snapshots.Store(spark, target).read("quarantine/orders").count() == refused["orders", "null order_total"]
