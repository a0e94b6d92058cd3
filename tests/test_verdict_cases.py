"""Hand-made rows on which earlier versions were wrong."""

from decimal import Decimal as D

import pytest
from frames import got
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

from mercata.functions.columns import parse_date
from mercata.operators import analytics, channels, quality
from mercata.operators.keys import join_by_key
from mercata.sources import readers, writers


def test_campaigns_without_a_date_are_never_active(frame):
    daily = frame("channel_id INT, spend_date DATE, amount INT", [(1, "2024-01-05", 3)])
    campaigns = frame("channel_id INT, campaign_id INT, start_date DATE, end_date DATE", [
        (1, 7, None, "2024-02-01"), (1, 8, "2024-01-01", None), (1, 9, "2024-01-01", "2024-01-31")])
    assert got(channels.assign_campaign(daily, campaigns), "campaign_id") == [(9,)]


def test_null_primary_keys_are_refused(frame):
    df = frame("id INT, v INT", [(None, 1), (None, 2), (1, 3), (2, 4), (2, 5)])
    good, bad = quality.enforce(df, pk="id", on_violation="quarantine")
    assert got(good, "v") == [(3,)]
    assert got(bad, "v", "reason") == [(1, "null id"), (2, "null id"), (4, "duplicate id"), (5, "duplicate id")]


def test_every_broken_rule_is_told(spark):
    df = spark.createDataFrame([tuple(None if i == j else 1 for j in range(25)) for i in range(25)],
                               ", ".join(f"c{j} int" for j in range(25)))
    with pytest.raises(quality.ConstraintViolation) as told:
        quality.enforce(df, not_null=df.columns)
    assert str(told.value).count("1 rows") == 25


def test_orphans_with_a_repeated_parent(frame):
    child = frame("fk INT", [(1,), (1,), (2,), (None,)])
    parent = frame("pk INT", [(1,), (1,), (1,)])
    assert got(quality.orphan_keys(child, "fk", parent, "pk")) == [(2, 1)]


def test_large_prices(frame):
    items = frame("product_id INT, order_id INT, quantity INT, unit_price DECIMAL(18;2)", [(1, 1, 1, "15000000000.00")])
    products = frame("product_id INT, product_name STRING, category STRING, base_price DECIMAL(18;2)",
                     [(1, "a", "b", "20000000000.00")])
    row = analytics.pricing_analytics(items, products).first()
    assert row["base_price"] == D("20000000000.00") and row["discount_pct"] == 25


def test_dates_with_a_time_part(frame):
    df = frame("t STRING", [("2024-01-05",), ("2024-01-05 00:00:00",), ("2024-01-05x",), (None,)])
    assert [str(r[0]) for r in df.select(parse_date(F.col("t"), "yyyy-MM-dd")).collect()] == \
        ["2024-01-05", "2024-01-05", "None", "None"]


def test_csv_whole_numbers_blanks_and_line_breaks(spark, tmp_path):
    schema = StructType().add("x", IntegerType()).add("y", LongType()).add("t", StringType())
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text("y,x,t\n1604188800.0,3.0,a\n2,2.5,b\n,x,c\n")
    assert got(readers.read_csv(spark, str(tmp_path / "in"), schema)) == [
        (None, None, "c"), (None, 2, "b"), (3, 1604188800, "a")]
    df = spark.createDataFrame([(1, 2, "  padded  "), (2, 3, "two\nlines, \"quoted\"")], schema)
    writers.write_csv(df, str(tmp_path / "out"))
    assert got(readers.read_csv(spark, str(tmp_path / "out"), schema, multiline=True)) == got(df)


def test_csv_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n2,1\n")
    schema = StructType().add("x", IntegerType()).add("y", IntegerType())
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv(spark, str(tmp_path), schema).collect()


def test_hot_keys_split_after_a_shuffle_on_them(spark):
    rows = spark.range(4000).select(F.lit(1).alias("k"), "id").repartition(4, "k")
    lookup = spark.createDataFrame([(1, "a")], "k int, v string")
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = join_by_key(rows, lookup, "k", "inner", rows_per_salt=100)
        assert out.select(F.spark_partition_id()).distinct().count() > 1 and out.count() == 4000
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
