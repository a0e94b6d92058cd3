import os

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from frames import got
from mercata.plans import testbed
from mercata.session import scratch_folder
from mercata.sources import readers, writers

SF = "/root/testdata/sf0.001"


def test_scan_prunes_partitions_and_pushes_names(spark):
    path = scratch_folder(spark, "test-scan")
    writers.write_partitioned(testbed.nested_events(spark, SF), path, "event_date")
    scan = readers.scan_events(spark, path, "20240105", "20240108", readers.ITEM_EVENT_NAMES)
    want = testbed.nested_events(spark, SF).where(
        "event_date BETWEEN '20240105' AND '20240108' AND event_name <> 'page_view'")
    assert got(scan, "event_id") == got(want, "event_id")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "In(event_name" in plan


def test_csv_missing_values_and_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,extra,s\n1,x,"a,""b"""\nNA,x,None\n<NA>,x,null\nbad,x,ok\n')
    schema = StructType([StructField("s", StringType()), StructField("n", IntegerType()),
                         StructField("absent", IntegerType())])
    rows = readers.read_csv(spark, str(tmp_path / "a.csv"), schema).collect()
    assert [tuple(r) for r in rows] == [('a,"b"', 1, None), (None, None, None), (None, None, None),
                                        ("ok", None, None)]


def test_full_refresh_replaces_and_log_appends(spark, frame):
    df = frame("a INT", [(1,), (2,)])
    table, log = scratch_folder(spark, "t"), scratch_folder(spark, "l")
    for _ in range(2):
        writers.full_refresh(df, table)
        writers.append_log(df, log)
    assert writers.read_table(spark, table).count() == 2 and writers.read_table(spark, log).count() == 4


def test_conform_drops_casts_and_adds(spark, frame):
    schema = StructType([StructField("a", IntegerType()), StructField("b", StringType())])
    out = writers.conform_schema(frame("a BIGINT, z INT", [(1, 2)]), schema)
    assert out.schema == schema and got(out) == [(1, None)]


def test_row_counts(frame):
    out = writers.row_counts({"x": frame("a INT", [(1,), (None,)]), "y": frame("a INT", [(1,)])})
    assert got(out) == [("x", 2), ("y", 1)]


def test_read_view(spark, frame):
    frame("a INT, b INT", [(1, 1), (2, 2), (3, None)]).createOrReplaceTempView("v_test")
    out = readers.read_view(spark, "v_test", where="b IS NOT NULL", order=[F.desc("a")], limit=1,
                            columns=["a"])
    assert got(out) == [(2,)]


def test_scratch_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_folder(spark, "x")
    assert path.startswith(base or spark.conf.get("spark.checkpoint.dir"))
    assert not os.path.exists(path)
