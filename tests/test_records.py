"""CSV records over line breaks, and event shards of different shape."""

import random

import pytest
from frames import got
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType, StructField, StructType

from mercata import schemas
from mercata.plans import testbed
from mercata.session import scratch_folder
from mercata.sources import readers, writers
from mercata.sources.records import csv_records

SCHEMA = StructType().add("id", IntegerType()).add("t", StringType()).add("u", StringType())
SF = "/root/testdata/sf0.001"


@pytest.fixture
def small_splits(spark):
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for c, v in old.items():
        spark.conf.set(c, v)


def texts(seed, n):
    r = random.Random(seed)
    piece = ['"', "\n", ",", "a", "bc ", "é", '""', "\n\n", " x", "'", ";"]
    return [(i, "".join(r.choices(piece, k=r.randint(0, 12))) + "e", "z" * r.randint(0, 700 if i % 40 == 0 else 3)) for i in range(n)]


@pytest.mark.parametrize("files", [1, 3])
def test_many_tasks_read_a_file_as_one_would(spark, small_splits, files):
    rows, path = texts(files, 300), scratch_folder(spark, "csv")
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1).repartition(files)
    writers.write_csv(df, path)
    assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 8
    whole = (spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(SCHEMA).csv(path)
             .select("id", "t", F.when(F.col("u") != "", F.col("u")).alias("u")))
    out = readers.read_csv(spark, path, SCHEMA, multiline=True)
    assert got(out) == got(whole) == [(i, t, u or None) for i, t, u in rows]


def test_a_record_runs_through_many_splits(spark, small_splits, tmp_path):
    long = "line\n" * 1000 + 'with "quotes"'
    (tmp_path / "a.csv").write_text('id,t,u\r\n1,"' + long.replace('"', '""') + '",x\r\n\r\n2,plain,"y\r\ny"\r\n')
    assert got(readers.read_csv(spark, str(tmp_path), SCHEMA, multiline=True)) == [(1, long, "x"), (2, "plain", "y\r\ny")]


def test_headers_and_empty_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text('\ufeffu,id,more\n"a\nb",7,1\n')
    assert got(readers.read_csv(spark, str(tmp_path / "in"), SCHEMA, multiline=True)) == [(7, None, "a\nb")]
    (tmp_path / "in/b.csv").write_text("id,u,more\n")
    with pytest.raises(ValueError, match="different headers"):
        readers.read_csv(spark, str(tmp_path / "in"), SCHEMA, multiline=True)
    (tmp_path / "only").mkdir()
    (tmp_path / "only/a.csv").write_text("id,t,u\n")
    assert got(readers.read_csv(spark, str(tmp_path / "only"), SCHEMA, multiline=True)) == []


def test_only_lines_of_broken_records_are_joined(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,t,u\n1,a,b\n2,\"c\nd\",e\n3,f,g\n")
    records = csv_records(spark, str(tmp_path), scratch_folder(spark, "r"))
    assert got(records, "record", "header") == [('1,a,b', False), ('2,"c\nd",e', False), ("3,f,g", False), ("id,t,u", True)]


# --- shards --------------------------------------------------------------

def export(spark):
    path, nested = scratch_folder(spark, "export"), testbed.nested_events(spark, SF)
    wide = F.transform("items", lambda i: i.withField("quantity", i["quantity"].cast("bigint")).withField("colour", F.lit("red")))
    no_category = F.transform("items", lambda i: i.dropFields("item_category"))
    days = {"20240110": nested.drop("geo", "device"), "20240111": nested.withColumn("items", wide),
            "20240112": nested.withColumn("items", no_category), "20240113": nested}
    for day, df in days.items():
        writers.write_partitioned(df.where(F.col("event_date") == day), path, "event_date", mode="append")
    return path


def test_shards_of_different_shape(spark):
    path = export(spark)
    df = readers.scan_events(spark, path, "20240110", "20240112").select("event_date", "geo.country", "device.category", "items")
    by_day = {d: df.where(F.col("event_date") == d) for d in ("20240110", "20240111", "20240112")}
    assert all(x.count() for x in by_day.values())
    assert by_day["20240110"].where("country IS NOT NULL OR category IS NOT NULL").count() == 0
    assert by_day["20240111"].where("country IS NULL").count() == 0
    item = {d: x.select(F.explode("items").alias("i")).select("i.*") for d, x in by_day.items()}
    assert dict(item["20240110"].dtypes)["quantity"] == "bigint"
    assert item["20240110"].where("quantity NOT BETWEEN 1 AND 3 OR colour IS NOT NULL").count() == 0
    assert item["20240111"].where("colour <> 'red' OR quantity IS NULL").count() == 0
    assert item["20240112"].where("item_category IS NOT NULL").count() == 0
    assert item["20240110"].where("item_category IS NULL").count() == 0
    flat = readers.flatten_events(readers.scan_events(spark, path, "20240110", "20240112"))
    assert flat.count() == sum(x.count() for x in by_day.values())


def test_days_out_of_range_are_not_read(spark):
    path = export(spark)
    df = readers.scan_events(spark, path, "20240111", "20240112", ["purchase"])
    assert {f.split("event_date=")[1][:8] for f in df.inputFiles()} == {"20240111", "20240112"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "EqualTo(event_name,purchase)" in plan
    assert df.where("event_name <> 'purchase'").count() == 0 and df.count()
    none = readers.scan_events(spark, path, "20250101", "20250102")
    assert none.count() == 0 and none.columns == schemas.NESTED_EVENT.fieldNames()


def of(**fields):
    return StructType([StructField(n, t) for n, t in fields.items()])


def test_types_without_a_common_one_are_refused():
    a = of(s=of(x=IntegerType(), y=DecimalType(10, 2)))
    b = of(s=of(x=LongType(), z=StringType(), y=DecimalType(9, 4)))
    assert readers.merged(a, b) == of(s=of(x=LongType(), y=DecimalType(12, 4), z=StringType()))
    with pytest.raises(readers.SchemaConflict, match=r"s\.x: int and string"):
        readers.merged(a, of(s=of(x=StringType())))
