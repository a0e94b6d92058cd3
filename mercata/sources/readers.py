"""Reading event exports, typed CSV files, warehouse tables and named views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, ByteType, DataType, DecimalType, DoubleType, FloatType,
                               IntegerType, IntegralType, LongType, NullType, ShortType, StringType,
                               StructField, StructType)

from mercata.functions.columns import event_param, items_value, session_key
from mercata.schemas import NESTED_EVENT
from mercata.session import scratch_folder
from mercata.sources.files import Files
from mercata.sources.records import csv_records

SHARD = "event_date="

# Event names the two exports keep, and texts a CSV means NULL by.
EVENT_NAMES = ("page_view", "view_item", "add_to_cart", "begin_checkout", "purchase")
ITEM_EVENT_NAMES = ("view_item", "add_to_cart", "begin_checkout", "purchase")
NULL_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
              "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


class SchemaConflict(ValueError):
    """Two shards store a field in types that have no common wider one."""


_WHOLE = (ByteType, ShortType, IntegerType, LongType)


def merged(a: DataType, b: DataType, name: str = "") -> DataType:
    """The type that holds both: fields of either, in the order of ``a``, the wider of two numbers."""
    if isinstance(a, StructType) and isinstance(b, StructType):
        fields = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            fields[f.name] = merged(fields[f.name], f.dataType, f"{name}.{f.name}".lstrip(".")) if f.name in fields else f.dataType
        return StructType([StructField(n, t) for n, t in fields.items()])
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(merged(a.elementType, b.elementType, f"{name}[]"))
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: [type(t) is w for w in _WHOLE].index(True))
    if isinstance(a, (FloatType, DoubleType)) and isinstance(b, (FloatType, DoubleType)):
        return DoubleType()
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        return DecimalType(min(38, max(a.precision - a.scale, b.precision - b.scale) + scale), scale)
    raise SchemaConflict(f"{name or 'type'}: {a.simpleString()} and {b.simpleString()}")


def shards(spark: SparkSession, path: str, date_from: str, date_to: str) -> list[str]:
    """Folders of the days within the bounds. Only the names below ``path`` are listed."""
    names = Files(spark, path).children(path)
    return sorted(f"{path.rstrip('/')}/{n}" for n in names
                  if n.startswith(SHARD) and date_from <= n[len(SHARD):] <= date_to)


def scan_events(spark: SparkSession, path: str, date_from: str, date_to: str,
                names: Sequence[str] = EVENT_NAMES, schema: StructType = NESTED_EVENT) -> DataFrame:
    """Nested events of a date range and a set of names.

    The folder is partitioned by ``event_date`` (``yyyyMMdd`` text). Days out of the range are
    neither listed nor read, and the name list is pushed into the Parquet scan. Days may differ in
    shape: ``schema`` is widened by what the days of the range store (the types of one file for
    each day), and what a day lacks, down to fields of structs, is NULL. No day in the range gives
    an empty frame.
    """
    days = shards(spark, path, date_from, date_to)
    for day in days:
        schema = merged(schema, spark.read.parquet(day).schema)
    if not days:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return (spark.read.schema(schema).option("basePath", path).parquet(*days).select(*schema.fieldNames())
            .where(F.col("event_date").between(date_from, date_to) & F.col("event_name").isin(*names)))


def flatten_events(events: DataFrame) -> DataFrame:
    """Nested event rows to the flat raw layout, one row per event."""
    ga = event_param(F.col("event_params"), "ga_session_id")
    return events.select(
        "event_date", "event_timestamp", "event_name", "user_pseudo_id",
        ga.alias("ga_session_id"),
        event_param(F.col("event_params"), "page_location", "string_value").alias("page_location"),
        F.col("traffic_source.source").alias("traffic_source"),
        F.col("traffic_source.medium").alias("traffic_medium"),
        F.col("traffic_source.name").alias("campaign_name"),
        F.col("device.category").alias("device_category"),
        F.col("geo.country").alias("country"),
        F.col("ecommerce.transaction_id").alias("transaction_id"),
        items_value(F.col("items")).alias("items_value"),
        session_key(F.col("user_pseudo_id"), ga).alias("session_id"))


def explode_items(events: DataFrame) -> DataFrame:
    """One row per item of each event; events without items drop out."""
    ga = event_param(F.col("event_params"), "ga_session_id")
    return (events
            .select("event_date", "event_timestamp", "user_pseudo_id",
                    ga.alias("ga_session_id"), "event_name",
                    F.col("ecommerce.transaction_id").alias("transaction_id"),
                    F.explode("items").alias("item"))
            .select("event_date", "event_timestamp", "user_pseudo_id", "ga_session_id",
                    "event_name", "transaction_id", "item.item_id", "item.item_name",
                    "item.item_category", "item.price", "item.quantity",
                    session_key(F.col("user_pseudo_id"), F.col("ga_session_id"))
                    .alias("session_id")))


def _typed(text: Column, kind: DataType) -> Column:
    """The text in its type or NULL; whole numbers may be spelled with a fraction of zeros."""
    if not isinstance(kind, IntegralType):
        return text.try_cast(kind)
    number = text.try_cast("decimal(38,10)")
    return F.coalesce(text.try_cast(kind), F.when(number == F.floor(number), number).try_cast(kind))


def read_csv(spark: SparkSession, path: str, schema: StructType, multiline: bool = False,
             scratch: str | None = None) -> DataFrame:
    """CSV with a header, read as text and cast to ``schema``.

    Every usual spelling of a missing value becomes NULL, and a field that does
    not fit its type becomes NULL too. Columns are found by name in the header, which may
    have another order than ``schema`` or more columns; files of one folder whose headers
    differ are refused when they are read. ``multiline`` allows line breaks in quoted texts; large
    files are still read by many tasks (``records.py``), over lines written to ``scratch``.
    """
    names = spark.read.option("header", True).csv(path).columns  # reads the header only
    shape = StructType([StructField(n, StringType()) for n in names])
    if multiline:
        records = csv_records(spark, path, scratch or scratch_folder(spark, "csv"))
        headers = [r["record"] for r in records.where("header").select("record").distinct().limit(2).collect()]
        if len(headers) > 1:
            raise ValueError(f"files have different headers: {headers}")
        text = (records.where("NOT header")
                .select(F.from_csv("record", ", ".join(f"`{n}` string" for n in names),
                                   {"escape": '"', "multiLine": "true"}).alias("r"))
                .select("r.*"))
    else:
        text = (spark.read.option("header", True).option("enforceSchema", False).option("escape", '"').schema(shape).csv(path))
    return text.select(*[
        _typed(F.when(~F.col(f.name).isin(*NULL_TEXTS), F.col(f.name)), f.dataType).alias(f.name)
        if f.name in names else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Only the named columns; the Parquet scan reads nothing else."""
    return spark.read.parquet(path).select(*columns)


def read_jdbc(spark: SparkSession, url: str, table: str, *, column: str | None = None,
              lower: str | None = None, upper: str | None = None, partitions: int = 1,
              **properties: str) -> DataFrame:
    """A warehouse table or ``(select ...) t`` over JDBC, split on ``column`` if given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if column:
        reader = reader.options(partitionColumn=column, lowerBound=lower, upperBound=upper,
                                numPartitions=str(partitions))
    return reader.load()


def read_view(spark: SparkSession, view: str, *, where: str | Column | None = None,
              order: Sequence[Column] = (), limit: int | None = None,
              columns: Sequence[str] = ("*",)) -> DataFrame:
    """Rows of a registered view: optional filter, order and top-n."""
    df = spark.table(view)
    if where is not None:
        df = df.where(where)
    if order:
        df = df.orderBy(*order)
    if limit is not None:
        df = df.limit(limit)
    return df.select(*columns)
