"""First row per key, joins on skewed keys, and dense ids, without a task that holds a
whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_SALT = 1_000_000  # rows of one key that one join group may hold


def first_per_key(df: DataFrame, keys: Sequence[str | Column],
                  order_by: Sequence[str | Column]) -> DataFrame:
    """First row of each key by ``order_by``; NULL keys equal each other.

    ``row_number() = 1`` is planned as a group limit before the shuffle as well as
    after it: each input split sends at most one row of a key, however many it has.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


COPIES = "_copies"


def first_counted(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """First row of each key by ``order_by`` (ascending, then by all columns), with the number of
    the key's rows in COPIES and the sums of the columns ``sums`` over all of them.

    An aggregate with a partial step: each input split sends one row of a key.
    """
    rest = [c for c in df.columns if c not in keys and c not in sums]
    order = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order_by)])
    first = F.min(F.struct(order.alias("_order"), F.struct(*rest).alias("_row"))).alias("_first")
    return (df.groupBy(*keys).agg(first, F.count("*").alias(COPIES), *[F.sum(c).alias(c) for c in sums])
            .select(*[c if c in keys else F.col(f"_first._row.{c}").alias(c) for c in df.columns if c not in sums],
                    COPIES, *sums))


def salts(rows: Column, rows_per_salt: int) -> Column:
    """Number of parts a key with this many rows is split into."""
    return F.ceil(rows / F.lit(rows_per_salt)).cast("int")


def join_by_key(rows: DataFrame, lookup: DataFrame, key: str, how: str = "left",
                rows_per_salt: int = ROWS_PER_SALT,
                sizes: DataFrame | None = None) -> DataFrame:
    """Join rows with a frame that has each key once, splitting hot keys.

    A key with more than ``rows_per_salt`` rows is cut into salts by the content of its rows
    and by input split (which separates identical rows); both stay the same when a task is
    run again, and rows that arrive in one partition by their key spread as well. Its
    lookup row is copied once per salt. The list of hot keys has at most
    |rows| / rows_per_salt entries and is broadcast. Rows with a NULL key match nothing
    and are spread as well. ``sizes`` (key, count) is given by callers that have it, or
    whose ``rows`` are costly to compute a second time.
    """
    if sizes is None:
        sizes = rows.where(F.col(key).isNotNull()).groupBy(key).count()
    hot = (sizes.where(F.col("count") > rows_per_salt)
           .select(key, salts(F.col("count"), rows_per_salt).alias("_salts")))
    hashable = [F.col(f"`{f.name}`") for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    split = F.spark_partition_id() + F.xxhash64(*hashable) % F.lit(1 << 20) if hashable else F.spark_partition_id()
    salt = (F.when(F.col(key).isNull(), split.cast("int"))
            .otherwise(F.coalesce(F.pmod(split, F.col("_salts")).cast("int"), F.lit(0))))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    spread = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("_salts")
    copied = lookup.join(F.broadcast(hot), key, "left").withColumn("_salt", copies).drop("_salts")
    return spread.join(copied, [key, "_salt"], how).drop("_salt")


def first_seen_ids(df: DataFrame, key: str, position: Sequence[str], id_name: str, scratch: str,
                   keep: Sequence[Column] = ()) -> DataFrame:
    """Number the values of ``key`` 1..n in the order in which they first occur by ``position``.

    The least position of each value is found with a partial step, so an input split sends a row of
    a value. The values are dealt in ranges of (position, key), numbered in each and written; the
    sizes of the ranges, one row a partition, become offsets. The ids depend on the rows alone, not
    on how they are partitioned, and ``df`` is computed once. ``keep`` are aggregates to carry along.
    """
    first = F.min(F.struct(*position)).alias("_first")
    seen = df.groupBy(key).agg(first, *keep).repartitionByRange("_first", key).sortWithinPartitions("_first", key)
    low_bits = (1 << 33) - 1  # the place within its partition
    seen.select("*", F.spark_partition_id().alias("_range"),
                F.monotonically_increasing_id().bitwiseAND(F.lit(low_bits)).alias("_place")) \
        .drop("_first").write.mode("overwrite").parquet(scratch)
    seen = df.sparkSession.read.parquet(scratch)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (seen.groupBy("_range").agg(F.count("*").alias("_size"))
               .select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")))
    return (seen.join(F.broadcast(offsets), "_range")  # a row for each partition
            .withColumn(id_name, (F.col("_offset") + F.col("_place") + 1).cast("int"))
            .drop("_range", "_place", "_offset"))
