"""Connected components of a graph of links, by large-star and small-star rounds.

Every round is a shuffle of the links with a minimum per node; nothing but the number of links
and a checksum comes to the driver. A node may have a third of all links: its minimum is taken
before the shuffle, and the join back deals both sides anew (``dealt``), so that adaptive execution
splits it. Rounds are written to the shared scratch folder, so lineage stays short and a lost
executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dealt(rows: DataFrame, reduced: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join of rows with a frame that an aggregate by ``key`` (a whole number) made.

    Joined by the key itself, the aggregate would stand between its shuffle and the join, and Spark
    splits a hot key only where both sides of a join come from a shuffle of their own.
    """
    name = f"__not_{key}"
    turned = F.bitwise_not(F.col(key)).alias(name)
    return rows.withColumn(name, turned).join(
        reduced.select(turned, *[c for c in reduced.columns if c != key]), name, how).drop(name)


def components(spark: SparkSession, links: DataFrame, scratch: str) -> DataFrame:
    """(node, label): the smallest node reachable by ``links`` (a, b); nodes without a link to
    another one are left out."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()

    def least(rows: DataFrame) -> DataFrame:
        return rows.groupBy("u").agg(F.min("v").alias("m"))

    state, n = None, 0
    while True:
        edges.write.mode("overwrite").parquet(f"{scratch}/round-{n}")
        edges = spark.read.schema("u bigint, v bigint").parquet(f"{scratch}/round-{n}")
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                              F.sum(F.col("v").cast("decimal(38,0)"))).first())
        if now == state or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        state, n = now, n + 1
        # Large star: greater neighbours go to the least of the neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (dealt(both, least(both), "u").where("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        # Small star: lesser neighbours and the node itself go to the least of them.
        low = least(large)
        edges = (dealt(large, low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
