"""A corpus pipeline of five stages, each written as Parquet and read again by the next.

Quality rules, near-duplicate removal by n-gram Jaccard similarity, benchmark decontamination,
masking of secrets, packing into token sequences. Each stage works on what the one before kept;
all but the last return the columns of ``documents``.

Repeated rows (same id and text) stay once from the second stage on. The first three stages judge
rows by their text, so that rows which share an id, or have none, do not share a fate; a NULL id comes
after all others. Rows are told apart by 64 bits of a hash. NULL and empty texts fail the quality
rules. Empty tables give empty results; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.llm import decontam, jaccard, packing, quality, secrets
from mercata.llm.queries import END, tokenizer
from mercata.session import scratch_folder

# Tokens of a public tokenizer file and edit distances have no SQL: the stages are tested
# against brute-force versions.
ORACLE_SQL = None


def _keyed(docs: DataFrame, *columns: str) -> tuple[DataFrame, str]:
    """Documents with a hash of these columns, NULLs included, and its name, longer than all others."""
    name = "_" * (1 + max(map(len, docs.columns)))
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return docs.withColumn(name, F.xxhash64(*parts)), name


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, judged row by row."""
    return quality.keep(docs)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id, then hash."""
    keyed, key = _keyed(docs, "doc_id", "text")
    linked = jaccard.linked(spark, keyed, scratch_folder(spark, "pipeline-jaccard"), key=key)
    # Repeated rows have one key.
    of = linked.select(F.col("doc_id").alias(key), "component_id").distinct()
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(key).alias("key"))
    kept = (of.join(keyed.select(key, "doc_id").distinct(), key).groupBy("component_id")
            .agg(F.min(rank).alias("least")).select(F.col("least.key").alias(key)))
    return keyed.join(kept, key, "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has no region of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed, key = _keyed(docs, "text")
    found = decontam.regions(spark, keyed, benchmark, key=key).select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(found, key, "left_anti").select(*docs.columns)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets that the ledger reports masked in their texts."""
    ledger = scratch_folder(spark, "pipeline-secrets")
    secrets.scan(spark, docs, ledger, "1")
    found = secrets.findings(spark, docs, ledger, ["doc_id"]).where(F.size("findings") > 0).select(
        F.col("doc_id").alias("__key"), F.lit(True).alias("__hit")).distinct()
    hit = docs.join(found, docs["doc_id"].eqNullSafe(found["__key"]), "left")
    text = F.when(F.col("__hit"), secrets.masked(F.col("text"))).otherwise(F.col("text"))
    masked = text.alias("text")
    return hit.select(*[masked if c == "text" else (F.char_length(text).cast("long").alias(c) if c == "n_chars" else F.col(c))
                        for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return packing.pack(spark, docs, tokenizer(), scratch_folder(spark, "pipeline-packing"), END)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("jaccard", jaccard_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared scratch folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
