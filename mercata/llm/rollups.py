"""Token counts kept up to date by signed deltas.

A batch brings changes of documents: ``insert`` (a document with a count), ``delete``, and
``revise`` (a new count, source or language). The document log gets signed rows: a delete or
revision takes back what the log still holds for the document and tokenizer version, an insert
or revision adds the new count. Totals by source, language and tokenizer version are sums of the
log's sums per batch, so they are never counted anew.

A batch is a folder of its own that is written as a whole. Committing the same batch again
replaces it, looking at earlier batches only, so retries and repeats change nothing. Batches are
numbered and come in order: each looks at those of lower numbers, and in these only at the buckets
of ids (64 by hash) that its deletes and revisions touch, so a small batch reads a small part of
the log. A bucket may hold much of the rows (all without an id); it is then written by many tasks.

Texts that are NULL have no tokens; NULL sources and languages are groups of their own, and rows
without an id are one document that is inserted as often. A
document that is inserted twice counts twice, as its rows do; a revision or delete takes all of
them back. Changes of one document in one batch: deletes and revisions first, then one row per
insert or revision. Empty batches are committed too. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.sources.files import Files

GROUP = ("source", "lang", "version")
BATCH = "batch="
BUCKETS = 64
LOG = "doc_id bigint, source string, lang string, version string, docs bigint, tokens bigint, batch int, bucket int"
DELTA = "source string, lang string, version string, docs bigint, tokens bigint, batch int"

# Tokenizer versions that are plain patterns; any other count column serves as well.
PATTERNS = {"words_1": r"[^\x20\x09-\x0D]+", "marks_2": r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]"}


def count_tokens(text: Column, version: str) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(PATTERNS[version])).cast("long")


def _batches(spark: SparkSession, path: str) -> list[int]:
    names = Files(spark, path).children(path)
    return sorted(int(n[len(BATCH):]) for n in names if n.startswith(BATCH))


def _read(spark: SparkSession, path: str, schema: str, below: int | None = None) -> DataFrame:
    """The rows of all batches, or of those below one."""
    folders = [f"{path}/{BATCH}{b}" for b in _batches(spark, path) if below is None or b < below]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def _bucket() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int").alias("bucket")


def commit(spark: SparkSession, store: str, batch: int, changes: DataFrame) -> None:
    """``changes``: op, doc_id, source, lang, version, tokens (the last ones unused by deletes;
    a delete without version takes back all versions). ``batch`` is 1 or more; one that is not there
    is refused when there is a higher one, whose deletes did not know it."""
    if batch < 1:
        raise ValueError("batches are numbered from 1")
    there = _batches(spark, f"{store}/log")
    if there and batch < there[-1] and batch not in there:
        raise ValueError(f"batch {batch} comes after batch {there[-1]}")
    back = (changes.where(F.col("op").isin("delete", "revise"))
            .select(F.col("doc_id").alias("id"), F.col("version").alias("only"), _bucket()).distinct())
    touched = [r["bucket"] for r in back.select("bucket").distinct().collect()]  # BUCKETS numbers at most
    log = _read(spark, f"{store}/log", LOG, batch).where(F.col("bucket").isin(touched))
    # A document named with and without version must not be taken back twice.
    taken = (log.join(back.drop("bucket"), F.col("doc_id").eqNullSafe(F.col("id")))
             .where(F.col("only").isNull() | (F.col("only") == F.col("version")))
             .groupBy("doc_id", "source", "lang", "version")
             .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"),
                  F.count_distinct(F.coalesce("only", F.lit(""))).alias("named"))
             .select("doc_id", *GROUP, (-F.col("docs") / F.col("named")).cast("long").alias("docs"),
                     (-F.col("tokens") / F.col("named")).cast("long").alias("tokens"))
             .where("docs <> 0 OR tokens <> 0"))
    added = (changes.where(F.col("op").isin("insert", "revise"))
             .select("doc_id", *GROUP, F.lit(1).cast("long").alias("docs"),
                     F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens")))
    (taken.unionByName(added).withColumn("bucket", _bucket()).hint("rebalance", F.col("bucket"))
     .write.mode("overwrite").partitionBy("bucket").parquet(f"{store}/log/{BATCH}{batch}"))
    # The batch's part of the totals comes from what was written, and is written last.
    written = spark.read.schema(LOG).parquet(f"{store}/log/{BATCH}{batch}")
    (written.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
     .write.mode("overwrite").parquet(f"{store}/delta/{BATCH}{batch}"))


def totals(spark: SparkSession, store: str) -> DataFrame:
    """source, lang, version, docs, tokens; groups without documents are left out."""
    return (_read(spark, f"{store}/delta", DELTA).groupBy(*GROUP)
            .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0"))
