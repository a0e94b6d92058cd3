"""The numbered operators over their whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.llm import (decontam, hyperminhash, infill, jaccard, packing, quality, rans, revisits, rollups, secrets,
                         substring, tokens, treap, urlfilter)
from mercata.session import scratch_folder

END = 2
VOCABULARY = 49_408


def tokenizer() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    ledger = scratch_folder(spark, "secrets")
    secrets.scan(spark, docs, ledger, "1")
    found = secrets.findings(spark, docs, ledger, ["doc_id"])
    base = [r.kind for r in secrets.BASE]
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in base],
                        F.sha2(secrets.spans(kinds=base).cast("binary"), 256).alias("base_sha256"), secrets.spans().alias("spans"))


def substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return substring.deduplicated(spark, docs, scratch_folder(spark, "substring"), keep_text=False)


def token_files(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    folder = scratch_folder(spark, "tokens")
    tokens.tokenized(docs, tokenizer(), END, width=2).write.parquet(f"{folder}/ids")
    rans.write(spark, spark.read.parquet(f"{folder}/ids"), f"{folder}/files", VOCABULARY)
    return rans.read(spark, f"{folder}/files", VOCABULARY).select(
        "doc_id", "start", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def revisit_resolution(spark: SparkSession, sf: str) -> DataFrame:
    found = revisits.resolve(revisits.captures_of_pages(table(spark, sf, "pages")))
    entries = F.transform(F.map_entries("headers"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    crawls = F.lit(revisits.CRAWLS)
    return found.select(F.floor(F.col("record") / crawls).alias("page_id"), (F.col("record") % crawls).alias("crawl"), "url",
                        F.col("source").alias("source_record"), "outcome",
                        F.array_join(entries, ";").alias("headers"))


def url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urlfilter.judge(spark, table(spark, sf, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict")


def sequence_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.pack(spark, table(spark, sf, "documents"), tokenizer(), scratch_folder(spark, "packing"), END)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def token_rollups(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches: all documents by one tokenizer version, and by a second one; texts under 200
    characters are deleted in that version's counts, documents with a label are revised in the
    first one's, under their quality as source. The second batch is committed twice."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    store = scratch_folder(spark, "rollups")

    def counted(version: str) -> DataFrame:
        return docs.select(F.lit("insert").alias("op"), "doc_id", "source", "lang", F.lit(version).alias("version"),
                           rollups.count_tokens(F.col("text"), version).alias("tokens"))

    rollups.commit(spark, store, 1, counted("words_1"))
    for _ in range(2):
        rollups.commit(spark, store, 2, counted("marks_2"))
    short = docs.where(F.char_length(F.coalesce("text", F.lit(""))) < 200).select(
        F.lit("delete").alias("op"), "doc_id", F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("lang"),
        F.lit("marks_2").alias("version"), F.lit(None).cast("bigint").alias("tokens"))
    named = (counted("words_1").join(labels, "doc_id")
             .select(F.lit("revise").alias("op"), "doc_id", F.concat(F.lit("quality "), "quality").alias("source"),
                     "lang", "version", "tokens"))
    rollups.commit(spark, store, 3, short.unionByName(named))
    return rollups.totals(spark, store)


def quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.verdicts(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.linked(spark, table(spark, sf, "documents"), scratch_folder(spark, "jaccard"))


def benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.regions(spark, table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def near_copies(spark: SparkSession, sf: str) -> DataFrame:
    return hyperminhash.linked(spark, table(spark, sf, "documents"), scratch_folder(spark, "hyperminhash"))


def fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return infill.transformed(table(spark, sf, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
        sha(infill.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    return treap.ranked(spark, table(spark, sf, "documents"), table(spark, sf, "benchmark"), scratch_folder(spark, "treap"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": secret_scan,
    "op2_substring_dedup": substring_dedup,
    "op3_token_files": token_files,
    "op4_revisit_resolution": revisit_resolution,
    "op5_url_filter": url_filter,
    "op6_sequence_packing": sequence_packing,
    "op7_token_rollups": token_rollups,
    "op8_quality_rules": quality_rules,
    "op9_ngram_jaccard": ngram_jaccard,
    "op10_benchmark_decontamination": benchmark_decontamination,
    "op11_near_copies": near_copies,
    "op12_fill_in_middle": fill_in_middle,
    "op13_ranked_search": ranked_search,
}
