"""Not-modified captures resolved to the response they stand for.

An as-of join: a revisit takes the latest full response of its canonical URL with an earlier
time (ties between responses: the greatest record). A URL may hold a third of all rows, so rows
are dealt in ranges of (URL, time, revisits first, record) and written: a URL with many rows has several blocks, a
block is one task's range. A URL's last response per block is carried into its later blocks through
one narrow row a block, and only then the rows of one URL and one block meet in a window.

The validators decide: entity tags (weak comparison), else the modification time, else the
payload digest. ``outcome`` is resolved, mismatch, unverified (no validator on both sides) or
orphan (no earlier response). Merged headers are the response's, overlaid with those that a
not-modified answer may renew; only resolved and unverified revisits get any.

NULL URLs (also those without a scheme and host) are one URL of their own that never matches; a
NULL time is earlier than any other, a NULL record the least. Repeated rows each get a result. An
empty table gives no rows. Only the named columns are read, so others may have any name; texts of
any length are passed on whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercata.session import scratch_folder

# Headers that an answer without a body may renew.
RENEWED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = r"(?:utm_[a-z]+|ref|sessionid|gclid|fbclid)=[^&]*"
RESPONSE = ("struct<time:bigint,record:bigint,etag:string,modified:string,digest:string,"
            "headers:array<struct<key:string,value:string>>>")


def canonical(url: Column) -> Column:
    """Host in lower case, path and query, without scheme, fragment, default port, tracking
    parameter, "www." or closing slash; both schemes are one. NULL without a scheme and host."""
    bare = F.regexp_replace(F.btrim(url), "#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^(?i:https?)://([^/?]*)", 1)), r"^www\.|:(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^(?i:https?)://[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda q: (q != "") & ~q.rlike(f"^{TRACKING}$"))), "&")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def _lowered(headers: Column) -> Column:
    """Entries with keys in lower case, sorted; the first of equal keys stays."""
    entries = F.array_sort(F.transform(F.map_entries(headers), lambda e: F.struct(
        F.lower(e["key"]).alias("key"), e["value"].alias("value"))))
    return F.filter(entries, lambda e, i: (i == 0) | (e["key"] != F.get(entries, i - 1)["key"]))


def resolve(captures: DataFrame, blocks: int | None = None, scratch: str | None = None) -> DataFrame:
    """One row per revisit: record, url, time, source (record of the response), outcome, headers.

    ``captures``: record bigint, url string (canonical), time bigint, status int (304 is a
    revisit, 200 to 299 a full response, others are passed over), etag, modified, digest
    string, headers map<string,string>. ``blocks``: ranges to deal rows to, else as many as Spark
    makes of their bytes; ``scratch``: where they are written.
    """
    named = captures.select("record", "url", F.coalesce("time", F.lit(-2**63)).alias("at"), "time", "status",
                            F.struct(F.coalesce("time", F.lit(-2**63)).alias("time"), "record", "etag", "modified", "digest",
                                     F.coalesce(_lowered(F.col("headers")), F.array().cast(
                                         "array<struct<key:string,value:string>>")).alias("headers"))
                            .cast(RESPONSE).alias("own"))
    known = named.where("status = 304 OR status BETWEEN 200 AND 299")
    revisit = F.col("status") == 304
    spark = captures.sparkSession
    # No response is in an earlier block than a revisit of its time.
    order = ["url", "at", F.when(revisit, 0).otherwise(1), "record"]
    ranged = known.repartitionByRange(blocks, *order) if blocks else known.repartitionByRange(*order)
    folder = scratch or scratch_folder(spark, "revisits")
    (ranged.withColumns({"block": F.spark_partition_id(), "response": F.when(~revisit, F.col("own"))})
     .write.mode("overwrite").parquet(folder))
    rows = spark.read.parquet(folder)
    last = rows.groupBy("url", "block").agg(F.max("response").alias("response"))
    before = Window.partitionBy("url").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("url", "block", F.last("response", True).over(before).alias("response"))
    # Order: what earlier blocks left, then by time; a revisit before responses of its time.
    line = (rows.select("url", "block", F.lit(1).alias("turn"), "at", F.when(revisit, 0).otherwise(1).alias("kind"),
                        "record", "time", "own", "response")
            .unionByName(carried.where("response IS NOT NULL").select(
                "url", "block", F.lit(0).alias("turn"), "response", F.lit(1).alias("kind")), True))
    upto = Window.partitionBy("url", "block").orderBy("turn", "at", "kind", "response")
    found = (line.withColumn("source", F.last("response", True).over(
        upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .where("turn = 1 AND kind = 0")
        .withColumn("source", F.when(F.col("url").isNotNull(), F.col("source"))))
    tag = lambda c: F.regexp_replace(c, "^W/", "")
    both = lambda n: F.col(f"own.{n}").isNotNull() & F.col(f"source.{n}").isNotNull()
    same = (F.when(both("etag"), tag(F.col("own.etag")) == tag(F.col("source.etag")))
            .when(both("modified"), F.col("own.modified") == F.col("source.modified"))
            .when(both("digest"), F.col("own.digest") == F.col("source.digest")))
    outcome = (F.when(F.col("source").isNull(), "orphan").when(same, "resolved")
               .when(same.isNull(), "unverified").otherwise("mismatch"))
    renewed = F.filter("own.headers", lambda e: e["key"].isin(*RENEWED))
    kept = F.filter("source.headers", lambda e: ~F.exists(renewed, lambda r: r["key"] == e["key"]))
    merged = F.map_from_entries(F.array_sort(F.concat(kept, renewed)))
    return found.select("record", "url", "time", F.col("source.record").alias("source"), outcome.alias("outcome"),
                        F.when(outcome.isin("resolved", "unverified"), merged).alias("headers"))


CRAWLS = 4


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Captures as the test pages allow them: each page is fetched in four crawls, every third
    capture is a full response, the others are revisits. A page changes its entity tag now and then
    between crawls (every seventh page tells a modification time instead, every eleventh nothing).
    Records are numbered by page and crawl."""
    n, crawl = F.col("page_id"), F.col("crawl")
    version = F.floor((n + 13 * crawl) / 40).cast("string")
    size = F.char_length(F.coalesce("html", F.lit(""))).cast("string")
    full = (n + crawl) % 3 == 0
    return pages.withColumn("crawl", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(CRAWLS - 1).cast("bigint")))).select(
        (n * CRAWLS + crawl).alias("record"), canonical(F.col("url")).alias("url"),
        (crawl * 1_000_000_000 + n).alias("time"), F.when(full, 200).otherwise(304).alias("status"),
        F.when((n % 7 != 0) & (n % 11 != 0), F.concat(F.lit('"'), version, F.lit('"'))).alias("etag"),
        F.when(n % 11 != 0, F.concat(F.lit("day "), version)).alias("modified"),
        F.when(full, F.md5(F.coalesce("html", F.lit("")))).alias("digest"),
        F.create_map(F.lit("Date"), (crawl * 1_000_000_000 + n).cast("string"), F.lit("Content-Length"), size,
                     F.lit("ETag"), F.coalesce(version, F.lit(""))).alias("headers"))
