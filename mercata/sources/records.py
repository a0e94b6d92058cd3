"""CSV records with quoted line breaks, read by many tasks.

A reader that starts in the middle of a file does not know whether it stands inside a quoted
field. But a line break ends a record exactly if the quotes before it are even in number (a quote
within a field is written twice). So:

1. Every split hands on its lines with their place in it, and how many lines with an odd number of
   quotes stand before each. They are written once: splits are not dealt alike a second time.
2. Sums over a file's splits, one row each, tell how many such lines precede a split.
3. A line with an even count before it and of its own is a record. The others belong to the record
   that the last odd line with an even count before it opened, and only these lines are shuffled,
   by file and number of that record; a record may run through several splits.

Quotes have to be written as ``write_csv`` does: around the whole field, doubled inside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercata.sources.writers import stored

LINES = "file bigint, block bigint, place bigint, before bigint, odd boolean, line string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, their split (its first byte), their place there, and the odd lines before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, place, before = None, 0, 0  # of the split that the last batch ended in
        for batch in batches:
            if not batch.num_rows:
                continue
            odd = pc.count_substring(batch["line"], '"').to_numpy(zero_copy_only=False) % 2
            file, block = (batch[c].to_numpy(zero_copy_only=False) for c in ("file", "block"))
            starts = np.flatnonzero(np.r_[True, (file[1:] != file[:-1]) | (block[1:] != block[:-1])])
            run_of = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(odd)]))
            upto = np.cumsum(odd) - odd
            places, counts = np.arange(len(odd)) - starts[run_of], upto - upto[starts][run_of]
            if (file[0], block[0]) == last:
                places[run_of == 0] += place
                counts[run_of == 0] += before
            last, place, before = (file[-1], block[-1]), int(places[-1]) + 1, int(counts[-1] + odd[-1])
            yield pa.RecordBatch.from_arrays([
                batch["file"], batch["block"], pa.array(places), pa.array(counts), pa.array(odd.astype(bool)), batch["line"]],
                ["file", "block", "place", "before", "odd", "line"])

    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.col("value").alias("line"))
            .mapInArrow(run, LINES))


def csv_records(spark: SparkSession, path: str, scratch: str) -> DataFrame:
    """file, record, header: the text of each record, and whether it is the first one of its file."""
    lines = stored(_lines(spark, path), f"{scratch}/lines")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = stored(lines.groupBy("file", "block").agg(F.count_if("odd").alias("n"))
                    .select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("preceding")),
                    f"{scratch}/splits")
    first = (F.col("block") == 0) & (F.col("place") == 0)
    placed = lines.join(splits, ["file", "block"]).withColumn("before", F.col("before") + F.col("preceding"))
    inside = (F.col("before") % 2 == 1) | F.col("odd")
    part = F.struct("block", "place", "line")
    joined = (placed.where(inside).groupBy("file", F.floor(F.col("before") / 2).alias("number"))
              .agg(F.array_sort(F.collect_list(part)).alias("parts"), F.max(first).alias("header"))
              .select("file", F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("record"), "header"))
    whole = placed.where(~inside).select("file", F.col("line").alias("record"), first.alias("header"))
    text = F.regexp_replace("record", "\r$", "")
    return (whole.unionByName(joined).withColumn("record", F.when(F.col("header"), F.regexp_replace(text, "^﻿", "")).otherwise(text))
            .where("header OR record <> ''"))
