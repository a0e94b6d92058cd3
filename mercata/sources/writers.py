"""Writing results: files, atomic full refresh, append-only log, schema conforming."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mercata.sources import snapshots

log = logging.getLogger(__name__)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; blanks around a text stay. Texts with line breaks are quoted and
    need ``multiline`` to be read back."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_partitioned(df: DataFrame, path: str, by: str, mode: str = "overwrite") -> None:
    """Parquet in a folder per value of ``by``. Rows are rebalanced by that column first, so a
    folder has a few files of even size, and a value with much of the data is split."""
    df.hint("rebalance", F.col(by)).write.mode(mode).partitionBy(by).parquet(path)


def stored(df: DataFrame, path: str) -> DataFrame:
    """The rows as written to ``path``, so that what follows does not compute them again."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROWS = "rows"  # the table of a folder that holds only one


def full_refresh(df: DataFrame, path: str, partition_by: str | None = None, run: str | None = None) -> int:
    """Replace the table at ``path`` in one step and return its new version. Readers of an older
    version keep it, a failed run leaves it as it was, and running twice leaves the same rows."""
    store = snapshots.Store(df.sparkSession, path).begin(run)
    store.replace(ROWS, df, partition_by)
    return store.commit()


def append_log(df: DataFrame, path: str, run: str | None = None) -> int:
    """Add rows to a log table and keep what is there. ``run`` is the commit key: when the same
    run is repeated, its rows replace those it wrote before."""
    store = snapshots.Store(df.sparkSession, path).begin(run)
    store.append(ROWS, df)
    return store.commit()


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table that ``full_refresh`` or ``append_log`` wrote, in its last or a given version."""
    return snapshots.Store(spark, path).read(ROWS, version)


def conform_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``: extras are dropped (and logged), types
    cast, and columns the input lacks become NULL."""
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    if extra:
        log.info("dropping columns the table does not have: %s", ", ".join(extra))
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, row_count for each table."""
    counts = [df.agg(F.count("*").alias("row_count"))
              .select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
