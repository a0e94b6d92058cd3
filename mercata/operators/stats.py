"""Descriptive statistics of one numeric column, exact at any size."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from mercata.session import scratch_folder
from mercata.sources.writers import stored

QUARTILES = (0.25, 0.5, 0.75)
HISTOGRAM_BINS = 50  # fixed value
CELLS = 4096  # cells an open cell is cut into in a round
_OCTAVES = 2  # cells of the first round for each power of two


class _Rank(NamedTuple):
    """The row of this rank (from 1) is the ``rank``-th of the open cell [low, high]."""
    rank: int
    low: float
    high: float


def _octave(v: Column) -> Column:
    """A whole number that grows with ``v``: half powers of two on both sides of 0, infinities and
    NaN (above all numbers) by themselves. At most some 8,700 values."""
    size = F.greatest(F.least(F.floor(F.log2(F.abs(v)) * _OCTAVES), F.lit(1024 * _OCTAVES + 1)), F.lit(-1100 * _OCTAVES))
    return (F.when(F.isnan(v), 1 << 20).when(v == 0, 0).when(v > 0, size + 1200 * _OCTAVES)
            .otherwise(-(size + 1200 * _OCTAVES)).cast("bigint"))


def _at(cells: Sequence[Row], rank: int) -> _Rank:
    """Which of the sorted cells holds a rank."""
    for c in cells:
        if rank <= c["rows"]:
            return _Rank(rank, c["first"], c["last"])
        rank -= c["rows"]
    raise ValueError("rank beyond the rows")


def _selected(v: DataFrame, ranks: Sequence[int]) -> dict[int, float]:
    """The values at some ranks of the column ``v``. Each round counts the rows by cell, and goes on
    in the cells that hold a wanted rank, until a cell has one value."""
    def counted(rows: DataFrame, *by: Column) -> list[Row]:
        return (rows.groupBy(*by).agg(F.count("*").alias("rows"), F.min("v").alias("first"), F.max("v").alias("last"))
                .orderBy(*by).collect())  # cells only, never rows

    cells = counted(v, _octave(F.col("v")).alias("cell"))
    found = {r: _at(cells, r) for r in ranks}
    while True:
        bounds = sorted({(f.low, f.high) for f in found.values() if f.low < f.high})
        if not bounds:
            return {r: f.low for r, f in found.items()}
        which, part = F.lit(None).cast("int"), F.lit(None).cast("double")
        for i, (low, high) in enumerate(bounds):
            # Cells are apart or equal, so a row is in one at most.
            which = F.when(F.col("v").between(low, high), i).otherwise(which)
            part = F.when(F.col("v").between(low, high), (F.col("v") - low) / (high - low)).otherwise(part)
        cut = F.least(F.floor(part * CELLS), F.lit(CELLS - 1))
        cells = counted(v.where(which.isNotNull()), which.alias("which"), cut.alias("cell"))
        inside = {b: [c for c in cells if c["which"] == i] for i, b in enumerate(bounds)}
        found = {r: _at(inside[f.low, f.high], f.rank) if f.low < f.high else f for r, f in found.items()}


def _positions(n: int, probs: Sequence[float]) -> list[tuple[int, int, float]]:
    """For each quantile of n rows the ranks below and above it, and the weight of the second."""
    at = [(n - 1) * float(p) for p in probs]
    return [(math.floor(x) + 1, math.ceil(x) + 1, x - math.floor(x)) for x in at]


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float] = QUARTILES,
                    scratch: str | None = None) -> DataFrame:
    """Interpolated quantiles: one row per ``p`` with ``value``; none without a value.

    Ranks are refined instead of sorted: rows are counted by half octave, then the cells that hold a
    wanted rank are cut into CELLS equal parts, and so on (six rounds reach the last bit of a
    double). Every round sends at most a fixed number of cells from a task, however many rows or
    ties there are, and the result is that of a full sort. The column is written once to
    ``scratch`` and read in each round; this runs when called.
    """
    values = stored(df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v")),
                    scratch or scratch_folder(df.sparkSession, "quantiles"))
    probs = sorted(probs)
    return _quantiles(values, values.count(), probs)


def _quantiles(values: DataFrame, n: int, probs: Sequence[float]) -> DataFrame:
    spark = values.sparkSession
    if not n:
        return spark.range(0).select(F.lit(0.0).alias("p"), F.lit(0.0).alias("value"))
    places = _positions(n, probs)
    got = _selected(values, sorted({r for low, high, _ in places for r in (low, high)}))
    rows = [F.struct(F.lit(float(p)).alias("p"), F.lit(float(got[low] + ((got[high] - got[low]) * w if w else 0.0))).alias("value"))
            for p, (low, high, w) in zip(probs, places, strict=True)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def describe_values(df: DataFrame, column: str, scratch: str | None = None) -> DataFrame:
    """count, mean, std (sample), min, quartiles and max in one row. ``df`` is computed once."""
    values = stored(df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL"),
                    scratch or scratch_folder(df.sparkSession, "describe"))
    found = values.agg(F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
                       F.min("v").alias("min"), F.max("v").alias("max"))
    quartiles = {r["p"]: r["value"] for r in _quantiles(values, values.count(), QUARTILES).collect()}  # three rows
    return found.select("count", "mean", "std", "min",
                        *[F.lit(quartiles.get(p)).cast("double").alias(f"p{int(p * 100)}") for p in QUARTILES], "max")


def adjusted_skewness(df: DataFrame, column: str) -> DataFrame:
    """Bias-adjusted skewness (NULL below three values), and whether it calls for a
    log scale (above 1.5)."""
    v = F.col(column).cast("double")
    n = F.count(v).cast("double")
    skew = F.when(n >= 3, F.skewness(v) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))
    return df.agg(skew.alias("skewness")).select(
        "skewness", F.coalesce(F.col("skewness") > 1.5, F.lit(False)).alias("log_scale"))


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins included."""
    v = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    one_value = F.min("v") == F.max("v")
    ends = v.agg(F.struct(
        F.when(one_value, F.min("v") - 0.5).otherwise(F.min("v")).alias("lo"),
        F.when(one_value, F.max("v") + 0.5).otherwise(F.max("v")).alias("hi"))
        .alias("s")).scalar()
    lo, hi = F.col("e.lo"), F.col("e.hi")
    bin_of = F.least(F.width_bucket("v", lo, hi, F.lit(bins)), F.lit(bins))
    counts = (v.select("v", ends.alias("e")).groupBy(bin_of.alias("bin"))
              .agg(F.count("*").alias("n")))
    width = (hi - lo) / bins
    grid = df.sparkSession.range(1, bins + 1).select(F.col("id").alias("bin"), ends.alias("e"))
    return (grid.where("e.lo IS NOT NULL").join(counts, "bin", "left")
            .select("bin", (lo + width * (F.col("bin") - 1)).alias("lo"),
                    (lo + width * F.col("bin")).alias("hi"), F.coalesce("n", F.lit(0)).alias("n")))
