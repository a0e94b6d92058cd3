import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mercata.operators import stats

CASES = {
    "skewed": np.round(np.random.default_rng(1).lognormal(5, 2, 3000), 2),
    "ties": np.random.default_rng(2).integers(0, 4, 999).astype(float),
    "third equal": np.r_[np.full(1000, 7.0), np.random.default_rng(3).normal(0, 50, 2000)],
    "one": np.array([3.0]), "two": np.array([1.0, 2.0]), "same": np.full(9, 4.0),
}


def column(spark, values):
    return spark.createDataFrame(pd.DataFrame({"x": values})).union(
        spark.sql("SELECT CAST(NULL AS DOUBLE)"))


PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("name", CASES)
def test_quantiles_are_those_of_a_full_sort(spark, name):
    out = stats.exact_quantiles(column(spark, CASES[name]), "x", PROBS)
    want = np.quantile(CASES[name], PROBS)
    assert [r.value for r in out.orderBy("p").collect()] == pytest.approx(list(want), rel=1e-12)


HARD = {
    "both signs, far apart": [-1e300, -5.0, -1e-300, -0.0, 0.0, 5e-324, 1e-310, 1.0, 1.0000000000000002, 1e308],
    "neighbours": [float(np.nextafter(1e9, 2e9)) if i % 2 else 1e9 for i in range(101)],
    "infinite": [float("-inf")] * 3 + [1.0, 2.0] + [float("inf")] * 4,
    "powers": [2.0 ** i for i in range(-1074, 1024, 7)],
}


@pytest.mark.parametrize("name", HARD)
def test_ranks_of_hard_values(spark, name):
    values = HARD[name]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    got = stats._selected(df, range(1, len(values) + 1))
    assert [got[r] for r in range(1, len(values) + 1)] == sorted(values)


def test_nan_is_above_all_numbers(spark):
    df = spark.createDataFrame([(v,) for v in (float("nan"), 1.0, float("inf"), 2.0)], "v double")
    got = stats._selected(df, [1, 2, 3])
    assert [got[r] for r in (1, 2, 3)] == [1.0, 2.0, float("inf")]


def test_a_round_holds_a_fixed_number_of_cells(spark, monkeypatch):
    """Many distinct values: what reaches the driver in a round does not grow with them."""
    sizes, at = [], stats._at
    monkeypatch.setattr(stats, "_at", lambda cells, rank: sizes.append(len(cells)) or at(cells, rank))
    df = spark.range(300_000).select((F.xxhash64("id") / 1e6).alias("x"))
    out = {r.p: r.value for r in stats.exact_quantiles(df, "x", [0.5]).collect()}
    want = df.orderBy("x").collect()
    assert out[0.5] == pytest.approx((want[149_999].x + want[150_000].x) / 2, rel=1e-12)
    assert max(sizes) <= stats.CELLS + 8700 and len(sizes) <= 2 * 6


def test_no_values(spark):
    assert stats.exact_quantiles(column(spark, np.array([1.0])).where("x IS NULL"), "x").collect() == []
    row = stats.describe_values(column(spark, np.array([1.0])).where("x IS NULL"), "x").first()
    assert row["count"] == 0 and row["p50"] is None


def test_describe(spark):
    x = CASES["skewed"]
    want = pd.Series(x).describe()
    row = stats.describe_values(column(spark, x), "x").first()
    assert list(row) == pytest.approx(list(want), rel=1e-9)


def test_skewness(spark):
    for name in ("skewed", "ties"):
        row = stats.adjusted_skewness(column(spark, CASES[name]), "x").first()
        assert row.skewness == pytest.approx(pd.Series(CASES[name]).skew(), rel=1e-9)
        assert row.log_scale is bool(row.skewness > 1.5)
    assert tuple(stats.adjusted_skewness(column(spark, CASES["two"]), "x").first()) == (None, False)


@pytest.mark.parametrize("name", ["skewed", "ties", "same", "one"])
def test_histogram(spark, name):
    n, edges = np.histogram(CASES[name], bins=50)
    rows = stats.histogram(column(spark, CASES[name]), "x").orderBy("bin").collect()
    assert [r.n for r in rows] == list(n)
    assert [r.lo for r in rows] + [rows[-1].hi] == pytest.approx(list(edges))


def test_no_values(spark):
    empty = column(spark, CASES["one"]).where(F.lit(False))
    assert stats.histogram(empty, "x").count() == 0
    assert stats.describe_values(empty, "x").first()["count"] == 0
