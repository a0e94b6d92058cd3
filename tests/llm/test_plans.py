"""Joins whose keys may be hot: both sides come from a shuffle of their own, so that Spark can split them."""

import pytest

from mercata.llm import components, secrets, urlfilter
from mercata.session import scratch_folder


@pytest.fixture
def merged(spark):
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for c, v in old.items():
        spark.conf.set(c, v)


def sides(df):
    """What stands below each side of each sort-merge join: the operators down to its shuffle."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda s: len(s) - len(s.lstrip(" :+-*()0123456789"))
    out = []
    for i, line in enumerate(lines):
        if "SortMergeJoin" in line:
            below = [j for j in range(i + 1, len(lines))]
            end = next((j for j in below if depth(lines[j]) <= depth(line)), len(lines))
            level = min(depth(lines[j]) for j in range(i + 1, end))
            for j in range(i + 1, end):
                if depth(lines[j]) == level:
                    path = []
                    for k in range(j, end):
                        path.append(lines[k].lstrip(" :+-*()0123456789").split(" ")[0].split("(")[0])
                        if path[-1] == "Exchange":
                            break
                    out.append(path)
    return out


def hot_joins(df):
    found = sides(df)
    assert found
    return [p for p in found if any("Aggregate" in x or x == "Window" for x in p)]


def test_findings_go_back_to_many_paths(spark, merged):
    docs = spark.createDataFrame([(i, "password=abcdefg") for i in range(5)] + [(9, None)], "doc_id bigint, text string")
    ledger = scratch_folder(spark, "ledger")
    secrets.scan(spark, docs, ledger, "1")
    assert hot_joins(secrets.findings(spark, docs, ledger, ["doc_id"])) == []


def test_verdicts_go_back_to_many_pages(spark, merged):
    pages = spark.createDataFrame([(i, "http://a.com/") for i in range(5)] + [(9, None)], "page_id bigint, url string")
    out = urlfilter.judge(spark, pages)
    last = sides(out)[:2]  # the outermost join
    assert all("Aggregate" not in x for p in last for x in p)


def test_minima_go_back_to_many_links(spark, merged):
    links = spark.range(50).selectExpr("id % 3 AS u", "id AS v")
    low = links.groupBy("u").agg({"v": "min"}).withColumnRenamed("min(v)", "m")
    out = components.dealt(links, low, "u")
    assert hot_joins(out) == [] and out.columns == ["u", "v", "m"] and out.count() == 50
    least = components.dealt(spark.sql("SELECT -9223372036854775808L AS u"), spark.sql("SELECT -9223372036854775808L AS u, 1 AS m"), "u")
    assert least.count() == 1
