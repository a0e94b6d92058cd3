"""Ranked search in K2-treaps against a plain version."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from mercata.llm import queries, treap
from mercata.session import scratch_folder

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, top=50):
    """(item_id, rank, doc_id, score); docs and items are lists of (id, text)."""
    docs = [(d, Counter(words(t))) for d, t in docs]
    docs = [(d, c) for d, c in docs if c]
    n, l = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for i, ts in asked.items():
        w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in ts if t in df}
        scores = []
        for d, c in docs:
            m = 50 + 50 * sum(c.values()) * n // l
            score = sum(w[t] * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in w if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(i, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=lambda r: ((r[0] is not None, r[0] or 0), r[1]))


def result(spark, docs, items, **how):
    out = treap.ranked(spark, docs, items, scratch_folder(spark, "t"), **how)
    assert out.columns == ["item_id", "rank", "doc_id", "score"] and dict(out.dtypes)["rank"] == "int"
    return sorted((tuple(r) for r in out.collect()), key=lambda r: ((r[0] is not None, r[0] or 0), r[1]))


def rows(df, key):
    return [tuple(r) for r in df.select(key, "text").collect()]


def test_whole_table(spark):
    docs, items = queries.table(spark, SF, "documents").repartition(3), queries.table(spark, SF, "benchmark")
    want = plain(rows(docs, "doc_id"), rows(items, "item_id"))
    assert result(spark, docs, items) == want
    # Many small shards and blocks, few of which a task keeps.
    assert result(spark, docs, items, shard_docs=17, block_terms=40) == want
    assert result(spark, docs, items, shard_bytes=3000) == want


def test_salted_blocks(spark, monkeypatch):
    docs, items = queries.table(spark, SF, "documents").repartition(3), queries.table(spark, SF, "benchmark")
    want = plain(rows(docs, "doc_id"), rows(items, "item_id"), 7)
    monkeypatch.setattr(treap, "MOST_BROADCAST", 0)
    assert result(spark, docs, items, top=7, shard_docs=50, block_terms=300) == want


WORDS = [f"w{i}" for i in range(40)]


def odd_docs():
    r = random.Random(5)
    some = [(i, " ".join(r.choices(WORDS, range(1, 41), k=r.randint(0, 60)))) for i in range(150)]
    some += [(200 + i, some[3][1]) for i in range(60)]  # equal scores
    some += [(400, None), (401, ""), (402, " .,;\0"), (403, "W1 w1 É é É中 a b"), (404, "w2 " * 120_000), (404, "w3"), (404, "w3")]
    return some + [(None, "w1 w5"), (None, "w1 w5"), (None, None)]


def test_nulls_ties_repeats_long_texts_and_clashing_names(spark):
    docs = spark.createDataFrame([(d, t, 1, "x", [1]) for d, t in odd_docs()],
                                 "doc_id bigint, text string, block int, terms string, items array<int>").repartition(4)
    asked = [(1, "w1 w5 w9 W1"), (2, None), (3, ""), (4, "nowhere"), (5, "É中 é"), (6, "w1"), (6, "w5, W9"), (7, " ".join(WORDS)),
             (7, " ".join(WORDS)), (None, "w3"), (None, "w2"), (8, "a"), (9, some := odd_docs()[3][1]), (10, some + " nowhere")]
    items = spark.createDataFrame([(i, t, "y") for i, t in asked], "item_id bigint, text string, doc_id string")
    for how in ({}, {"shard_docs": 9}, {"top": 3, "shard_docs": 40, "block_terms": 30}):
        assert result(spark, docs, items, **how) == plain(odd_docs(), asked, how.get("top", 50))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    blank = spark.createDataFrame([(1, None), (2, "..")], "doc_id bigint, text string")
    for d, i in ((docs, items), (some, none), (docs, none), (blank, items)):
        assert result(spark, d, i) == []


@pytest.mark.parametrize("docs", [1, 2, 5, 64, 100])
def test_grid_holds_every_posting_and_the_maxima(docs):
    r = np.random.default_rng(docs)
    cells = np.flatnonzero(r.random(docs * 50) < 0.2)
    cells = cells if len(cells) else np.array([0])
    row, doc = np.divmod(cells, docs)
    _, row = np.unique(row, return_inverse=True)
    impact = r.integers(1, 10**6, len(row))
    grid = treap.Grid(docs, *treap.treap(row, doc, impact, docs))
    assert grid.tops[0].tolist() == [int(impact[row >> grid.both == b].max()) for b in range(int(row.max() >> grid.both) + 1)]
    for k in range(int(row.max()) + 1):
        one = np.array([k])
        front = treap.Frontier(np.array([0]), np.array([0]), grid.tops[0][one >> grid.both], np.array([0]), one >> grid.both,
                               one & ((1 << grid.both) - 1), np.array([1]))
        for level in range(grid.levels):
            front = front.down(grid, level, np.array([1]))
        assert dict(zip(front.span.tolist(), front.bound.tolist())) == dict(zip(doc[row == k].tolist(), impact[row == k].tolist()))


def test_sums_stay_exact_beyond_doubles():
    values = np.full(9, (1 << 53) - 1, np.int64)
    assert treap._sums(np.zeros(9, np.int64), values, 1)[0] == 9 * ((1 << 53) - 1)


def test_terms_are_split_by_ascii_only():
    found, codes, at = treap.terms(pa.array(["A.b_É-中1", None, "", "a"]))
    assert [found[int(c)].as_py() for c in codes] == ["a", "b", "É", "中1", "a"] and at.tolist() == [0, 4, 4, 4, 5]
