"""Fill-in-middle against a plain version, exact round trips, odd texts."""

import hashlib

import pytest
from pyspark.sql import functions as F

from mercata.llm import infill, queries

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text):
    text = text or ""
    n, x = len(text), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if h[3] % 100 < 20:
        return n, "spm", i, j - i, "<S>" + text[j:] + "<P>" + text[:i] + "<M>" + text[i:j]
    return n, "psm", i, j - i, "<P>" + text[:i] + "<S>" + text[j:] + "<M>" + text[i:j]


ODD = [(i, t) for i, t in enumerate([
    None, "", "a", "ab", "é 中文 🤦🏼‍♂️\r\n\0x", "<P> inside", "x<M>", "<S", "<<<>>>", "P>", "-" * 50_000,
    "é中🤦\n" * 30_000, "same", "same"] * 6)] + [(None, "no id"), (None, None), (5, "twice"), (5, "twice")]


def test_rows_equal_the_plain_version_and_are_restored(spark):
    docs = spark.createDataFrame([(d, t, "w", "x", 1) for d, t in ODD],
                                 "doc_id bigint, text string, output string, form string, h1 int").repartition(3)
    out = infill.transformed(docs)
    rows = out.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}
    got = sorted(((r["doc_id"], r["back"]), tuple(r[1:6])) for r in rows if r["doc_id"] is not None)
    assert got == sorted(((d, t or ""), plain(d, t)) for d, t in ODD if d is not None)
    assert sorted(tuple(r[1:6]) for r in rows if r["doc_id"] is None) == sorted(plain(d, t) for d, t in ODD if d is None)


def test_very_long_texts_are_matched_in_rows_of_units():
    text = "aé漢🤦\n" * 400_000
    assert list(infill.Units(most=300_000).ends(text)) == list(range(1, len(text) + 1))
    h = (10**9, 1_999_999, 5, 50)
    a = infill.rearranged(text, h, infill.Units(most=300_000), infill.MARKS, 90, 20)
    assert a == infill.rearranged(text, h, infill.Units(most=10**9), infill.MARKS, 90, 20)


def test_other_units(spark):
    docs = spark.createDataFrame([(d, t) for d, t in enumerate(["one two  three", " begins blank", "éé", "x"])],
                                 "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in infill.transformed(docs, unit=r"\S+\s*+", plain_from=100).collect()}
    assert [rows[d]["n"] for d in range(4)] == [3, 0, 1, 1] and rows[1]["form"] == "plain"
    assert all(r["prefix_chars"] in (0, 4, 9, 14) for r in rows.values() if r["doc_id"] == 0)
    graphemes = infill.transformed(docs, unit=r"\X", plain_from=100).where("doc_id = 2").first()
    assert graphemes["n"] == 2 and graphemes["prefix_chars"] % 2 == 0


def test_marks_that_overlap_are_refused():
    for marks in (("<P>", ">S", "<M>"), ("aba", "x", "y"), ("", "a", "b"), ("aa", "aa", "b")):
        with pytest.raises(ValueError):
            infill.check_marks(marks)
    infill.check_marks(infill.MARKS)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert infill.transformed(docs).collect() == []


def test_query_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in queries.fill_in_middle(spark, SF).collect()}
    assert len(got) == len(docs)
    for d, t in docs:
        n, form, i, j, output = plain(d, t)
        assert got[d] == (d, n, form, i, j, sha(output), sha(t or ""))
