"""The corpus pipeline, stage by stage, against plain versions; each stage is judged on its input."""

import re

import numpy as np
import pytest

import brute
import corpus_pipeline
from mercata.llm import decontam, quality, secrets
from test_operators import BASE, ODD, SF, ids_of, prose

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]
LEAKED = prose(60, 40)


def rows_of(df):
    return sorted(map(tuple, df.select(*NAMES).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "", str(r)))


def keeps(text):
    """The quality rules, word by word."""
    n, chars, symbols, dup_lines, _, failed = brute.quality(text)
    if failed:
        return False
    words = brute.WORD.findall(text)
    lines = [x for x in text.split("\n") if brute.WORD.search(x)]
    marks = sum(bool(re.fullmatch(r"[#*$%&|<>]+|[^#*$%&|<>]+[#*$%&|<>]{3,}", w)) for w in words)
    loud = sum(w.endswith("!!") for w in words)
    stop = sum(w in quality.STOP_WORDS for w in words)
    return (1.5 <= chars / n <= 25 and (n < 20 or symbols / n <= 0.5 and marks / n <= 0.4 and loud / n <= 0.3
                                        and dup_lines / len(lines) <= 0.75) and (n < 100 or stop / n >= 0.01))


def leaks(text, items):
    t = decontam.characters([text or ""])[0]
    for x in items:
        m = min(80, len(x))
        starts = sorted({*range(0, len(x) - m + 1, 20), len(x) - m}) if m >= 12 else []
        if any(brute.edits_within(x[s:s + m], t) <= min(m // 20, (m - 12) // 12) for s in starts):
            return True
    return False


def masked(text):
    """Rule by rule; a match that is too short stays and the search goes on behind its first character."""
    for rule in secrets.RULES:
        at, out = 0, ""
        while text is not None and (m := re.compile(rule.pattern, re.ASCII).search(text, at)):
            whole = len(m[rule.group]) >= rule.least
            out += text[at:m.start()] + (f"[{rule.kind.upper()}]" if whole else text[m.start()])
            at = m.end() if whole else m.start() + 1
        text = out + text[at:] if text is not None else None
    return text


def stages(spark, sf):
    """(name, rows before, rows after) of each filtering stage, then the last stage's frame."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, sf)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns
            after.write.mode("overwrite").parquet(f"{sf}/../stages/{name}")
            after = spark.read.parquet(f"{sf}/../stages/{name}")
            out.append((name, rows_of(docs), rows_of(after)))
        docs = after
    return out, docs


@pytest.fixture(params=["odd", "docs", "empty"])
def folder(request, spark, tmp_path):
    """documents and benchmark: test tables, hand-made rows with extra columns, or no rows."""
    sf = str(tmp_path / "sf")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    if request.param == "docs":
        docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    else:
        rows = [(d, t, "en", s, 0, 1, "k") for d, t, s in ODD]
        rows += [(30, f"{prose(31, 20)} {LEAKED} {prose(32, 20)}", None, None, None, 1, "k"),
                 (31, f"{prose(33, 30)} {LEAKED[:60]}q{LEAKED[60:]}", "en", "x", 0, 1, "k"),
                 (32, f"{prose(34, 30)} password: hunter22 and secret=token: abcdefgh", "en", "x", 0, 1, "k"),
                 (33, prose(35, 30), "en", "x", 0, 1, "k"), (33, prose(35, 30), "en", "x", 0, 1, "k"),
                 (None, prose(36, 30), "en", "x", 0, 1, "k"), (None, prose(37, 30), "en", "x", 0, 1, "k"),
                 (34, prose(38, 60) + " AKIA" + "B7" * 9, "en", "x", 0, 1, "k")]
        docs = spark.createDataFrame(rows if request.param == "odd" else [], COLUMNS + ", kept int, words string")
        bench = spark.createDataFrame([(1, LEAKED), (2, None), (3, "")], "item_id bigint, text string")
    docs.write.parquet(f"{sf}/documents.parquet")
    bench.write.parquet(f"{sf}/benchmark.parquet")
    return request.param, sf


def test_stages(spark, folder):
    kind, sf = folder
    steps, pieces = stages(spark, sf)
    items = [decontam.characters([r["text"] or ""])[0] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for name, before, after in steps:
        if name == "quality":
            assert after == [r for r in before if keeps(r[1])]
        elif name == "jaccard":
            named = {r[0]: r[1] for r in before if r[0] is not None}
            linked = brute.jaccard(named)
            want = [r for r in before if r[0] is None or linked[r[0]][1] == r[0]]
            assert after == sorted(set(want), key=want.index)  # a repeated row stays once
        elif name == "decontamination":
            gone = [r for r in before if r not in after]
            assert set(after) <= set(before) and all(leaks(r[1], items) for r in gone)
            # Exact windows are cheap to look for in all that stays.
            for r in after:
                t = decontam.characters([r[1] or ""])[0].tobytes()
                assert not any(x[s:s + 80].tobytes() in t for x in items if len(x) >= 80 for s in range(0, len(x) - 79, 20))
            if kind == "odd":
                assert {r[0] for r in gone} >= {30, 31} and 33 in {r[0] for r in after}
        else:
            assert [(r[0], r[1], r[4]) for r in after] == [
                (r[0], masked(r[1]), len(masked(r[1])) if r[1] is not None else None) for r in before]
            assert all(brute.secrets(r[1])[:3] == (0, 0, 0) for r in after)
    found = {}
    for p in pieces.collect():
        found.setdefault(p["doc_id"], []).append((p["start"], np.frombuffer(p["ids"], "<u4").tolist(), p["doc_tokens"]))
    last = steps[-1][2]
    assert found.keys() == {r[0] for r in last}
    for doc, text, *_ in last:
        if doc is not None:
            ids = ids_of(text)
            assert sum((x for _, x, _ in sorted(found[doc])), []) == ids and {n for _, _, n in found[doc]} == {len(ids)}
    if kind == "odd":
        assert BASE in {r[1] for r in last} and len([r for r in last if r[0] is None]) == 2
    whole = corpus_pipeline.run(spark, sf)
    assert {(r[0], r[1]) for r in whole.select("doc_id", "doc_tokens").collect()} == {
        (r[0], len(ids_of(r[1]))) for r in last}


def test_rows_that_share_an_id_do_not_share_a_fate(spark, tmp_path):
    copy = prose(71, 60)
    near = copy + " end"
    rows = [(None, prose(72, 30)), (None, f"{prose(73, 20)} {LEAKED}"), (None, copy), (None, near), (1, prose(74, 30)),
            (1, f"{LEAKED} {prose(75, 20)}"), (1, copy), (2, near), (2, prose(76, 30)), (2, prose(76, 30)), (3, prose(77, 30))]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id bigint, text string, other int").repartition(3)
    spark.createDataFrame([(1, LEAKED)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = lambda df: sorted(((r[0], r[1]) for r in df.collect()), key=str)
    once = corpus_pipeline.jaccard_stage(spark, docs, str(tmp_path))
    assert once.columns == docs.columns
    assert texts(once) == sorted({r for r in rows if r not in ((None, copy), (None, near), (2, near))}, key=str)
    clean = corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    assert texts(clean) == sorted((r for r in rows if LEAKED not in r[1]), key=str)
