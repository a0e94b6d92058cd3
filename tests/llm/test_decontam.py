"""Decontamination on repeated characters, shared headers, and edits at any place, against a plain version."""

import random
import time
import tracemalloc

import numpy as np
import pytest

import brute
from mercata.llm import decontam


def text(seed, n, letters="abcdefgh "):
    r = random.Random(seed)
    return "".join(r.choice(letters) for _ in range(n))


def found(docs, items):
    index = decontam.Index.of(list(range(len(items))), items, decontam.Q, decontam.WINDOW, 1)
    return index.regions(*decontam.characters(docs))


def pairs(docs, items):
    """(document, item) with a window of the item within its budget."""
    out = set()
    for i, x in enumerate(items):
        fx = decontam.characters([x])[0]
        m = min(decontam.WINDOW, len(x))
        for d, t in enumerate(docs):
            ft = decontam.characters([t])[0]
            windows = {fx[a:a + m].tobytes(): a for a in range(len(x) - m + 1)} if len(x) >= decontam.Q else {}
            if any(brute.edits_within(fx[a:a + m], ft) <= m // decontam.CHARS_PER_EDIT for a in windows.values()):
                out.add((d, i))
    return out


def edited(t, n, r):
    t = list(t)
    for _ in range(n):
        k, what = r.randrange(len(t)), r.randrange(3)
        t[k:k + 1] = [[], ["#"], [t[k], "#"]][what]
    return "".join(t)


def test_edited_passages_from_any_place():
    r = random.Random(4)
    items = [text(100 + i, r.choice([60, 95, 150, 230])) for i in range(6)]
    docs = []
    for i in range(40):
        x = r.choice(items)
        a = r.randrange(max(1, len(x) - 80))
        docs.append(text(i, 50) + edited(x[a:a + r.choice([70, 78, 82, 100])], r.randrange(8), r) + text(900 + i, 50))
    got, want = {(d, i) for d, i, *_ in found(docs, items)}, pairs(docs, items)
    assert got == want and 5 < len(want) < 40


def test_spans_of_verbatim_passages():
    items = [text(7, 300), text(8, 90)]
    docs = ["x" * 30 + items[0][37:200] + "y" * 30, text(1, 20) + items[1] + text(2, 20) + items[0][:100]]
    spans = {(d, i): (a, b, e) for d, i, a, b, e in found(docs, items)}
    assert set(spans) == {(0, 0), (1, 0), (1, 1)}
    a, b, e = spans[0, 0]
    assert abs(a - 30) <= 4 and abs(b - 193) <= 4 and e <= 4
    a, b, e = spans[1, 1]
    assert abs(a - 20) <= 4 and abs(b - 110) <= 4


def test_texts_that_items_share_are_found_in_all():
    header = text(3, 130)
    items = [header + text(20 + i, 60) for i in range(5)] + [header, text(99, 100)]
    docs = [text(50, 40) + header[10:] + text(51, 40), items[2], text(52, 300)]
    assert {(d, i) for d, i, *_ in found(docs, items)} == pairs(docs, items) >= {(0, i) for i in range(6)}


def test_runs_and_periods():
    items = ["-" * 200, text(1, 100) + "-" * 100 + text(2, 100), "ab" * 100, text(3, 50) + "=" * 40 + text(4, 50), "no " * 30]
    docs = ["-" * 300, "ab" * 41, "b" + "ab" * 39 + "x", "=" * 500, "- " * 200, text(1, 100)[30:] + "-" * 70 + text(9, 50),
            "no no " * 14, "-" * 75 + "x" + "-" * 75, "-" * 79]
    assert {(d, i) for d, i, *_ in found(docs, items)} == pairs(docs, items)


@pytest.mark.parametrize("item", ["-" * 200, "-" * 800, "ab" * 400, text(1, 100) + "-" * 100 + text(2, 100)])
def test_long_runs_take_seconds_and_little_memory(item):
    doc = text(5, 200) + ("-" if "-" in item else "ab") * (100_000 // (1 if "-" in item else 2)) + text(6, 200)
    tracemalloc.start()
    began = time.process_time()
    out = found([doc, doc[:3000]], [item])
    took, peak = time.process_time() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [d for d, *_ in out] == [0, 1] and abs(out[0][2] - 200) <= 8 and abs(out[0][3] - 100_200) <= 8
    assert took < 60 and peak < 250e6, (took, peak)


def test_many_items_with_a_common_header():
    header = text(1, 76, "abcdefghijklmnopqrstuvwxyz ")
    items = [header + text(100 + i, 150, "abcdefghijklmnopqrstuvwxyz ") for i in range(1000)]
    docs = [text(2000 + i, 300) + header + text(3000 + i, 300) for i in range(5)] + [items[17]]
    tracemalloc.start()
    began = time.process_time()
    out = found(docs, items)
    took, peak = time.process_time() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 76 characters and four that differ are within the budget of each item.
    assert {(d, i) for d, i, *_ in out} == {(d, i) for d in range(6) for i in range(1000)}
    assert [(a, b, e) for d, i, a, b, e in out if (d, i) == (5, 17)] == [(0, 226, 4)] or \
        [(a, b) for d, i, a, b, e in out if (d, i) == (5, 17)] == [(0, 226)]
    assert took < 90 and peak < 250e6, (took, peak)


def test_joined_spans():
    spans = np.array([[0, 0, 0, 0, 1, 0], [0, 0, 0, 1, 0, 0], [5, 0, 20, 0, 0, 8], [9, 5, 30, 9, 4, 12], [1, 2, 0, 3, 1, 4]])
    assert decontam._joined(spans).T.tolist() == [[0, 0, 0, 12, 4], [0, 0, 20, 30, 0], [0, 1, 0, 9, 3], [1, 0, 0, 4, 1]]
