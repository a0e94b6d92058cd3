"""Near copies by HyperMinHash against a plain version, its sketches against exact values."""

import random
import re

import numpy as np
import pytest

from mercata.llm import hyperminhash as hm
from mercata.llm import queries
from mercata.session import scratch_folder

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})


def shingles(text, n=3):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def plain(docs):
    """Sorted (doc_id, n_shingles, component_id, kept) of (doc_id, text)."""
    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 85 * (len(a) + len(sets[j]) - both) and label[i] != label[j]:
                old = label[i]
                label = [label[j] if x == old else x for x in label]
    ids = {}
    for (d, _), x in zip(docs, label, strict=True):
        if d is not None:
            ids[x] = min(ids.get(x, d), d)
    return order((d, len(s), ids.get(x), d == ids.get(x)) for (d, _), s, x in zip(docs, sets, label, strict=True))


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def result(spark, df, **how):
    return order(tuple(r) for r in hm.linked(spark, df, scratch_folder(spark, "t"), **how).collect())


def vary(text, share, r):
    return " ".join(w if r.random() > share else w + "x" for w in text.split())


def family(seed, size, share, words=120, start=0):
    r = random.Random(seed)
    base = " ".join(f"{r.randint(0, 5000)}" for _ in range(words))
    return [(start + i, vary(base, share * r.random(), r)) for i in range(size)]


def odd():
    r = random.Random(9)
    some = family(1, 30, 0.05) + family(2, 30, 0.1, 60, 100) + family(3, 20, 0.3, 9, 200) + family(4, 20, 0.2, 4, 300)
    some += [(400 + i, some[3][1]) for i in range(25)] + [(500, None), (501, ""), (502, " \t\n"), (503, "One two"), (504, "ONE\ttwo"),
                                                         (505, "one two three"), (506, "solo"), (506, "solo"), (506, "other text here")]
    long = " ".join(str(r.randint(0, 10**6)) for _ in range(60_000))
    some += [(600, long), (601, long + " end"), (602, long[len(long) // 2:]), (603, "again " * 50_000), (604, "again again again")]
    return some + [(None, some[0][1] + " nobody"), (None, "no id at all"), (None, "no id at all"), (None, "no id at all twice"), (None, None)]


@pytest.mark.parametrize("block_rows", [256, 4])
def test_odd_rows(spark, block_rows):
    docs = odd()
    df = spark.createDataFrame([(d, t, 7, "w", [1]) for d, t in docs],
                               "doc_id bigint, text string, row int, label string, registers array<int>").repartition(5)
    assert result(spark, df, block_rows=block_rows) == plain(docs)


def test_large_groups_whose_rows_are_not_linked_to_the_least(spark):
    r = random.Random(3)
    text = " ".join(str(r.randint(0, 9999)) for _ in range(150)).split()
    docs = []
    for i in range(60):  # a chain: each is near the next ones only
        text[r.randrange(len(text))] = f"c{i}"
        docs.append((i, " ".join(text)))
    docs += family(5, 60, 0.25, 80, 1000)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    want = plain(docs)
    assert result(spark, df, block_rows=8) == want
    assert len({x[2] for x in want}) > 3


def test_whole_table_and_query(spark):
    df = queries.table(spark, SF, "documents").repartition(3)
    docs = [tuple(r) for r in df.select("doc_id", "text").collect()]
    want = plain(docs)
    assert result(spark, df, block_rows=3) == want
    assert order(tuple(r) for r in queries.near_copies(spark, SF).collect()) == want


def test_empty_table(spark):
    assert result(spark, spark.createDataFrame([], "doc_id bigint, text string")) == []
    assert result(spark, spark.createDataFrame([(1, None), (2, " ")], "doc_id bigint, text string")) == [(1, 0, 1, True), (2, 0, 2, True)]


def hashes(r, n):
    return np.unique(r.integers(0, 2**64, n, dtype=np.uint64))


def test_registers_hold_zeros_and_mantissa():
    r = np.random.default_rng(1)
    grams = [hashes(r, n) for n in (1, 7, 300, 100_000)] + [np.array([3 << 56, (3 << 56) + 1, (9 << 56) + (0b1011011 << 46)], np.uint64)]
    for g, row in zip(grams, hm.registers(grams), strict=True):
        for k in range(256):
            own = [int(x) & ((1 << 56) - 1) for x in g if int(x) >> 56 == k]
            if not own:
                assert row[k] == 0
                continue
            bits = f"{min(own):056b}"
            zeros = len(bits) - len(bits.lstrip("0"))
            want = (zeros + 1) * 16 + int(bits[zeros + 1:zeros + 5].ljust(4, "0"), 2) if zeros < 14 else 15 * 16
            assert row[k] == want


@pytest.mark.parametrize("n,share", [(400, 0.85), (4000, 0.85), (400, 0.0), (4000, 0.0), (100_000, 0.3)])
def test_estimates_are_corrected_for_collisions(n, share):
    r, found, error = np.random.default_rng(n), [], None
    for _ in range(30):
        both = round(2 * n * share / (1 + share))
        x = hashes(r, 2 * n - both)
        r.shuffle(x)
        a, b = np.sort(x[:n]), np.sort(x[n - both:])
        value, error = hm.estimates(hm.registers([a]), np.array([len(a)]), hm.registers([b]), np.array([len(b)]))
        found.append(float(value[0, 0]))
    assert abs(np.mean(found) - share) < 4 * float(error[0, 0]) / 30 ** 0.5 and max(abs(f - share) for f in found) < 5 * float(error[0, 0])


@pytest.mark.parametrize("level", [0, 1, 2, 3])
def test_small_sets_have_more_hash_functions(level):
    r = np.random.default_rng(level)
    grams = [hashes(r, n) for n in r.integers(1, 800, 300)]
    got = hm.registers(grams, level)
    assert (got[:, :4 ** level] > 0).any() and got.shape == (300, 256)
    for g, row in list(zip(grams, got, strict=True))[::37]:
        for k in (0, 1, 256 // 4 ** level - 1):
            own = hm.mixed(g ^ hm.SEEDS[k]) if k else g
            for b in range(4 ** level):
                mine = [int(x) for x in own if level == 0 or int(x) >> (64 - 2 * level) == b]
                bits = f"{min(mine):064b}"[2 * level:] if mine else ""
                zeros = len(bits) - len(bits.lstrip("0"))
                want = (zeros + 1) * 16 + int(bits[zeros + 1:zeros + 5], 2) if bits and zeros < 14 else 240 if bits else 0
                assert row[k * 4 ** level + b] == want
    # At the threshold a register is equal with its probability, so a band is missed by chance only.
    x = hashes(r, 40 * 4 ** level)
    r.shuffle(x)
    out = round(len(x) * 0.075)
    a, b = hm.registers([np.sort(x[out:]), np.sort(x[:-out])], level)
    assert (a == b).mean() > 0.7


def test_linked_sets_share_a_level():
    for small in range(1, 3000):
        a = {k for k, _ in hm.sketches([np.arange(small, dtype=np.uint64)], 85)[0]}
        big = small * 100 // 85
        assert a & {k for k, _ in hm.sketches([np.arange(big, dtype=np.uint64)], 85)[0]}


def test_block_and_pairwise_estimates_agree():
    r = np.random.default_rng(2)
    grams = [hashes(r, n) for n in r.integers(1, 500, 60)]
    sizes, sketch = np.array([len(g) for g in grams]), hm.registers(grams)
    big = hm.estimates(sketch, sizes, sketch, sizes)
    for i in range(0, 60, 7):
        one = hm.estimates(sketch[i:i + 1], sizes[i:i + 1], sketch, sizes)
        assert np.allclose(one[0], big[0][i]) and np.allclose(one[1], big[1][i])
