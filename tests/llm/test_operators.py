"""The numbered operators against plain versions, on test tables and hand-made rows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

import brute
from mercata.llm import (decontam, fmindex, jaccard, packing, quality, queries, rans, revisits, rollups, secrets,
                         substring, tokens, urlfilter)
from mercata.llm.components import components

SF = "/root/testdata/sf0.001"
PROSE = "the quick brown fox jumps over a lazy dog while seven old wizards brew more ale for big grey jovial kings"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))


BASE = prose(1, 90)
ODD = [
    (0, BASE, "x"), (1, BASE, "x"), (2, None, None), (3, "", "x"), (4, " \t\n\x0b\x0c\r ", "x"),
    (5, prose(2, 30) + " " + " ".join(BASE.split()[10:50]) + " " + prose(3, 30), "y"),
    (6, BASE.replace(" ", "  \n", 7), "x"), (7, "one two three", "x"), (8, "ONE two\tthree", "x"), (9, "one two", "x"),
    (10, "again and again " * 400, "x"), (11, prose(4, 6000), "z"),
    (12, BASE + " end", "x"), (13, " ".join(BASE.split()[:80]), "x"), (14, "é ü ß 中文 " * 9 + "\u00a0\u0301x", "x"),
    (15, "password = \"abc123\" token='x' secret=token: abcdefg api_KEY:abcdef.g AKIA" + "A1" * 8 + " " + "0f" * 12
     + " 0123456789abcdef Token=abcdefgh", "x"),
    (16, "ſecret=abcdefgh toKen=abcdefgh passwd : 'ab=cd==' xAKIAAKIA" + "Z" * 14 + "\n" + "g0a" * 30, "x"),
    (17, "|a| b|c <|endoftext|> it's 12ab||cd ΣΑΣ İi", "x"), (18, "same line\nsame line\n\nsame line\r\n \n", "x"),
    (19, BASE, "x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with NULLs, copies, blanks, long and odd texts, and columns with clashing names."""
    return spark.createDataFrame([(*r, "w", 1, "__h") for r in ODD], "doc_id bigint, text string, source string, "
                                 "words string, n_words int, `__row` string").repartition(5)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").repartition(4)


@pytest.fixture(params=["odd", "docs", "empty"])
def case(request, spark):
    if request.param == "empty":
        return spark.createDataFrame([], "doc_id bigint, text string")
    return request.getfixturevalue(request.param)


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_secrets(spark, case, tmp_path):
    ledger = str(tmp_path)
    secrets.scan(spark, case, ledger, "1")
    found = secrets.findings(spark, case, ledger, ["doc_id"])
    base = [r.kind for r in secrets.BASE]
    got = {r[0]: r[1:] for r in found.select("doc_id", secrets.spans(kinds=base), secrets.spans()).collect()}
    want = {d: brute.secrets(t) for d, t in texts(case).items()}
    assert {d: brute.sha(g[0]) for d, g in got.items()} == {d: w[3] for d, w in want.items()}
    assert {d: tuple(sum(x.startswith(k + ":") for x in g[0].split(",")) for k in base) for d, g in got.items()} \
        == {d: w[:3] for d, w in want.items()}


def test_secret_ledger_scans_only_what_is_new(spark, odd, tmp_path):
    ledger = str(tmp_path)
    rows = lambda b: spark.read.schema(secrets.LEDGER).parquet(ledger).where(f"batch = '{b}'")
    secrets.scan(spark, odd.where("doc_id < 10"), ledger, "1", rules=secrets.BASE)
    secrets.scan(spark, odd, ledger, "2", rules=secrets.BASE)
    first = odd.where("doc_id < 10").select(secrets.blob(odd["text"]).alias("b")).distinct()
    both = odd.select(secrets.blob(odd["text"]).alias("b")).distinct()
    assert rows("1").count() == first.count() and rows("2").count() == both.count() - first.count()
    new = secrets.Rule("hex", "[0-9a-f]+", 0, 16, version=2)
    secrets.scan(spark, odd, ledger, "3", rules=[*secrets.BASE[:2], new])
    assert {tuple(r["rules"]) for r in rows("3").collect()} == {("hex@2",)}
    before = sorted(map(str, rows("3").collect()))
    secrets.scan(spark, odd, ledger, "3", rules=[*secrets.BASE[:2], new])  # a batch done again
    assert sorted(map(str, rows("3").collect())) == before
    found = {r[0]: r[1] for r in secrets.findings(spark, odd, ledger, ["doc_id"], rules=[new]).select(
        "doc_id", secrets.spans()).collect()}
    hexes = [f"hex:{m.start()}:{m.end()}" for m in re.finditer("[0-9a-f]{16,}", ODD[15][1])]
    assert found[15] == ",".join(hexes) and len(hexes) == 2


def test_masked_texts_have_no_finding(spark, odd, tmp_path):
    from pyspark.sql import functions as F
    masked = odd.select("doc_id", secrets.masked(F.col("text")).alias("text"))
    secrets.scan(spark, masked, str(tmp_path), "1")
    found = secrets.findings(spark, masked, str(tmp_path), ["doc_id"])
    assert found.where(F.size("findings") > 0).count() == 0
    assert found.count() == len(ODD)


def test_added_rules(spark, tmp_path):
    df = spark.createDataFrame([(1, "x -----BEGIN RSA PRIVATE KEY----- ghp_" + "z1" * 18 + " xoxb-1234567890-ab")], "doc_id int, text string")
    secrets.scan(spark, df, str(tmp_path), "1")
    row = secrets.findings(spark, df, str(tmp_path), ["doc_id"]).select(secrets.spans()).first()[0]
    assert [s.split(":")[0] for s in row.split(",")] == ["private_key", "forge_token", "chat_token"]


def test_substrings(spark, case, tmp_path):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"])
           for r in substring.deduplicated(spark, case, str(tmp_path), keep_text=False).collect()}
    assert got == brute.substrings(texts(case))


def test_substrings_of_a_hot_anchor(spark, odd, tmp_path):
    """A passage in many documents, with other words around it: its anchors are split."""
    passage = " ".join(prose(7, 40).split())
    rows = [(i, f"{prose(100 + i, 25)} {passage} {prose(300 + i, 25)}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    _, hits = substring.repeated(spark, df, str(tmp_path), limit=8)
    out = {r["doc"]: len({k for h in r["hits"] for w in range(15) if h["mask"] >> w & 1
                             for k in range(h["first"] + w, h["first"] + w + 20)}) for r in hits.collect()}
    assert out == {d: n for d, (_, n, _) in brute.substrings(dict(rows)).items() if n}


def test_fm_index_finds_all_places():
    r = np.random.default_rng(5)
    lines = [r.integers(1, 4, r.integers(1, 40)) for _ in range(30)]
    flat = np.concatenate([np.append(x, 0) for x in lines])
    index = fmindex.FMIndex(flat, np.arange(len(flat)), 6)
    text = " ".join(map(str, flat))
    for size in range(1, 7):
        wanted = np.array([x[:size] for x in lines if len(x) >= size])
        low, high = index.search(wanted)
        for query, n in zip(wanted, high - low, strict=True):
            assert n == len(re.findall(f"(?=(?<!\\S){' '.join(map(str, query))}(?!\\S))", text))
    assert (index.search(np.array([[3, 3, 3, 3, 3, 3]]))[0] >= 0).all()


def ids_of(text):
    from tokenizers import Tokenizer
    if not hasattr(ids_of, "tool"):
        ids_of.tool = Tokenizer.from_file(queries.tokenizer())
    return [*ids_of.tool.encode(text or "", add_special_tokens=False).ids, 2]


def test_tokens_equal_the_library(spark, case):
    got = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist()
           for r in tokens.tokenized(case, queries.tokenizer(), 2).collect()}
    assert got == {d: ids_of(t) for d, t in texts(case).items()}


def test_a_small_word_cache_changes_nothing():
    tool = tokens.Encoder(queries.tokenizer(), cached=3)
    for _, text, _ in ODD:
        ids, at = tool.encode(pa.array([text, text]), 2)
        assert ids.tolist() == ids_of(text) * 2 and at.tolist() == [0, len(ids) // 2, len(ids)]


def test_spellings_share_ids_only_where_the_library_gives_the_same():
    marked = [f"{c}{m}ad" for c in "HJTWhjtw" for m in "\u0331\u030c\u0308\u030a"]
    tool = tokens.Encoder(queries.tokenizer())
    for word in ["<|ENDOFTEXT|>", "<|EndOfText|>", "<|endoftext|>", "x<|StartOfText|>Y", "J\u030ca", "H\u0331ad", "HaD", "had", *marked]:
        ids, _ = tool.encode(pa.array([f"so {word} it", word.swapcase()]), 2)
        assert ids.tolist() == ids_of(f"so {word} it") + ids_of(word.swapcase()), word


def test_marks_are_parted_and_small_letters_need_no_normalizer():
    class Refuses:
        def __init__(self, tool):
            self.tool = tool

        def __getattr__(self, name):
            if name.startswith("encode"):
                raise AssertionError("the whole tokenizer is used")
            return getattr(self.tool, name)

    tool = tokens.Encoder(queries.tokenizer())
    marks, _ = tool.encode(pa.array([". , !"]), None)
    assert marks.tolist() == ids_of(". , !")[:-1] and tool.splits and tool.lowers
    tool.tokenizer = Refuses(tool.tokenizer)
    text = "Haus haus. Haus! gr\u00f6\u00dfe, Gr\u00f6\u00dfe ni\u00f1o ni\u00f1o! \u0142zy"
    ids, at = tool.encode(pa.array([text]), 2)
    assert ids.tolist() == ids_of(text) and at.tolist() == [0, len(ids)]
    assert set(tool.slots) == {"", "!", ".", ",", "haus", "gr\u00f6\u00dfe", "ni\u00f1o", "\u0142zy"}


@pytest.mark.parametrize("change", [
    {}, {"normalizer": {"type": "NFC"}}, {"normalizer": None}, {"normalizer": {"type": "NFKC"}},
    {"pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}},
    {"added_tokens": [{"id": 49_408, "content": "ab", "single_word": False, "lstrip": False, "rstrip": False,
                       "normalized": False, "special": True}]},
])
def test_words_of_many_letters_equal_the_library(tmp_path, change):
    import json

    from tokenizers import Tokenizer
    with open(queries.tokenizer()) as f:
        form = json.load(f) | change
    (tmp_path / "one.json").write_text(json.dumps(form))
    library, tool = Tokenizer.from_file(str(tmp_path / "one.json")), tokens.Encoder(str(tmp_path / "one.json"))
    r = random.Random(7)
    plain, more = "abcde\u00e9\u00df\u00e4\u0142.,", [
        *"abAB\u00df\u00e4\u00c9\u0130\u0131\u01c4\u01c5\u0149\u017f\u00d7\u00f7\u03a3\u03c2'.,!_-#|<>%09\u0301\u0338\u200b\u0085\x1c\ufb01\u1100\u1161\u00bd\u00aa\U0001f600",
        "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", "\u00a0", "e\u0301"]
    for _ in range(300):
        texts = [" ".join("".join(r.choices(letters, k=r.randint(0, 9))) for _ in range(r.randint(0, 12)))
                 for letters in (plain, more, plain, more)]
        ids, at = tool.encode(pa.array(texts), 2)
        for i, text in enumerate(texts):
            assert ids[at[i]:at[i + 1]].tolist() == [*library.encode(text, add_special_tokens=False).ids, 2], text


def test_token_files(spark, case, tmp_path):
    tokens.tokenized(case, queries.tokenizer(), 2, width=2).write.parquet(f"{tmp_path}/ids")
    rans.write(spark, spark.read.parquet(f"{tmp_path}/ids"), f"{tmp_path}/files", queries.VOCABULARY)
    got = [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist())
           for r in rans.read(spark, f"{tmp_path}/files", queries.VOCABULARY).orderBy("doc_id").collect()]
    want, at = [], 0
    for d, t in sorted(texts(case).items()):
        want.append((d, at, ids_of(t)))
        at += len(want[-1][2])
    assert got == want


def test_blocks_from_checkpoints_and_damage():
    r = np.random.default_rng(3)
    for n in (0, 1, 63, 5000, 300_000):
        ids = (r.zipf(1.3, n) % 49_408).astype(np.uint16)
        model = rans.Model(rans.quantized(np.bincount(ids, minlength=49_408)))
        block = rans.pack_block(model, np.array([5]), np.array([False]), np.array([n]), ids)
        assert (rans.unpack_block(model, block)[3] == ids).all()
        points = int(np.frombuffer(block, "<u4", 8)[5])
        lanes = int(np.frombuffer(block, "<u4", 8)[1])
        for k in range(points):
            assert (rans.unpack_block(model, block, k)[3] == ids[k * rans.CHECKPOINT * lanes:]).all()
    with pytest.raises(ValueError):
        rans.unpack_block(model, block[:500] + bytes([block[500] ^ 1]) + block[501:])
    p = model.freq[model.freq > 0] / 2**20
    assert len(block) < 1.1 * (n * -(p * np.log2(p)).sum() / 8) + 40_000


def test_packing(spark, case, tmp_path):
    want = {d: ids_of(t) for d, t in texts(case).items()}
    rows = packing.pack(spark, case, queries.tokenizer(), str(tmp_path), 2, length=256, windows=4).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        assert r["length"] == len(r["ids"]) // 4 > 0 and r["doc_tokens"] == len(want[r["doc_id"]])
        by_doc.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for d, ids in want.items():
        pieces = sorted(by_doc[d])
        assert [s for s, _ in pieces] == np.cumsum([0] + [len(p) for _, p in pieces])[:-1].tolist()
        assert sum((p for _, p in pieces), []) == ids
    for pieces in by_seq.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0] + [n for _, n in pieces])[:-1].tolist()
        total = sum(n for _, n in pieces)
        assert total == 256 or total & (total - 1) == 0 and total < 256


def test_quality(spark, case):
    rows = quality.verdicts(case).collect()
    got = {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
           for r in rows}
    assert got == {d: brute.quality(t) for d, t in texts(case).items()}
    assert all(not (r["kept"] and r["base_failed"]) for r in rows)


def test_quality_follows_labels(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.verdicts(docs).join(labels, "doc_id").where("NOT base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    assert sum(good) >= 0.99 * len(good)


def test_quality_keeps_rows_whole(spark, odd):
    kept = quality.keep(odd)
    assert kept.columns == odd.columns
    want = {r["doc_id"] for r in quality.verdicts(odd).where("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == want and 0 in want


def test_jaccard(spark, case, tmp_path):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.linked(spark, case, str(tmp_path)).collect()}
    assert got == brute.jaccard(texts(case))


def test_jaccard_of_a_large_group(spark, tmp_path):
    """Near copies at all distances, more than one block and more than SMALL rows a column."""
    r, words, rows = random.Random(4), BASE.split(), []
    for i in range(120):
        w = list(words)
        for _ in range(r.choice((0, 1, 1, 2, 3))):
            w[r.randrange(len(w))] = f"w{i}{r.random()}"
        rows.append((i * 7 % 120, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in jaccard.linked(spark, df, str(tmp_path), small=6, block=16).collect()}
    want = brute.jaccard(dict(rows))
    assert got == want and 1 < len({c for _, c in want.values()}) < 120


def test_jaccard_holds_a_set_once_whatever_its_blocks():
    text = [prose(i, 50) for i in range(20)]
    own = jaccard.sets(pa.record_batch({"text": text}), 4)
    part = pa.record_batch({"text": text, "row": [jaccard.row_of(s) for s in own], "label": pa.array([1] * 20, pa.int64()),
                            "blocks": pa.array([500] * 20, pa.int32())})
    out = list(jaccard.attached(iter([part, part]), 4))
    assert sum(b.num_rows for b in out) == 20 and sum(b.nbytes for b in out) < 2 * sum(s.nbytes for s in own)


def test_jaccard_has_counters_by_the_size_of_the_texts(spark, odd, tmp_path, monkeypatch):
    gb = 2**30
    assert [jaccard.counter_bits(x) for x in (0, gb // 2, 4 * gb, 10**15)] == [22, 22, 24, 26]
    monkeypatch.setattr(jaccard, "counter_bits", lambda size: 24)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.linked(spark, odd, str(tmp_path)).collect()}
    assert got == brute.jaccard(texts(odd))


def test_components(spark, tmp_path):
    r = random.Random(2)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    got = {x["node"]: x["label"] for x in components(spark, spark.createDataFrame(links, "a bigint, b bigint"), str(tmp_path)).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in parent}


def test_decontamination(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.regions(spark, docs, bench).collect()}
    fold = lambda t: decontam.characters([t or ""])[0]
    all_texts = {d: fold(t) for d, t in texts(docs).items()}
    items = {r["item_id"]: fold(r["text"]) for r in bench.collect()}
    # Exact windows are cheap to find everywhere; edits are tested by hand below.
    holders = {}
    for i, x in items.items():
        for a in range(max(1, len(x) - 79)):
            holders.setdefault(x[a:a + 80].tobytes(), set()).add(i)
    want = set()
    for n in {len(w) for w in holders}:
        for d, t in all_texts.items():
            raw = t.tobytes()
            for a in range(0, len(raw) - n + 1, 4):
                want |= {(d, i) for i in holders.get(raw[a:a + n], ())}
    assert got >= want and len(want) > 0
    for d, i in got - want:
        m = min(80, len(items[i]))
        assert any(brute.edits_within(items[i][s:s + m], all_texts[d]) <= m // 20 for s in range(len(items[i]) - m + 1))


def test_decontamination_by_edits(spark):
    item = prose(11, 30)[:100]
    r = random.Random(8)

    def edited(n):
        t = list(item)
        for _ in range(n):
            k, what = r.randrange(len(t)), r.randrange(3)
            t[k:k + 1] = [[], ["#"], [t[k], "#"]][what]
        return "".join(t)

    rows = [(i, f"{prose(50 + i, 20)} {edited(i % 10)} {prose(90 + i, 20)}") for i in range(60)]
    rows += [(100, None), (101, ""), (102, item[:79]), (103, item[:80].upper()), (104, f"{item} {prose(1, 9)} {item}")]
    bench = spark.createDataFrame([(7, item), (8, None), (9, "short"), (10, "")], "item_id bigint, text string")
    found = decontam.regions(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), bench).collect()
    fold = lambda t: decontam.characters([t or ""])[0]
    want = {d for d, t in rows if min(brute.edits_within(fold(item)[s:s + 80], fold(t)) for s in range(21)) <= 4}
    assert {f["doc_id"] for f in found} == want and {103, 104} <= want and 102 not in {x for x in want if x == 101}
    assert sorted((f["start"], f["edits"]) for f in found if f["doc_id"] == 104)[0] == (0, 0)
    assert sum(f["doc_id"] == 104 for f in found) == 2
    chunked = decontam.regions(spark, spark.createDataFrame(rows, "doc_id bigint, text string"),
                               bench.unionByName(bench.selectExpr("item_id + 100 AS item_id", "text")), chunk_chars=50).collect()
    assert {f["doc_id"] for f in chunked} == want and {f["item_id"] for f in chunked} == {7, 107}
    assert decontam.regions(spark, spark.createDataFrame([], "doc_id bigint, text string"), bench).count() == 0
    assert decontam.regions(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), bench.limit(0)).count() == 0


def test_decontamination_of_passages_from_any_place(spark):
    item = prose(21, 60)[:200]
    rows = [(n * 1000 + s, f"{prose(s, 9)} #{item[s:s + n]}# {prose(s + 1, 9)}") for n in (76, 80, 90) for s in range(0, 200 - n, 3)]
    docs = spark.createDataFrame([*rows, (1, item[30:100])], "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    found = {f["doc_id"]: (f["start"], f["end"]) for f in decontam.regions(spark, docs, bench).collect()}
    assert found.keys() == {d for d, _ in rows}
    for d, t in rows:
        a = t.index("#") + 1
        assert found[d][0] <= a + 4 and found[d][1] >= a + d // 1000 - 4


def test_decontamination_chunks_have_a_bound(spark):
    long, items = prose(22, 500)[:1500], [(i, prose(40 + i, 30)[:100]) for i in range(4)]
    bench = spark.createDataFrame([*items, (8, items[0][1]), (9, items[0][1]), (10, long), (11, long)], "item_id bigint, text string")
    passages = [long, long[130:300], f"{long[:90]} {prose(9, 20)} {long[700:800]}", long[155:235], items[0][1], items[3][1], "none"]
    rows = [(i % 6, f"{prose(i, 9)} {p} {prose(i + 1, 9)}") for i, p in enumerate(passages)]
    rows += [rows[0], rows[0], (None, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = lambda c: sorted(map(tuple, decontam.regions(spark, docs, bench, chunk_chars=c).collect()), key=str)
    assert found(400) == found(1_000_000) and sum(f[1] == 10 for f in found(400)) == 3 + 2 + 2 + 1
    keyed = bench.selectExpr("*", "xxhash64(text) AS item")
    parts, _ = decontam._parts(keyed, 80, 1, 400)
    for low, high in decontam._chunks(parts, 400):
        assert sum(len(r["text"]) for r in parts.where(f"bucket BETWEEN {low} AND {high}").collect()) <= 400


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        m = re.match(r"([^/?#]*)([^?#]*)", rest)
        host, path = "".join(c.lower() if c.isascii() else c for c in m[1]), m[2]
    best = None
    for h, p, verdict in (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
                          ("net", "/es/", "block"), ("net", "/fr/", "block")):
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return host, path, best


def test_url_filter(spark):
    urls = [None, "", "no scheme", "://", "http://", "http://EXAMPLE.com/en/1", "http://www.example.com/en/x?y#z",
            "http://a.www.example.com/en/", "http://xexample.com/en/", "http://com", "http://com/", "https://a.net/es/1", "https://net/fr/",
            "https://a.net/ES/1", "https://a.net/es", "http://a.net?x=/es/", "http://a.com#/en/", "http://a.com\n/en/", "x://y://a.com/b",
            "http://foo_example.com/en/", "http://ads.a.org/", "http://b.org/x.exe", "http://example.com//en/", "http://example.com/en/",
            "http://example.com/en/"]
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id bigint, url string, host string, rule string")
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    for frame in (df, pages):
        rows = {r["page_id"]: r["url"] for r in frame.collect()}
        got = {r["page_id"]: r for r in urlfilter.judge(spark, frame).collect()}
        assert got.keys() == rows.keys()
        for k, u in rows.items():
            host, path, best = judged(u)
            assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, best and best[0]), u
            if best:
                assert got[k]["verdict"] == best[1]
    assert got and {i for i, u in enumerate(urls) if u and "ads." in u or u and ".exe" in u} == {
        r["page_id"] for r in urlfilter.judge(spark, df).collect() if r["pattern"] and r["rule"] is None}
    assert urlfilter.judge(spark, df.limit(0)).count() == 0
    assert {r["verdict"] for r in urlfilter.judge(spark, df, rules=[]).collect()} == {"allow"}


def test_rules_run_only_where_their_token_stands(spark):
    df = spark.createDataFrame([(i, f"http://h{i}.org/a") for i in range(20)] + [(99, "http://rare.com/a")], "page_id bigint, url string")
    rules = [urlfilter.Rule("||rare.com^", "block"), urlfilter.Rule("*are.c*", "block")]
    assert urlfilter.tokens_of(rules[0]) == ["rare", "com"] and urlfilter.tokens_of(rules[1]) == []
    got = {r["page_id"]: (r["candidates"], r["verdict"]) for r in urlfilter.judge(spark, df, rules=rules).collect()}
    assert got[99] == (2, "block") and {v for k, v in got.items() if k != 99} == {(1, "allow")}


def test_revisits(spark):
    cols = ("record bigint, url string, time bigint, status int, etag string, modified string, digest string, "
            "headers map<string,string>, block string")
    rows = [(1, "u", 10, 200, "a", None, "d1", {"Date": "1", "Content-Type": "t", "X": "1"}, "b"),
            (2, "u", 20, 304, "W/a", None, None, {"date": "2", "content-type": "no"}, "b"),
            (3, "u", 30, 200, "b", "m", "d2", None, "b"), (4, "u", 30, 304, "b", None, None, {}, "b"),
            (5, "u", 40, 304, "a", "m", None, {}, "b"), (6, "u", 41, 304, None, "m", None, {}, "b"),
            (7, "u", 42, 304, None, None, None, {}, "b"), (8, "v", 5, 304, "a", None, None, {}, "b"),
            (9, "u", 43, 404, None, None, None, {}, "b"), (10, "u", 30, 200, "c", None, None, {}, "b"),
            (11, None, 9, 200, "a", None, None, {}, "b"), (12, None, 10, 304, "a", None, None, {}, "b"),
            (13, "u", None, 304, "a", None, None, {}, "b"), (14, "u", 42, 304, None, None, "zz", {}, "b")]
    for blocks in (1, 4, None):
        got = {r["record"]: (r["source"], r["outcome"], r["headers"]) for r in
               revisits.resolve(spark.createDataFrame(rows, cols).repartition(3), blocks).collect()}
        assert got[2] == (1, "resolved", {"date": "2", "content-type": "t", "x": "1"})
        assert got[4][:2] == (1, "mismatch") and got[5][:2] == (10, "mismatch")
        assert got[6][:2] == (10, "unverified") and got[7][:2] == (10, "unverified") and got[14][:2] == (10, "unverified")
        assert got[8][:2] == got[12][:2] == got[13][:2] == (None, "orphan") and len(got) == 9
    assert revisits.resolve(spark.createDataFrame([], cols)).count() == 0


def test_revisits_of_one_url_by_brute_force(spark):
    caps = revisits.captures_of_pages(spark.read.parquet(f"{SF}/pages.parquet"))
    rows = [r.asDict() for r in caps.collect()]
    want = {}
    for r in rows:
        if r["status"] == 304:
            before = [x for x in rows if x["url"] == r["url"] and x["status"] == 200 and x["time"] < r["time"]]
            want[r["record"]] = max(before, key=lambda x: (x["time"], x["record"]))["record"] if before else None
    assert {r["record"]: r["source"] for r in revisits.resolve(caps, 7).collect()} == want


def test_roots_of_other_hosts_are_other_resources(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(
        ["http://a.com/", "http://b.org/", "http://c.net", "https://www.a.com", None, "no url", None, "no url"])],
        "page_id bigint, url string, html string")
    caps = revisits.captures_of_pages(pages)
    owner = {r["record"]: r["url"] for r in caps.collect()}
    assert set(owner.values()) == {"a.com", "b.org", "c.net", None}
    found = revisits.resolve(caps).collect()
    assert {r["outcome"] for r in found if r["url"] is None} == {"orphan"}
    assert all(owner[r["source"]] == r["url"] for r in found if r["source"] is not None)
    assert {r["url"] for r in found if r["source"] is not None} == {"a.com", "b.org", "c.net"}


def test_one_url_with_most_rows_is_in_many_blocks(spark):
    cols = "record bigint, url string, time bigint, status int, etag string, modified string, digest string, headers map<string,string>"
    rows = [(i, "hot" if i % 10 else f"u{i}", i // 3, 200 if i % 7 == 0 else 304, None, None, None, None) for i in range(3000)]
    folder = queries.scratch_folder(spark, "blocks")
    got = {r["record"]: r["source"] for r in revisits.resolve(spark.createDataFrame(rows, cols), 8, folder).collect()}
    sizes = {r["block"]: r["count"] for r in spark.read.parquet(folder).groupBy("block").count().collect()}
    assert len(sizes) == 8 and max(sizes.values()) < 1000
    full = [r for r in rows if r[3] == 200 and r[1] == "hot"]
    for i, url, t, status, *_ in rows:
        if status == 304 and url == "hot":
            assert got[i] == max(((x[2], x[0]) for x in full if x[2] < t), default=(None, None))[1]


def test_a_response_of_the_same_time_in_another_block_is_not_earlier(spark):
    cols = "record bigint, url string, time bigint, status int, etag string, modified string, digest string, headers map<string,string>"
    rows = [(i, "one", i // 400, 200 if i % 2 else 304, None, None, None, None) for i in range(800)]
    got = {r["record"]: r["source"] for r in revisits.resolve(spark.createDataFrame(rows, cols), 8).collect()}
    assert got == {i: 399 if i >= 400 else None for i in range(0, 800, 2)}


def test_canonical_urls(spark):
    from pyspark.sql import functions as F
    rows = [("HTTP://WWW.A.com:80/x/?utm_source=f&b=2&a=1#t", "a.com/x?a=1&b=2"), ("https://a.com/X/", "a.com/X"),
            ("https://a.com?ref=x", "a.com"), (None, None), ("", None), ("http://a.com/", "a.com"), ("mailto:x@a.com", None),
            ("http:///path", None), (" https://m.b.org:443 ", "m.b.org")]
    df = spark.createDataFrame(rows, "url string, want string")
    assert all(r[0] == r[1] for r in df.select(revisits.canonical(F.col("url")), "want").collect())


def test_rollups(spark, tmp_path):
    cols = "op string, doc_id bigint, source string, lang string, version string, tokens bigint, docs int"
    store = str(tmp_path)

    def commit(n, *rows):
        rollups.commit(spark, store, n, spark.createDataFrame([(*r, 0) for r in rows], cols))

    def totals():
        return {(r["source"], r["lang"], r["version"]): (r["docs"], r["tokens"]) for r in rollups.totals(spark, store).collect()}

    commit(1, ("insert", 1, "a", "en", "v", 10), ("insert", 2, "a", "en", "v", 5), ("insert", 3, None, None, "v", None),
           ("insert", 1, "a", "en", "w", 20))
    first = totals()
    assert first == {("a", "en", "v"): (2, 15), (None, None, "v"): (1, 0), ("a", "en", "w"): (1, 20)}
    for _ in range(2):  # the same batch again changes nothing
        commit(2, ("delete", 1, None, None, None, None), ("delete", 1, None, None, "v", None), ("revise", 2, "b", "en", "v", 7),
               ("delete", 99, None, None, None, None))
        assert totals() == {("b", "en", "v"): (1, 7), (None, None, "v"): (1, 0)}
    commit(3)
    commit(4, ("insert", 1, "a", "en", "v", 10), ("revise", 2, "b", "en", "v", 8))
    assert totals() == {("a", "en", "v"): (1, 10), ("b", "en", "v"): (1, 8), (None, None, "v"): (1, 0)}
    commit(1, ("insert", 1, "a", "en", "v", 10), ("insert", 2, "a", "en", "v", 5), ("insert", 3, None, None, "v", None),
           ("insert", 1, "a", "en", "w", 20))
    assert totals() == {("a", "en", "v"): (1, 10), ("b", "en", "v"): (1, 8), (None, None, "v"): (1, 0)}
    with pytest.raises(ValueError):
        commit(0)
    # Rows without an id are taken back together; a batch below the highest one is refused.
    commit(6, ("insert", None, "n", "en", "v", 3), ("insert", None, "n", "en", "v", 4))
    assert totals()["n", "en", "v"] == (2, 7)
    commit(7, ("delete", None, None, None, None, None), ("insert", 5, "n", "en", "v", 1))
    assert totals()["n", "en", "v"] == (1, 1)
    before = totals()
    with pytest.raises(ValueError, match="after batch 7"):
        commit(5, ("insert", 9, "a", "en", "v", 7))
    assert totals() == before


def test_a_small_batch_reads_touched_buckets(spark, tmp_path):
    store = str(tmp_path)
    cols = "op string, doc_id bigint, source string, lang string, version string, tokens bigint"
    rollups.commit(spark, store, 1, spark.range(500).selectExpr("'insert' op", "id doc_id", "'a' source", "'en' lang", "'v' version", "1L tokens"))
    log = rollups._read(spark, f"{store}/log", rollups.LOG)
    assert log.select("bucket").distinct().count() == rollups.BUCKETS
    one = log.where("doc_id = 7").first()["bucket"]
    assert all(f"bucket={one}/" in f for f in log.where(f"bucket = {one}").select("doc_id").inputFiles()) or \
        "PartitionFilters: [isnotnull(bucket" in log.where(f"bucket = {one}")._jdf.queryExecution().executedPlan().toString()
    rollups.commit(spark, store, 2, spark.createDataFrame([("delete", 7, None, None, None, None)], cols))
    assert rollups.totals(spark, store).first()["docs"] == 499
