"""Repeated passages of WINDOW words, removed wherever they begin earlier as well.

1. Every window of words has an anchor: the leftmost least of the hashes of its GRAM-word grams.
   Equal windows have equal anchors, so only anchors that two places have can matter. Tasks send
   each of their distinct anchors once, in packed columns, and learn which ones others have too.
2. A snippet is the stretch of words under consecutive windows of one anchor. Documents with
   shared anchors send theirs to the shard of the anchor; equal snippets leave a task once, with
   the first place, and are all repeats at the other places.
3. A shard builds an FM-index over its distinct snippets and streams them through it. Matching
   statistics give, for each place that matches WINDOW words and more, the first place in the
   corpus where they begin. Windows that begin elsewhere first are reported.
4. The reported windows of a document cover the words that go.

An anchor may stand in a third of all documents with other words around it; where it has more
than SNIPPETS snippets they are cut into windows that are dealt by their own words. Windows are judged on the input. doc_id is taken as unique (rows that
share one count as the same place); NULL is smaller than any. NULL texts have no words.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.llm.fmindex import FMIndex
from mercata.llm.tokens import slices
from mercata.llm.words import FACTORS, hashes, mixed, signed, split

WINDOW = 20
GRAM = 6
SNIPPETS = 12_000  # distinct snippets of a shard
MOST_BROADCAST = 100_000  # hot anchors, counted
NO_ID = -2**63
DOCS = "doc bigint, n_words bigint, sha string, bucket int, anchors binary, docs binary, many binary"
M = FACTORS[0]


def slide(x: np.ndarray, n: int, f: np.ufunc) -> np.ndarray:
    """f over each n neighbours."""
    length = 1
    while length * 2 <= n:
        x = f(x[:-length], x[length:])
        length *= 2
    rest = n - length
    return f(x[:-rest], x[rest:]) if rest else x


class Snippets:
    """Anchors of a slice of documents with the windows they stand for."""

    def __init__(self, texts: pa.Array, window: int, gram: int) -> None:
        self.words, codes, self.at = split(texts)
        w = hashes(self.words)[codes]
        self.codes, self.w = codes, w
        total, v = len(w), window - gram + 1
        self.doc = np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))
        empty = np.zeros(0, np.int64)
        self.anchor, self.first, self.windows, self.owner = np.zeros(0, np.uint64), empty, empty, empty
        if total < window:
            return
        grams = np.zeros(total - gram + 1, np.uint64)
        for i in range(gram):
            grams += w[i:total - gram + 1 + i] * (FACTORS[i % 4] + np.uint64(2 * (i // 4)))
        grams = mixed(grams)
        least = slide(grams, v, np.minimum)
        n = len(least)
        # Window j's anchor is the first place in j, j + 1, ... where the least gram stands.
        place = np.full(n, -1, np.int64)
        open_ = np.arange(n)
        for k in range(v):
            hit = grams[open_ + k] == least[open_]
            place[open_[hit]] = open_[hit] + k
            open_ = open_[~hit]
        inside = np.flatnonzero(self.doc[:n] == self.doc[window - 1:window - 1 + n])
        p = place[inside]
        new = np.concatenate([[True], (p[1:] != p[:-1]) | (inside[1:] != inside[:-1] + 1)]) if len(p) else np.zeros(0, bool)
        start = np.flatnonzero(new)
        self.first = inside[start]
        self.anchor = grams[p[start]]
        self.windows = np.diff(np.append(start, len(p)))
        self.owner = self.doc[self.first]

    def names(self, window: int) -> np.ndarray:
        """Hash of each snippet's words."""
        n = len(self.w)
        inverse = np.uint64(pow(int(M), -1, 2**64))
        up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, M)]), dtype=np.uint64)
        down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, inverse)]), dtype=np.uint64)
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.w * up[:-1], dtype=np.uint64)])
        a, b = self.first, self.first + self.windows + window - 1
        return mixed((upto[b] - upto[a]) * down[a] + self.windows.astype(np.uint64) * FACTORS[1])


def _digest(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def _first_pass(docs: DataFrame, buckets: int, window: int, gram: int) -> DataFrame:
    """A row per document (words, digest of all of them), and per task and bucket its anchors:
    those of one document with that document, those of more in ``many``. Documents of the latter
    are sent as anchor and document pairs in a bucket of their own number, below zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "n_words", "sha", "bucket", "anchors", "docs", "many"]
        held_a: list[np.ndarray] = []
        held_d: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            a, d = np.concatenate(held_a), np.concatenate(held_d)
            order = np.lexsort((d, a))
            a, d = a[order], d[order]
            new = np.concatenate([[True], a[1:] != a[:-1]])
            group = np.cumsum(new) - 1
            start = np.flatnonzero(new)
            often = np.diff(np.append(start, len(a)))
            single = often[group] == 1
            for bucket, keep in enumerate_buckets(a[start], buckets):
                s = start[keep]
                one = often[keep] == 1
                yield row(bucket, a[s[one]], d[s[one]], a[s[~one]])
            if (~single).any():
                a, d = a[~single], d[~single]
                keep = np.concatenate([[True], (a[1:] != a[:-1]) | (d[1:] != d[:-1])])
                yield row(-1, a[keep], d[keep], a[:0])

        def row(bucket: int, a: np.ndarray, d: np.ndarray, many: np.ndarray) -> pa.RecordBatch:
            pack = [pa.array([zlib.compress(x.tobytes(), 1)], pa.binary()) for x in (a, d, many)]
            return pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()),
                                               pa.array([bucket], pa.int32()), *pack], names)

        for batch in batches:
            for part in slices(batch, "text"):
                found = Snippets(part["text"], window, gram)
                ids = part["doc"].to_numpy()
                n = np.diff(found.at)
                sha = [_digest(b" ".join((t or "").encode().split())) for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part["doc"], pa.array(n), pa.array(sha), *(pa.nulls(len(n), k) for k in (
                        pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names)
                held_a.append(found.anchor)
                held_d.append(ids[found.owner])
                size += len(found.anchor)
                if size > 4_000_000:
                    yield from flush()
                    held_a, held_d, size = [], [], 0
        if size:
            yield from flush()

    return docs.mapInArrow(run, DOCS)


def enumerate_buckets(anchors: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Buckets that sorted anchors fall in (ranges of their hash) and the places of each."""
    own = (anchors >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)
    start = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else own
    for s, e in zip(start.tolist(), [*start[1:].tolist(), len(own)], strict=True):
        yield int(own[s]), np.arange(s, e)


def _unpacked(value: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zlib.decompress(value), kind)


def _shared(first: DataFrame) -> DataFrame:
    """(doc, anchor) of anchors that stand in two tasks or twice in one, where one task has it
    in one place only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None

        def done() -> pa.RecordBatch:
            one = np.concatenate([_unpacked(r[0], np.uint64) for r in held])
            docs = np.concatenate([_unpacked(r[1], np.int64) for r in held])
            many = np.concatenate([_unpacked(r[2], np.uint64) for r in held])
            names, back, often = np.unique(one, return_inverse=True, return_counts=True)
            keep = (often > 1)[back] | np.isin(one, many)
            return pa.RecordBatch.from_arrays([pa.array(docs[keep]), signed(one[keep])], ["doc", "anchor"])

        for batch in batches:
            for bucket, *row in zip(*(batch[c].to_pylist() for c in ("bucket", "anchors", "docs", "many")), strict=True):
                if bucket != now and held:
                    yield done()
                    held = []
                now = bucket
                held.append(row)
        if held:
            yield done()

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, d in zip(batch["anchors"].to_pylist(), batch["docs"].to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(_unpacked(d, np.int64)), signed(_unpacked(a, np.uint64))],
                                                 ["doc", "anchor"])

    packed = first.where("bucket IS NOT NULL").select("bucket", "anchors", "docs", "many")
    return (packed.where("bucket >= 0").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "doc bigint, anchor bigint")
            .unionByName(packed.where("bucket < 0").mapInArrow(local, "doc bigint, anchor bigint")))


SNIPPET = "anchor bigint, name bigint, doc bigint, first int, windows int, words binary"


def _snippets(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """Distinct snippets under shared anchors with their first place in the task; the other
    places have no words and no anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[int, int, int, int, bytes]] = {}

        def flush() -> pa.RecordBatch:
            values = list(best.values())
            best_names = np.fromiter(best, np.uint64, len(best))
            columns = list(zip(*values, strict=True)) if values else [()] * 5
            return pa.RecordBatch.from_arrays([
                pa.array(np.array(columns[0], np.uint64).view(np.int64)), signed(best_names), pa.array(columns[1], pa.int64()),
                pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32()), pa.array(columns[4], pa.binary())],
                ["anchor", "name", "doc", "first", "windows", "words"])

        for batch in batches:
            for part in slices(batch, "text"):
                found = Snippets(part["text"], window, gram)
                lists = part["anchors"]
                wanted = lists.flatten().to_numpy().view(np.uint64)
                of = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                # Both sides as one number: an anchor and its document in the slice.
                mine = mixed(found.anchor + found.owner.astype(np.uint64) * FACTORS[2])
                keep = np.flatnonzero(np.isin(mine, mixed(wanted + of.astype(np.uint64) * FACTORS[2])))
                names = found.names(window)[keep].tolist()
                ids = part["doc"].to_numpy()[found.owner[keep]].tolist()
                first = (found.first[keep] - found.at[found.owner[keep]]).tolist()
                a, n, places = found.anchor[keep].tolist(), found.windows[keep].tolist(), found.first[keep].tolist()
                short = (found.w & np.uint64(0xFFFFFFFFFFFF)).astype("<u8")
                late = []
                for k, name in enumerate(names):
                    old = best.get(name)
                    if old is not None and (old[1], old[2]) <= (ids[k], first[k]):
                        if (old[1], old[2]) != (ids[k], first[k]):
                            late.append((ids[k], first[k], n[k]))
                        continue
                    if old is not None:
                        late.append((old[1], old[2], old[3]))
                    p = places[k]
                    best[name] = (a[k], ids[k], first[k], n[k], short[p:p + n[k] + window - 1].view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
                if late:
                    columns = list(zip(*late, strict=True))
                    yield pa.RecordBatch.from_arrays([
                        pa.nulls(len(late), pa.int64()), pa.nulls(len(late), pa.int64()), pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()), pa.nulls(len(late), pa.binary())],
                        ["anchor", "name", "doc", "first", "windows", "words"])
                if len(best) > 200_000:
                    yield flush()
                    best.clear()
        if best:
            yield flush()

    return texts.mapInArrow(run, SNIPPET)


def matched(lines: list[bytes], docs: np.ndarray, first: np.ndarray, window: int) -> list[np.ndarray]:
    """For each snippet, which of its windows begin earlier in another place.

    ``lines`` are words of six bytes each. One index over the snippets, all of them streamed."""
    raw = np.frombuffer(b"".join(lines), np.uint8).reshape(-1, 6)
    words = np.zeros((len(raw), 8), np.uint8)
    words[:, :6] = raw
    names, codes = np.unique(words.view(np.uint64).ravel(), return_inverse=True)
    sizes = np.array([len(x) // 6 for x in lines], np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    # Places as numbers in the order of (doc, start), so that one minimum finds the first.
    own = np.repeat(np.arange(len(lines)), sizes)
    start = first[own] + np.arange(len(own)) - at[own]
    order = np.lexsort((start, docs[own]))
    d, s = docs[own][order], start[order]
    rank = np.empty(len(own), np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], ((d[1:] != d[:-1]) | (s[1:] != s[:-1])).astype(np.int64)]))
    flat = np.zeros(len(own) + len(lines), np.int64)
    value = np.full(len(flat), np.iinfo(np.int64).max, np.int64)
    spot = np.arange(len(own)) + own  # a 0 ends each sequence
    flat[spot], value[spot] = codes + 1, rank
    index = FMIndex(flat, value, window)
    width = int(sizes.max())
    table = np.zeros((len(lines), width), np.int64)
    column = np.arange(len(own)) - at[own] + (width - sizes)[own]
    table[own, column] = codes + 1
    least = index.statistics(table, sizes)[own, column]
    earlier = least < rank
    return [earlier[a:b - window + 1] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _spread(spark: SparkSession, snippets: DataFrame, window: int, limit: int) -> DataFrame:
    """Snippets by anchor; those of an anchor with more than ``limit`` of them are cut into their
    windows, each under the hash of its words, so that only equal windows stay together."""
    hot = snippets.groupBy("anchor").count().where(F.col("count") > limit).select("anchor", F.lit(True).alias("hot"))
    n = hot.count()
    if not n:
        return snippets
    marked = snippets.join(F.broadcast(hot) if n <= MOST_BROADCAST else hot, "anchor", "left")
    each = F.when(F.col("hot"), F.sequence(F.lit(0), F.col("windows") - 1)).otherwise(F.array(F.lit(0)))
    words = F.when(F.col("hot"), F.expr(f"substring(words, 6 * t + 1, {6 * window})")).otherwise(F.col("words"))
    cut = marked.withColumn("t", F.explode(each)).withColumn("words", words)
    key = F.when(F.col("hot"), F.xxhash64("words"))
    return cut.select(F.coalesce(key, "anchor").alias("anchor"), F.coalesce(key, "name").alias("name"), "doc",
                      (F.col("first") + F.col("t")).alias("first"),
                      F.when(F.col("hot"), 1).otherwise(F.col("windows")).alias("windows"), "words")


def _repeats(spark: SparkSession, snippets: DataFrame, window: int, limit: int) -> DataFrame:
    """(doc, first, mask): windows from ``first`` on that begin earlier somewhere, as bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        late: list[tuple[int, int, int]] = []
        now = None

        def rows_of(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()),
                                               pa.array(columns[2], pa.int64())], ["doc", "first", "mask"])

        def search() -> list[tuple[int, int, int]]:
            docs, first = (np.array([r[i] for r in shard], np.int64) for i in (1, 2))
            hits = matched([r[4] for r in shard], docs, first, window)
            return [(r[1], r[2], int(bits @ (1 << np.arange(len(bits))))) for r, bits in zip(shard, hits, strict=True)
                    if bits.any()]

        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("anchor", "name", "doc", "first", "windows", "words")), strict=True)
            for anchor, *row in rows:
                if anchor != now:
                    if len(shard) >= limit:
                        if found := search():
                            yield rows_of(found)
                        shard.clear()
                    now = anchor
                elif shard and row[0] == shard[-1][0]:  # equal words in a later place
                    if (row[1], row[2]) != (shard[-1][1], shard[-1][2]):
                        late.append((row[1], row[2], (1 << row[3]) - 1))
                    continue
                shard.append(tuple(row))
            if late:
                yield rows_of(late)
                late.clear()
        if shard and (found := search()):
            yield rows_of(found)

    with_words = _spread(spark, snippets.where("words IS NOT NULL"), window, limit)
    others = snippets.where("words IS NULL").select("doc", "first", F.expr("shiftleft(1L, windows) - 1").alias("mask"))
    return (with_words.repartition("anchor").sortWithinPartitions("anchor", "name", "doc", "first")
            .mapInArrow(run, "doc bigint, first int, mask bigint").unionByName(others))


def _kept(texts: DataFrame, window: int) -> DataFrame:
    """Documents with reported windows: words removed, and the digest of the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                removed, sha, texts_out = [], [], []
                for text, hits in zip(part["text"].to_pylist(), part["hits"].to_pylist(), strict=True):
                    words = (text or "").encode().split()
                    gone = np.zeros(len(words) + 1, np.int32)
                    for hit in hits:
                        mask, at = hit["mask"], hit["first"]
                        while mask:
                            low = (mask & -mask).bit_length() - 1
                            run_ = ((mask >> low) + 1 & -((mask >> low) + 1)).bit_length() - 1  # ones in a row
                            gone[at + low] += 1
                            gone[at + low + run_ - 1 + window] -= 1
                            mask &= ~(((1 << run_) - 1) << low)
                    cut = np.cumsum(gone[:-1]) > 0
                    left = b" ".join([w for w, c in zip(words, cut.tolist(), strict=True) if not c])
                    removed.append(int(cut.sum()))
                    sha.append(_digest(left))
                    texts_out.append(left.decode())
                yield pa.RecordBatch.from_arrays([part["doc"], pa.array(removed, pa.int64()), pa.array(sha, pa.string()),
                                                  pa.array(texts_out, pa.string())], ["doc", "n_removed", "kept_sha", "kept"])

    return texts.mapInArrow(run, "doc bigint, n_removed bigint, kept_sha string, kept string")


def repeated(spark: SparkSession, docs: DataFrame, scratch: str, key: str = "doc_id", text: str = "text",
             window: int = WINDOW, gram: int = GRAM, limit: int = SNIPPETS) -> tuple[DataFrame, DataFrame]:
    """The documents (doc, n_words, sha of all words) and the reported windows (doc, hits)."""
    plain = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc"), F.col(text).alias("text"))
    buckets = max(64, -(-plain.count() // 2000))
    _first_pass(plain, buckets, window, gram).write.mode("overwrite").parquet(f"{scratch}/first")
    first = spark.read.schema(DOCS).parquet(f"{scratch}/first")
    lists = _shared(first).groupBy("doc").agg(F.collect_set("anchor").alias("anchors"))
    texts = plain.join(lists, "doc").select("doc", "text", "anchors")
    _snippets(texts, window, gram).write.mode("overwrite").parquet(f"{scratch}/snippets")
    snippets = spark.read.schema(SNIPPET).parquet(f"{scratch}/snippets")
    hits = (_repeats(spark, snippets, window, limit).groupBy("doc")
            .agg(F.collect_set(F.struct("first", "mask")).alias("hits")))
    return first.where("bucket IS NULL").select("doc", "n_words", "sha"), hits


def deduplicated(spark: SparkSession, docs: DataFrame, scratch: str, key: str = "doc_id", text: str = "text",
                 window: int = WINDOW, keep_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, the kept words (NULL where the
    document stays as it is)."""
    rows, hits = repeated(spark, docs, scratch, key, text, window)
    plain = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc"), F.col(text).alias("text"))
    cut = _kept(plain.join(hits, "doc").select("doc", "text", "hits"), window)
    out = rows.join(cut if keep_text else cut.drop("kept"), "doc", "left")
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_words",
                      F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
                      F.coalesce("kept_sha", "sha").alias("kept_sha256"), *(["kept"] if keep_text else []))
