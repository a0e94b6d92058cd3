"""Ranked lexical search in K2-treaps over the term by document grid.

1. One pass counts the documents with a term and all terms, from which a document's length factor
   follows.
2. Index. The documents of a task are dealt to shards of bounded text. A shard's grid has a row
   per term, frequent ones first, and a column per document by ascending id. Bands of 2 ** BAND
   rows are cut into quadrants; once a cell is one row, its range of documents is halved. A cell is
   kept if it holds a posting, with the greatest impact in it: children are a bitmap whose ranks
   number the cells below, maxima are stored as what they fall short of their parent's, and both
   are compressed. (A treap moves its maximum out of the cell; here it stays, so that a path finds
   all impacts of its own row.) Shards are rows of a table in the shared folder.
3. Weights come from document counts of the items' terms, summed over the shards.
4. Search. Items are put in blocks of bounded size; every shard meets every block. The paths of an
   item's rows descend together: the sum of weight times maximum bounds the score of every
   document of a range. Ranges are taken best first, in batches that double, down to single
   documents, where the sums are the scores, and no range below the item's worst place so far is
   entered. A task keeps its best documents over its shards, so later shards start with that bound.
   The best of all tasks are ranked per item, and Spark cuts each task's rows to ``top`` before.

Work that a bound saves never changes the result. All scores are 64-bit integers. Blocks are
broadcast up to MOST_BROADCAST bytes of terms, else joined on (block, salt).

NULL and empty texts have no terms, count for nothing and are never found. An item is an item_id:
rows with the same id (or all NULL ids) are one item with all their terms. Documents with the same
id are ranked apart; among equal scores a NULL id comes last. An item without a term in any
document, and all items of an empty table, give no rows. A text of any length is read whole: a very
long one is a shard of its own. Only the columns named are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercata.llm.tokens import slices
from mercata.llm.words import frees, fresh, split

TOP = 50
SHARD_BYTES = 6 << 20
SHARD_DOCS = 4096
BAND = 3  # rows of a band, as a power of 2
RANGE = 6  # documents of the ranges that are ordered, as a power of 2
BLOCK_TERMS = 16_384  # terms of the items of a block
HELD_BLOCKS = 32  # blocks whose best documents a task keeps; those of an older one are sent on
MOST_BROADCAST = 64 << 20
SALTS = 64
INDEX = ("doc_ids array<bigint>, terms array<string>, counts array<int>, roots binary, children array<binary>, "
         "short array<binary>")

# Characters of terms: digits, letters and all beyond ASCII. A-Z become a-z, all others a blank.
TABLE = np.array([c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)], np.uint8)


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct terms, a code into them for each term in a row, and where each text's terms begin."""
    texts = fresh(texts)
    _, offsets, data = texts.buffers()
    mapped = pa.py_buffer(TABLE[np.frombuffer(data, np.uint8)]) if data else data
    return split(pa.LargeStringArray.from_buffers(len(texts), offsets, mapped))


def _packed(values: np.ndarray) -> bytes:
    """32-bit integers by planes of bytes, compressed."""
    import zstandard
    return zstandard.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _one(values: pa.Array) -> pa.ListArray:
    """A column whose only value is the list of ``values``."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


class Postings:
    """Terms and counts of the documents of one shard, while it grows."""

    def __init__(self) -> None:
        self.ids, self.words, self.parts = [], [], []
        self.docs = self.size = self.known = 0

    def add(self, part: pa.RecordBatch) -> None:
        words, codes, at = terms(part["text"])
        lengths = np.diff(at)
        row = np.repeat(np.arange(len(lengths)), lengths)
        key, often = np.unique(row * max(len(words), 1) + codes, return_counts=True)
        doc, code = np.divmod(key, max(len(words), 1))
        self.parts.append(((code + self.known).astype(np.int32), (doc + self.docs).astype(np.int32), often.astype(np.int32), lengths))
        self.ids.append(part["doc_id"])
        self.words.append(words)
        self.known += len(words)
        self.docs += len(lengths)
        self.size += part["text"].nbytes

    def shard(self, n_docs: int, n_terms: int) -> pa.RecordBatch:
        ids = pa.concat_arrays(self.ids)
        order = pc.array_sort_indices(ids).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        coded = pa.chunked_array(self.words).combine_chunks().dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[np.concatenate([p[0] for p in self.parts])]
        doc, often, lengths = (np.concatenate([p[k] for p in self.parts]).astype(np.int64) for k in (1, 2, 3))
        self.parts = []
        factor = np.array([50 + 50 * n * n_docs // n_terms for n in lengths.tolist()], np.int64)
        impact = 1_000_000_000 * often // (1000 * often + 20 * factor[doc])
        counts = np.bincount(code, minlength=len(coded.dictionary))
        frequent = np.argsort(-counts, kind="stable")
        row = np.empty(len(frequent), np.int64)
        row[frequent] = np.arange(len(frequent))
        roots, children, short = treap(row[code], place[doc], impact, len(ids))
        return pa.RecordBatch.from_arrays([
            _one(ids.take(pa.array(order))), _one(coded.dictionary.cast(pa.string()).take(pa.array(frequent))),
            _one(pa.array(counts[frequent].astype(np.int32))), pa.array([roots], pa.binary()),
            _one(pa.array(children, pa.binary())), _one(pa.array(short, pa.binary()))],
            ["doc_ids", "terms", "counts", "roots", "children", "short"])


def depth(docs: int) -> tuple[int, int]:
    """Levels of a grid of so many documents, and how many of them halve the rows too."""
    levels = max(1, (docs - 1).bit_length())
    return levels, min(BAND, levels)


def treap(row: np.ndarray, doc: np.ndarray, impact: np.ndarray, docs: int) -> tuple[bytes, list[bytes], list[bytes]]:
    """Maxima of the bands; for each level the bitmap of children, and what their maxima fall short."""
    levels, both = depth(docs)
    path, low = row >> both, row & ((1 << both) - 1)
    for k in range(1, both + 1):
        path = path * 4 + 2 * (low >> (both - k) & 1) + (doc >> (levels - k) & 1)
    path = (path << (levels - both)) | (doc & ((1 << (levels - both)) - 1))
    order = np.argsort(path)
    path, top = path[order], impact[order]
    children, short = [], []
    for level in range(levels - 1, -1, -1):
        width = 4 if level < both else 2
        above = path // width
        starts = np.flatnonzero(np.diff(above, prepend=-1))
        number = np.cumsum(np.diff(above, prepend=-1) != 0) - 1
        most = np.maximum.reduceat(top, starts)
        bits = np.zeros(len(starts) * width, np.uint8)
        bits[number * width + path % width] = 1
        children.append(np.packbits(bits).tobytes())
        short.append(_packed(most[number] - top))
        path, top = above[starts], most
    return _packed(top), children[::-1], short[::-1]


class Grid:
    """A shard's cells, level by level."""

    def __init__(self, docs: int, roots: bytes, children: list[bytes], short: list[bytes]) -> None:
        self.levels, self.both = depth(docs)
        self.tops, self.bits, self.ranks = [_unpacked(roots)], [], []
        for level, (bits, less) in enumerate(zip(children, short, strict=True)):
            width = self.width(level)
            bits = np.unpackbits(np.frombuffer(bits, np.uint8))[:len(self.tops[-1]) * width]
            self.bits.append(bits.astype(bool))
            self.ranks.append(np.cumsum(bits, dtype=np.int32))
            many = bits.reshape(-1, width).sum(axis=1, dtype=np.int64)
            self.tops.append(np.repeat(self.tops[-1], many) - _unpacked(less))

    def width(self, level: int) -> int:
        return 4 if level < self.both else 2


def _sums(group: np.ndarray, values: np.ndarray, groups: int) -> np.ndarray:
    """Exact sums by group; bincount adds in doubles."""
    if not len(values) or int(values.max()) * len(values) < 1 << 53:
        return np.bincount(group, values, groups).astype(np.int64)
    high = np.bincount(group, values >> 20, groups).astype(np.int64)
    return (high << 20) + np.bincount(group, values & ((1 << 20) - 1), groups).astype(np.int64)


class Frontier:
    """Ranges of documents (an item, a range, a bound each) and the paths that meet in them."""

    def __init__(self, item: np.ndarray, span: np.ndarray, bound: np.ndarray, group: np.ndarray, cell: np.ndarray,
                 low: np.ndarray, weight: np.ndarray) -> None:
        self.item, self.span, self.bound = item, span, bound
        self.group, self.cell, self.low, self.weight = group, cell, low, weight

    def chosen(self, keep: np.ndarray) -> Frontier:
        number = np.cumsum(keep) - 1
        p = np.flatnonzero(keep[self.group])
        return Frontier(self.item[keep], self.span[keep], self.bound[keep], number[self.group[p]], self.cell[p],
                        self.low[p], self.weight[p])

    def down(self, grid: Grid, level: int, least: np.ndarray) -> Frontier:
        """Both halves of every range; only those that may reach ``least`` of their item."""
        at = self.cell * grid.width(level)
        if level < grid.both:
            at = at + 2 * (self.low >> (grid.both - 1 - level) & 1)
        bits, ranks, tops = grid.bits[level], grid.ranks[level], grid.tops[level + 1]
        halves = [np.flatnonzero(bits[at + h]) for h in (0, 1)]
        cell = np.concatenate([ranks[at[p] + h] - 1 for h, p in enumerate(halves)])
        group = np.concatenate([2 * self.group[p] + h for h, p in enumerate(halves)])
        low, weight = (np.concatenate([x[p] for p in halves]) for x in (self.low, self.weight))
        bound = _sums(group, weight * tops[cell], 2 * len(self.item))
        span = np.repeat(2 * self.span, 2)
        span[1::2] += 1
        out = Frontier(np.repeat(self.item, 2), span, bound, group, cell, low, weight)
        return out.chosen(bound >= least[out.item])


class Best:
    """The best documents of each item of a block, over the shards of a task."""

    def __init__(self, block: list[dict], top: int) -> None:
        self.ids, self.top = [r["item_id"] for r in block], top
        vocabulary = pa.array([t for r in block for t in r["terms"]], pa.string()).dictionary_encode()
        self.vocabulary, self.code = vocabulary.dictionary, vocabulary.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.item = np.repeat(np.arange(len(block)), [len(r["terms"]) for r in block])
        self.weight = np.array([w for r in block for w in r["weights"]], np.int64)
        self.rows = np.zeros((4, 0), np.int64)  # item, score, NULL id, id
        self.least = np.ones(len(block), np.int64)  # a score that a document has to reach

    def add(self, item: np.ndarray, score: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        rows = np.concatenate([self.rows, np.stack([item, score, null, doc])], axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        first = np.searchsorted(rows[0], np.arange(len(self.ids)))
        place = np.arange(rows.shape[1]) - first[rows[0]]
        self.rows = rows[:, place < self.top]
        last = place == self.top - 1
        self.least[rows[0][last]] = rows[1][last]

    def search(self, ids: pa.Array, words: pa.Array, grid: Grid) -> None:
        row = pc.fill_null(pc.index_in(self.vocabulary, words), -1).to_numpy(zero_copy_only=False).astype(np.int64)[self.code]
        known = np.flatnonzero((row >= 0) & (self.weight > 0))
        if not len(known):
            return
        row, weight = row[known], self.weight[known]
        asked, group = np.unique(self.item[known], return_inverse=True)
        null = pc.is_null(ids).to_numpy(zero_copy_only=False).astype(np.int64)
        value = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        cell = row >> grid.both
        front = Frontier(asked, np.zeros(len(asked), np.int64), _sums(group, weight * grid.tops[0][cell], len(asked)),
                         group, cell, row & ((1 << grid.both) - 1), weight)
        ordered = max(0, grid.levels - RANGE)
        for level in range(ordered):
            front = front.down(grid, level, self.least)
        place = np.empty(len(front.item), np.int64)
        by = np.lexsort((-front.bound, front.item))
        item = front.item[by]
        place[by] = np.arange(len(by)) - np.searchsorted(item, item)
        a, batch = 0, 2
        while True:
            open_ = (place >= a) & (front.bound >= self.least[front.item])
            if not open_.any():
                return
            now = front.chosen(open_ & (place < a + batch))
            for level in range(ordered, grid.levels):
                now = now.down(grid, level, self.least)
            if len(now.item):
                self.add(now.item, now.bound, null[now.span], value[now.span])
            a, batch = a + batch, 2 * batch

    def found(self) -> pa.RecordBatch:
        item, score, null, doc = self.rows
        return pa.RecordBatch.from_arrays([
            pa.array(self.ids, pa.int64()).take(pa.array(item)), pa.array(doc, mask=null.astype(bool)), pa.array(score)],
            ["item_id", "doc_id", "score"])


def statistics(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all terms with repeats."""
    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = TABLE != 0x20
        docs = many = 0
        for batch in batches:
            for part in slices(batch, "text"):
                texts = fresh(part["text"])
                _, offsets, data = texts.buffers()
                at = np.frombuffer(offsets, np.int64)
                term = inside[np.frombuffer(data, np.uint8)] if data else np.zeros(0, bool)
                begins = term.copy()
                begins[1:] &= ~term[:-1]
                edge = at[:-1][at[:-1] < at[1:]]  # a text's first character
                begins[edge] = term[edge]
                upto = np.concatenate([[0], np.cumsum(begins)])[at]
                docs += int((upto[1:] > upto[:-1]).sum())
                many += int(begins.sum())
        yield pa.RecordBatch.from_pydict({"docs": [docs], "terms": [many]})

    row = docs.select("text").mapInArrow(run, "docs bigint, terms bigint").agg(F.sum("docs"), F.sum("terms")).first()
    return row[0] or 0, row[1] or 0


def write_index(docs: DataFrame, path: str, n_docs: int, n_terms: int, shard_bytes: int = SHARD_BYTES,
                shard_docs: int = SHARD_DOCS) -> None:
    """A row per shard of ``docs`` (doc_id, text) in ``path``."""
    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Postings()
        for batch in batches:
            for part in slices(batch, "text"):
                for a in range(0, part.num_rows, shard_docs):
                    piece = part.slice(a, shard_docs)
                    if held.docs and (held.size + piece["text"].nbytes > shard_bytes or held.docs + piece.num_rows > shard_docs):
                        if held.known:
                            yield held.shard(n_docs, n_terms)
                        held = Postings()
                    held.add(piece)
        if held.known:
            yield held.shard(n_docs, n_terms)

    docs.mapInArrow(run, INDEX).write.mode("overwrite").parquet(path)


def _item_terms(items: DataFrame) -> DataFrame:
    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words, codes, at = terms(part["text"])
                yield pa.RecordBatch.from_arrays([
                    part["item_id"].take(pa.array(np.repeat(np.arange(part.num_rows), np.diff(at)))),
                    words.cast(pa.string()).take(pa.array(codes))], ["item_id", "term"])

    return items.mapInArrow(run, "item_id bigint, term string").distinct()


def _blocks(spark: SparkSession, index: DataFrame, items: DataFrame, scratch: str, n_docs: int, block_terms: int) -> DataFrame:
    """block, items: (item_id, terms, weights) of the items that hash gave it."""
    _item_terms(items).write.mode("overwrite").parquet(f"{scratch}/terms")
    asked = spark.read.schema("item_id bigint, term string").parquet(f"{scratch}/terms")
    held = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).select("t.terms", "t.counts")
    counts = (held.join(asked.select(F.col("term").alias("terms")).distinct(), "terms")
              .groupBy(F.col("terms").alias("term")).agg(F.sum("counts").alias("df")))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    weighed = asked.join(counts, "term").select("item_id", F.struct("term", weight.alias("weight")).alias("t"))
    blocks = -(-asked.count() // block_terms) or 1
    return (weighed.groupBy("item_id").agg(F.collect_list("t").alias("t"))
            .select(F.pmod(F.xxhash64("item_id"), F.lit(blocks)).alias("block"),
                    F.struct("item_id", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights")).alias("item"))
            .groupBy("block").agg(F.collect_list("item").alias("items")))


def _met(spark: SparkSession, index: DataFrame, blocks: DataFrame, path: str) -> DataFrame:
    """Every shard with every block."""
    blocks.write.mode("overwrite").parquet(path)
    blocks = spark.read.schema(blocks.schema).parquet(path)
    size = F.transform("items", lambda i: F.aggregate(i["terms"], F.lit(0), lambda n, t: n + F.octet_length(t) + 16))
    many, held = blocks.agg(F.max("block"), F.sum(F.aggregate(size, F.lit(0).cast("long"), lambda n, x: n + x))).first()
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many or 0).cast("long"))))
    if (held or 0) <= MOST_BROADCAST:
        return spread.join(F.broadcast(blocks), "block")
    salted = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return spread.withColumn("salt", F.pmod(F.xxhash64("doc_ids"), F.lit(SALTS)).cast("int")).join(salted, ["block", "salt"])


def ranked(spark: SparkSession, docs: DataFrame, items: DataFrame, scratch: str, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text", top: int = TOP, shard_bytes: int = SHARD_BYTES,
           shard_docs: int = SHARD_DOCS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each item with a score above 0."""
    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    asked = items.select(F.col(item_key).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    n_docs, n_terms = statistics(plain)
    write_index(plain, f"{scratch}/index", n_docs, n_terms, shard_bytes, shard_docs)
    index = spark.read.schema(INDEX).parquet(f"{scratch}/index")

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Best] = {}
        for batch in batches:
            blocks = batch["block"].to_numpy()
            for i in np.argsort(blocks, kind="stable").tolist():
                row, number = batch.slice(i, 1), int(blocks[i])
                if number not in held:
                    if len(held) == HELD_BLOCKS:
                        yield held.pop(next(iter(held))).found()
                    held[number] = Best(row["items"][0].as_py(), top)
                ids = row["doc_ids"].flatten()
                held[number].search(ids, row["terms"].flatten(), Grid(
                    len(ids), row["roots"][0].as_py(), row["children"][0].as_py(), row["short"][0].as_py()))
        for best in held.values():
            yield best.found()

    met = _met(spark, index, _blocks(spark, index, asked, scratch, n_docs, block_terms), f"{scratch}/blocks")
    found = (met.select("block", "items", "doc_ids", "terms", "roots", "children", "short")
             .mapInArrow(run, "item_id bigint, doc_id bigint, score bigint"))
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", place).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
