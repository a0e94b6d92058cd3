"""Documents linked by the Jaccard similarity of their word n-grams, as a blocked product of the
document by n-gram incidence matrix with itself.

1. Every document gives its set of n-gram hashes; documents with the same set are one row of the
   matrix. How often n-grams occur is counted in a table of hashed counters, one per 64 n-grams
   within COUNTER_BITS, which only serves to order columns: frequent ones last, else by hash.
2. Leading columns. A linked pair of rows has so large an overlap, given their sizes, that it
   shares at least SHARED of the first columns of either row (or its whole overlap, if smaller).
   The product is taken over those first: a column with up to SMALL rows adds its pairs, whose
   counts are summed, and pairs below the bound or with too different sizes are discarded. The
   rows of a column with more are only put in one group, with a link to its first row.
3. Rows connected by what is left form groups, and groups are cut into blocks of BLOCK rows. For
   each pair of blocks the whole sets are multiplied, so overlaps are exact. A pair of blocks
   sends a forest of its links, not all of them. The links' components are the answer.

Work inside a group of near copies that are not all linked grows with the square of its rows,
spread over pairs of blocks; what is sent grows with rows times blocks. Rows are told apart by 64
bits of a hash and their size, n-grams by 64 bits.

NULL, empty and blank texts have no set and no links. With fewer words than n the whole sequence
is the only n-gram. Repeated rows and copies get the same component. Only two columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.llm.components import components, dealt
from mercata.llm.tokens import slices
from mercata.llm.words import FACTORS, frees, hashes, mixed, signed, split

N = 4
LEAST = 85  # percent
SHARED = 4
SMALL = 128
BLOCK = 256
COUNTER_BITS = (22, 26)  # a byte of levels for each counter is all that is broadcast
CHUNK_BITS = 14
ROWS = "doc_id bigint, row bigint, size int, chunk int, counts binary"


def sets(part: pa.RecordBatch, n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    words, codes, at = split(part["text"], lower=True)
    w = hashes(words)[codes]
    odd = [FACTORS[i % 4] + np.uint64(2 * (i // 4)) for i in range(n + 1)]
    grams = np.zeros(max(0, len(w) - n + 1), np.uint64)
    for i in range(n):
        grams += w[i:len(w) - n + 1 + i] * odd[i] if len(grams) else 0
    grams = mixed(grams)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        elif b > a:
            whole = sum((int(x) * int(f) for x, f in zip(w[a:b], odd[1:], strict=False)), (b - a) * 0x9E37) & (2**64 - 1)
            out.append(mixed(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def row_of(grams: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(grams.tobytes())).view(np.int64))


def _plain(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))


def counter_bits(size: int) -> int:
    """For texts of so many bytes, about six a word."""
    least, most = COUNTER_BITS
    return min(max(least, (size // (6 * 64)).bit_length()), most)


def _rows(docs: DataFrame, n: int, bits: int) -> DataFrame:
    """A row per document, and per task the counters of its n-grams, cut into chunks."""
    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for part in slices(batch, "text"):
                own = sets(part, n)
                if own:
                    places, often = np.unique(np.concatenate(own) >> np.uint64(64 - bits), return_counts=True)
                    counters[places.astype(np.int64)] += often.astype(np.uint32)
                yield pa.RecordBatch.from_arrays([
                    part["doc_id"], pa.array([row_of(s) if len(s) else None for s in own], pa.int64()),
                    pa.array([len(s) for s in own], pa.int32()), pa.nulls(len(own), pa.int32()),
                    pa.nulls(len(own), pa.binary())], ["doc_id", "row", "size", "chunk", "counts"])
        chunks = counters.reshape(-1, 1 << CHUNK_BITS)
        every = np.flatnonzero(chunks.any(axis=1))
        for a in range(0, len(every), 256):
            used = every[a:a + 256]
            yield pa.RecordBatch.from_arrays([
                *(pa.nulls(len(used), k) for k in (pa.int64(), pa.int64(), pa.int32())), pa.array(used.astype(np.int32)),
                pa.array([zlib.compress(chunks[i].tobytes(), 1) for i in used], pa.binary())],
                ["doc_id", "row", "size", "chunk", "counts"])

    return docs.mapInArrow(run, ROWS)


def _levels(rows: DataFrame, bits: int) -> np.ndarray:
    """Level of each counter: 0 up to what chance gives it, then one more per quarter of an octave."""
    mean = (rows.agg(F.sum("size")).first()[0] or 0) / (1 << bits)
    base = mean + 4 * mean ** 0.5 + 4

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch["chunk"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(zlib.decompress(counts), np.uint32).astype(np.int64)
        levels = [np.clip(np.floor(4 * np.log2(np.maximum(s, 1) / base)) + 1, 0, 255).astype(np.uint8) for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                          pa.array([x.tobytes() for x in levels], pa.binary())], ["chunk", "levels"])

    out = np.zeros(1 << bits, np.uint8)
    for r in (rows.where("chunk IS NOT NULL").select("chunk", "counts").repartition("chunk")
              .mapInArrow(run, "chunk int, levels binary").collect()):  # 2 ** bits bytes
        a = r["chunk"] << CHUNK_BITS
        out[a:a + (1 << CHUNK_BITS)] = np.frombuffer(r["levels"], np.uint8)
    return out


def _leading(spark: SparkSession, docs: DataFrame, levels: np.ndarray, n: int, least: int, shared: int) -> DataFrame:
    """(gram, row, size) of each row's leading columns; copies within a task once."""
    sent, bits = spark.sparkContext.broadcast(levels), len(levels).bit_length() - 1

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = sent.value, set()
        for batch in batches:
            for part in slices(batch, "text"):
                found, names, sizes, counts = [], [], [], []
                for s in sets(part, n):
                    if not len(s) or (name := row_of(s)) in seen:
                        continue
                    seen.add(name)
                    first = min(len(s), len(s) - -(-least * len(s) // 100) + shared)
                    order = np.lexsort((s, level[(s >> np.uint64(64 - bits)).astype(np.int64)]))
                    # Within a level by other bits than those that pick the counter.
                    found.append(s[order[:first]])
                    names.append(name)
                    sizes.append(len(s))
                    counts.append(first)
                if found:
                    yield pa.RecordBatch.from_arrays([
                        signed(np.concatenate(found)), pa.array(np.repeat(np.array(names, np.int64), counts)),
                        pa.array(np.repeat(np.array(sizes, np.int32), counts))], ["gram", "row", "size"])

    return docs.mapInArrow(run, "gram bigint, row bigint, size int")


def product(grams: list[np.ndarray], own: int) -> np.ndarray:
    """Overlaps of the first ``own`` sets (rows) with all sets, column block by column block."""
    flat = np.concatenate(grams)
    row = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    _, column, often = np.unique(flat, return_inverse=True, return_counts=True)
    keep = often[column] > 1  # a column with one row adds nothing to a pair
    number = np.cumsum(often > 1) - 1
    column, row = number[column[keep]], row[keep]
    out = np.zeros((own, len(grams)), np.float32)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    step = 4096
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        i, j = np.searchsorted(column, [a, a + step])
        x = np.zeros((len(grams), step), np.float32)
        x[row[i:j], column[i:j] - a] = 1
        out += x[:own] @ x.T
    return out


def forest(names: np.ndarray, grams: list[np.ndarray], own: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a pair of blocks, as one link from each set to the least of its component."""
    if len(names) < 2:
        return names[:0], names[:0]
    size = np.array([len(g) for g in grams], np.int64)
    overlap = product(grams, own).astype(np.int64)
    link = (100 + least) * overlap >= least * (size[:own, None] + size[None, :])
    label = names.copy()
    while True:
        big = np.iinfo(np.int64).max
        top = np.where(link, label[None, :], big).min(axis=1)
        new = label.copy()
        new[:own] = np.minimum(new[:own], top)
        back = np.where(link, new[:own, None], big).min(axis=0)
        new = np.minimum(new, back)
        if (new == label).all():
            break
        label = new
    moved = label != names
    return names[moved], label[moved]


def attached(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Each row's set once, with its block; a repeated row, or another text of the same id, is left out."""
    seen: set[int] = set()
    for batch in batches:
        for part in slices(batch, "text"):
            rows, labels, owns, many, data = [], [], [], [], []
            for s, row, label, blocks in zip(sets(part, n), part["row"].to_pylist(), part["label"].to_pylist(),
                                             part["blocks"].to_pylist(), strict=True):
                if row in seen or row_of(s) != row:
                    continue
                seen.add(row)
                rows.append(row)
                labels.append(label)
                owns.append(int(mixed(np.array([row], np.int64).view(np.uint64))[0] % np.uint64(blocks)))
                many.append(blocks)
                data.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([
                pa.array(labels, pa.int64()), pa.array(owns, pa.int32()), pa.array(many, pa.int32()),
                pa.array(rows, pa.int64()), pa.array(data, pa.binary())], ["label", "own", "blocks", "row", "grams"])


def _links(members: DataFrame, docs: DataFrame, n: int, least: int, block: int) -> DataFrame:
    """Links within groups. ``members``: doc_id, row, label of the group, rows of the group."""
    @frees
    def attach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return attached(batches, n)

    @frees
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done() -> pa.RecordBatch:
            names = np.array([r for r, _, _ in held], np.int64)
            own = len(held) if key[1] == key[2] else sum(t == 0 for _, t, _ in held)
            a, b = forest(names, [np.frombuffer(g, np.uint64) for _, _, g in held], own, least)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("label", "i", "j", "turn", "row", "grams")]
            for label, i, j, turn, row, grams in zip(*columns, strict=True):
                if (label, i, j) != key:
                    if len(held) > 1:
                        yield done()
                    key, held = (label, i, j), []
                held.append((row, turn, grams))
        if len(held) > 1:
            yield done()

    texts = (docs.join(members.withColumn("blocks", F.ceil(F.col("rows") / block).cast("int"))
                       .withColumnRenamed("doc_id", "__doc"), F.col("doc_id") == F.col("__doc"))
             .select("doc_id", "text", "row", "label", "blocks"))
    # Spark sends a row to every pair of its block, one at a time.
    return (texts.mapInArrow(attach, "label bigint, own int, blocks int, row bigint, grams binary")
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                    (F.col("own") > F.col("other")).cast("int").alias("turn"), "row", "grams")
            .repartition("label", "i", "j").sortWithinPartitions("label", "i", "j", "turn", "row")
            .mapInArrow(multiply, "a bigint, b bigint"))


def linked(spark: SparkSession, docs: DataFrame, scratch: str, key: str = "doc_id", text: str = "text",
           n: int = N, least: int = LEAST, shared: int = SHARED, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    plain = _plain(docs, key, text)
    size = plain.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = counter_bits(size)
    _rows(plain, n, bits).write.mode("overwrite").parquet(f"{scratch}/rows")
    rows = spark.read.schema(ROWS).parquet(f"{scratch}/rows")
    own = rows.where("chunk IS NULL").select("doc_id", "row", "size")
    _leading(spark, plain, _levels(rows, bits), n, least, shared).write.mode("overwrite").parquet(f"{scratch}/leading")
    leading = spark.read.schema("gram bigint, row bigint, size int").parquet(f"{scratch}/leading")
    # Columns with two rows and more; copies that different tasks sent fall together here.
    many = leading.groupBy("gram").agg(F.min("row").alias("low"), F.max("row").alias("high")).where("low <> high").select("gram")
    dealt(leading, many, "gram").distinct().write.mode("overwrite").parquet(f"{scratch}/shared")
    entries = spark.read.schema("gram bigint, row bigint, size int").parquet(f"{scratch}/shared")
    counts = entries.groupBy("gram").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    hot = dealt(entries, counts.where(F.col("n") > small), "gram").select(F.col("row").alias("a"), F.col("first").alias("b"))
    few = dealt(entries, counts.where(F.col("n") <= small).select("gram"), "gram")
    least_size = lambda a, b: 100 * F.least(a, b) >= least * F.greatest(a, b)
    pairs = (few.select("gram", F.col("row").alias("a"), F.col("size").alias("p"))
             .join(few.select("gram", F.col("row").alias("b"), F.col("size").alias("q")), "gram")
             .where((F.col("a") < F.col("b")) & least_size(F.col("p"), F.col("q")))
             .groupBy("a", "b", "p", "q").agg(F.count("*").alias("overlap")))
    bound = F.least(F.lit(shared), F.ceil(least * (F.col("p") + F.col("q")) / (100 + least)))
    close = pairs.where(F.col("overlap") >= bound).select("a", "b")
    groups = components(spark, close.unionByName(hot), f"{scratch}/groups")
    groups.write.mode("overwrite").parquet(f"{scratch}/labels")
    labels = spark.read.schema("node bigint, label bigint").parquet(f"{scratch}/labels")
    # Written: a join with an aggregate in it is not split where a group holds many rows.
    labels.groupBy("label").agg(F.count("*").alias("rows")).write.mode("overwrite").parquet(f"{scratch}/sizes")
    sizes = spark.read.schema("label bigint, rows bigint").parquet(f"{scratch}/sizes")
    members = (own.where("row IS NOT NULL").groupBy("row").agg(F.min("doc_id").alias("doc_id"))
               .join(labels.withColumnRenamed("node", "row"), "row")
               .join(sizes, "label"))
    found = components(spark, _links(members, plain, n, least, block), f"{scratch}/links")
    found.write.mode("overwrite").parquet(f"{scratch}/found")
    node = spark.read.schema("node bigint, label bigint").parquet(f"{scratch}/found").withColumnRenamed("node", "row")
    # Rows without links are their own component; the smallest document of all copies names it.
    named = own.join(node, "row", "left").withColumn("label", F.coalesce("label", "row"))
    (named.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id"))
     .write.mode("overwrite").parquet(f"{scratch}/names"))
    names = spark.read.schema("label bigint, component_id bigint").parquet(f"{scratch}/names")
    return (named.join(names, "label", "left")
            .select("doc_id", F.col("size").cast("long").alias("n_shingles"),
                    F.coalesce("component_id", "doc_id").alias("component_id")))
