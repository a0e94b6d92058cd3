"""Near copies by HyperMinHash sketches of word shingles, confirmed on full sets.

1. Every document gives its set of shingle hashes and a sketch of it, 256 registers: a hash falls
   in a bucket by its first bits, and for the least hash of each bucket a byte holds its leading
   zeros (up to 14, plus one; an empty bucket is 0) and the four bits after the first one. Small
   sets fill fewer buckets (1, 4, 16, 64; at least 3 hashes for each), so as many hash functions
   are used as give 256 registers; a set near a bound of sizes has a sketch for both sides of it.
   Equal sets are one row from here on.
2. Bands of 6 registers are hashed; an empty band is none. Two sets at the threshold differ in all
   42 bands with a chance of 2e-9, closer ones with less. Each row is tied to the least row of each
   of its bands, never to all of them, and the ties' components are groups: all rows that share a
   band are in one group, whatever the band's size.
3. A group of one block (BLOCK_ROWS rows, BLOCK_BYTES bytes of sets) is searched in one task. A
   larger one is dealt to such blocks, and its least row, sent to each, is compared with all rows:
   most near copies of one text are linked by that. Rows that are not linked to it meet all blocks
   of the group, pair of blocks by pair of blocks, one task each.
4. Pairs are compared by their registers first: the share of equal ones less what chance gives
   sets of these sizes (cells of a register, by the exact probability of each) estimates the
   similarity, and only pairs whose estimate is no more than SIGMAS standard errors below the
   threshold are confirmed on full sets, and none of rows already connected in that task. A task
   sends a forest of its links. The links' components are the answer.

Nothing is capped: work inside a group whose rows are not linked to its least row grows with their
number times the group's rows, spread over pairs of blocks, by comparisons of 256 bytes; what is
sent grows with that number times blocks. Rows are told apart by 64 bits of a hash and their size,
shingles by 64 bits.

NULL, empty and blank texts have no set and no links. With fewer words than n the whole sequence is
the only shingle. Repeated rows and copies get the same component. A document without an id links
others like any; where all of a component lack one, its id is NULL and all are kept. An empty table
gives no rows. Texts of any length are read whole; a task holds a slice of 4 MB or one text, and two
blocks or two sets. Only the columns named are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.llm.components import components
from mercata.llm.jaccard import row_of, sets
from mercata.llm.tokens import slices
from mercata.llm.words import FACTORS, frees, mixed

N = 3
LEAST = 85  # percent
LEVELS = 4
BUCKETS = REGISTERS = 4 ** LEVELS
LOAD = 3
BAND = 6
ZEROS = 14
SIGMAS = 6.5
BLOCK_ROWS = 256
BLOCK_BYTES = 8 << 20
SKETCHES = "array<struct<level: int, registers: binary>>"
ROWS = f"doc_id bigint, content bigint, row bigint, size int, sketches {SKETCHES}"
SEEDS = mixed(np.arange(1, REGISTERS + 1, dtype=np.uint64) * FACTORS[0])
KIND = pa.list_(pa.struct([("level", pa.int32()), ("registers", pa.binary())]))
FIRST = "a bigint, b bigint, label bigint, row bigint, linked boolean, grams binary"
# Bounds of a register's cells in the unit interval: the last zeros, then 16 cells for each count.
CELLS = np.array([0.0] + [2.0 ** -(z + 1) * (1 + j / 16) for z in range(ZEROS - 1, -1, -1) for j in range(16)] + [1.0])


def _codes(values: np.ndarray) -> np.ndarray:
    """Registers of least hashes, given from their highest bit on."""
    zeros = 53 - np.frexp((values >> np.uint64(11)).astype(np.float64))[1]
    rest = (values << np.minimum(zeros + 1, 63).astype(np.uint64)) >> np.uint64(60)
    return np.where(zeros < ZEROS, (zeros + 1) * 16 + rest.astype(np.int64), (ZEROS + 1) * 16).astype(np.uint8)


def registers(grams: list[np.ndarray], level: int = LEVELS) -> np.ndarray:
    """A row of bytes for each sorted set of hashes: 4 ** level buckets for each of as many hash
    functions as make 256 registers. The first function is the hash itself."""
    buckets, bits = 4 ** level, np.uint64(2 * level)
    out = np.zeros((len(grams), REGISTERS // buckets, buckets), np.uint8)
    for a in range(0, len(grams), 4096):
        part = grams[a:a + 4096]
        flat = np.concatenate([np.zeros(0, np.uint64), *part])
        row = np.repeat(np.arange(len(part), dtype=np.uint64), [len(g) for g in part])
        starts = np.flatnonzero(np.diff(row, prepend=np.uint64(1 << 20)))
        for k in range(out.shape[1] if len(flat) else 0):
            own = mixed(flat ^ SEEDS[k]) if k else flat
            if level == 0:
                out[a + row[starts].astype(np.int64), k, 0] = _codes(np.minimum.reduceat(own, starts))
                continue
            at = row
            if k:  # by row, then by hash
                own = np.sort(row << np.uint64(52) | own >> np.uint64(12))
                at, own = own >> np.uint64(52), own << np.uint64(12)
            place = (at << bits | own >> (np.uint64(64) - bits)).astype(np.int64)
            first = np.flatnonzero(np.diff(place, prepend=-1))
            where = place[first]
            out[a + where // buckets, k, where % buckets] = _codes(own[first] << bits)
    return out.reshape(len(grams), REGISTERS)


def level_of(size: np.ndarray) -> np.ndarray:
    """The most buckets, as a power of 4, that LOAD hashes each can fill."""
    return np.searchsorted([LOAD * 4 ** k for k in range(1, LEVELS + 1)], size, "right")


def sketches(grams: list[np.ndarray], least: int) -> list[list[tuple[int, bytes]]]:
    """For each set its registers at every level that a linked set may have."""
    size = np.array([len(g) for g in grams], np.int64)
    low, high = level_of(-(-size * least // 100)), level_of(size * 100 // least)
    out: list[list[tuple[int, bytes]]] = [[] for _ in grams]
    for level in range(LEVELS + 1):
        chosen = np.flatnonzero((low <= level) & (level <= high) & (size > 0))
        for i, row in zip(chosen.tolist(), registers([grams[i] for i in chosen], level), strict=True):
            out[i].append((level, row.tobytes()))
    return out


def _shares(sizes: np.ndarray) -> np.ndarray:
    """For each size the chance of each cell to be a bucket's register."""
    upto = (1 - CELLS / BUCKETS)[None, :] ** sizes[:, None].astype(np.float64)
    return upto[:, :-1] - upto[:, 1:]


def estimates(a: np.ndarray, p: np.ndarray, b: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard similarity of all rows of registers ``a`` (of sets of sizes p) with all of ``b``, and
    its standard error at the threshold's similarity."""
    some = np.where(a > 0, a, 1)  # no register is 1, so empty ones equal nothing
    if len(a) * len(b) <= 1024:
        equal = (some[:, None, :] == b[None, :, :]).sum(axis=2)
    else:
        equal = np.zeros((len(a), len(b)), np.uint16)
        for k in range(BUCKETS):
            equal += some[:, k, None] == b[None, :, k]
    none = (a == 0).astype(np.float32) @ (b == 0).astype(np.float32).T
    either = np.maximum(BUCKETS - none, 1)
    held = 1 - (1 - 1 / BUCKETS) ** (p[:, None] + q[None, :]).astype(np.float64)
    chance = np.minimum(_shares(p) @ _shares(q).T / held, 0.99)
    return (equal / either - chance) / (1 - chance), np.sqrt(0.85 * 0.15 / either)


def likely(a: np.ndarray, p: np.ndarray, b: np.ndarray, q: np.ndarray, least: int) -> np.ndarray:
    found, error = estimates(a, p, b, q)
    near = 100 * np.minimum(p[:, None], q[None, :]) >= least * np.maximum(p[:, None], q[None, :])
    return near & (found >= least / 100 - SIGMAS * error)


def confirmed(one: np.ndarray, others: list[np.ndarray], least: int) -> np.ndarray:
    """Which sets are linked with ``one``, by their full overlaps."""
    many = np.array([len(g) for g in others])
    flat = np.concatenate(others)
    hit = one[np.minimum(np.searchsorted(one, flat), len(one) - 1)] == flat
    overlap = np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(many)[:-1]]))
    return 100 * overlap >= least * (len(one) + many - overlap)


def forest(grams: list[np.ndarray], own: int, least: int) -> list[tuple[int, int]]:
    """Links of the first ``own`` sets with all, without those that close a circle."""
    size = np.array([len(g) for g in grams], np.int64)
    sketch = registers(grams)
    near = likely(sketch[:own], size[:own], sketch, size, least)
    label, out = np.arange(len(grams)), []
    for i in range(own):
        others = np.flatnonzero(near[i] & (label != label[i]))
        others = others[others > i]
        if not len(others):
            continue
        for j in others[confirmed(grams[i], [grams[j] for j in others], least)].tolist():
            if label[j] != label[i]:
                out.append((i, j))
                label[label == label[j]] = label[i]
    return out


def sketched(docs: DataFrame, n: int, least: int) -> DataFrame:
    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                own = sets(part, n)
                yield pa.RecordBatch.from_arrays([
                    part["doc_id"], part["content"], pa.array([row_of(s) if len(s) else None for s in own], pa.int64()),
                    pa.array([len(s) for s in own], pa.int32()), pa.array(sketches(own, least), KIND)],
                    ["doc_id", "content", "row", "size", "sketches"])

    return docs.mapInArrow(run, ROWS)


def _bands(rows: DataFrame) -> DataFrame:
    """(band, row) for each band with a register."""
    cut = F.transform(F.sequence(F.lit(0), F.lit(REGISTERS // BAND - 1)),
                      lambda k: F.struct(k.alias("k"), F.col("s.registers").substr(k * BAND + 1, F.lit(BAND)).alias("part")))
    some = F.filter(cut, lambda x: x["part"] != F.lit(bytes(BAND)))
    return (rows.select("row", F.explode("sketches").alias("s")).select("row", "s.level", F.explode(some).alias("x"))
            .select(F.xxhash64("level", "x.k", "x.part").alias("band"), "row"))


def _group(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], columns: tuple[str, ...]) -> Iterator[tuple]:
    """Rows in their order, each with its key, in runs of equal keys; a row that repeats is left out."""
    last = None
    for batch in batches:
        own = [batch[c].to_pylist() for c in keys]
        rest = [batch[c] for c in columns]
        for at, key in enumerate(zip(*own, strict=True)):
            values = tuple(c[at].as_py() for c in rest)
            if (key, values[0], values[1]) != last:
                last = (key, values[0], values[1])
                yield key, values


def _first(texts: DataFrame, n: int, least: int) -> DataFrame:
    """Links of groups of one block; rows of larger ones, and whether they are linked to the least."""
    @frees
    def attach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                own = sets(part, n)
                same = [i for i, (s, r) in enumerate(zip(own, part["row"].to_pylist(), strict=True)) if len(s) and row_of(s) == r]
                kept = part.take(pa.array(same, pa.int64()))
                rows = kept["row"].to_numpy()
                blocks = mixed(rows.view(np.uint64)) % kept["blocks"].to_numpy().astype(np.uint64)
                yield pa.RecordBatch.from_arrays([
                    kept["label"], kept["row"], kept["blocks"], pa.array(blocks.astype(np.int32)),
                    pa.array([own[i].tobytes() for i in same], pa.binary())], ["label", "row", "blocks", "block", "grams"])

    @frees
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(found: list[tuple[int, int]]) -> pa.RecordBatch:
            a, b = zip(*found, strict=True) if found else ((), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), *(pa.nulls(len(a), t) for t in (
                    pa.int64(), pa.int64(), pa.bool_(), pa.binary()))], ["a", "b", "label", "row", "linked", "grams"])

        def whole() -> pa.RecordBatch:
            return links([(held[i][0], held[j][0]) for i, j in forest([g for _, g in held], len(held), least)])

        def dealt() -> pa.RecordBatch:
            """The held rows of a block against the group's least row."""
            names, grams = [r for r, _ in held], [g for _, g in held]
            sizes = np.array([len(g) for g in grams], np.int64)
            near = likely(registers([pivot]), np.array([len(pivot)]), registers(grams), sizes, least)[0]
            linked = near.copy()
            if near.any():
                linked[near] = confirmed(pivot, [grams[i] for i in np.flatnonzero(near)], least)
            return pa.RecordBatch.from_arrays([
                *(pa.array([x if y else None for x, y in zip(v, linked, strict=True)], pa.int64())
                  for v in (names, [key[0]] * len(names))), pa.array([key[0]] * len(names), pa.int64()),
                pa.array(names, pa.int64()), pa.array(linked), pa.array([g.tobytes() for g in grams], pa.binary())],
                ["a", "b", "label", "row", "linked", "grams"])

        key, held, pivot, size = None, [], None, 0
        for now, (turn, row, blocks, grams) in _group(batches, ("label", "block"), ("turn", "row", "blocks", "grams")):
            if now != key or size > BLOCK_BYTES and pivot is not None:
                if held:
                    yield whole() if pivot is None else dealt()
                held, size = [], 0
                pivot, key = (pivot if now == key else None), now
            grams = np.frombuffer(grams, np.uint64)
            if turn == 0:
                pivot = grams
            else:
                held.append((row, grams))
                size += grams.nbytes
        if held:
            yield whole() if pivot is None else dealt()

    # The least row goes to all blocks of a large group, before their rows; as a row it stays in its own.
    sent = F.when((F.col("row") == F.col("label")) & (F.col("blocks") > 1), F.concat(
        F.array(F.struct(F.lit(1).alias("turn"), F.col("block"))),
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.lit(0).alias("turn"), k.alias("block"))))
    ).otherwise(F.array(F.struct(F.lit(1).alias("turn"), F.col("block"))))
    return (texts.mapInArrow(attach, "label bigint, row bigint, blocks int, block int, grams binary")
            .withColumn("to", F.explode(sent)).select("label", "to.block", "to.turn", "row", "blocks", "grams")
            .repartition("label", "block").sortWithinPartitions("label", "block", "turn", "row")
            .mapInArrow(search, FIRST))


def _blocks(rows: str, size: str, most: int) -> F.Column:
    return F.greatest(F.ceil(F.col(rows) / most), F.ceil(F.col(size) / BLOCK_BYTES)).cast("int")


def _rest(spark: SparkSession, large: DataFrame, scratch: str, least: int, most: int) -> DataFrame:
    """Links of rows that are not linked to the least row of their large group."""
    count = lambda c: F.count(F.when(c, 1))
    held = lambda c: F.coalesce(F.sum(F.when(c, F.octet_length("grams"))), F.lit(0))
    (large.groupBy("label").agg(count(~F.col("linked")).alias("open"), held(~F.col("linked")).alias("x"),
                                count(F.col("linked")).alias("done"), held(F.col("linked")).alias("y"))
     .where("open > 0").select("label", _blocks("open", "x", most).alias("n_open"), _blocks("done", "y", most).alias("n_done"))
     .write.mode("overwrite").parquet(f"{scratch}/open"))
    groups = spark.read.schema("label bigint, n_open int, n_done int").parquet(f"{scratch}/open")

    @frees
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            own = len(held) if key[1] == key[2] else sum(t == 0 for t, _, _ in held)
            found = forest([g for _, _, g in held], own, least)
            return pa.RecordBatch.from_arrays([pa.array([held[i][1] for i, _ in found], pa.int64()),
                                               pa.array([held[j][1] for _, j in found], pa.int64())], ["a", "b"])

        key, held = None, []
        for now, (turn, row, grams) in _group(batches, ("label", "i", "j"), ("turn", "row", "grams")):
            if now != key:
                if len(held) > 1:
                    yield done()
                key, held = now, []
            held.append((turn, row, np.frombuffer(grams, np.uint64)))
        if len(held) > 1:
            yield done()

    # Open rows are in the first blocks and meet all, the others meet the open ones.
    own = F.when(F.col("linked"), F.col("n_open") + F.pmod(F.xxhash64("row"), F.greatest("n_done", F.lit(1)))).otherwise(
        F.pmod(F.xxhash64("row"), F.col("n_open"))).cast("int")
    met = F.when(F.col("linked"), F.col("n_open")).otherwise(F.col("n_open") + F.col("n_done"))
    return (large.join(groups, "label").withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), met - 1)))
            .select("label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                    (F.col("own") > F.col("other")).cast("int").alias("turn"), "row", "grams")
            .repartition("label", "i", "j").sortWithinPartitions("label", "i", "j", "turn", "row")
            .mapInArrow(compare, "a bigint, b bigint"))


def linked(spark: SparkSession, docs: DataFrame, scratch: str, key: str = "doc_id", text: str = "text", n: int = N,
           least: int = LEAST, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept (it is that one)."""
    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"),
                        F.xxhash64(F.col(text)).alias("content"))
    all_rows = written(sketched(plain, n, least), "rows")
    # A row's set is read again from the text of one of its documents, with an id if one has it.
    at = F.min(F.struct(F.col("doc_id").isNull().alias("lacks"), "doc_id", "content")).alias("at")
    rows = written(all_rows.where("row IS NOT NULL").groupBy("row", "size").agg(at, F.any_value("sketches").alias("sketches"))
                   .select("row", "size", "at.doc_id", "at.content", "sketches"), "distinct")
    bands = _bands(rows)
    firsts = written(bands.groupBy("band").agg(F.min("row").alias("low"), F.max("row").alias("high")).where("low <> high")
                     .select("band", "low"), "bands")
    ties = bands.join(firsts, "band").where("row <> low").select(F.col("row").alias("a"), F.col("low").alias("b"))
    labels = written(components(spark, ties, f"{scratch}/groups"), "labels").withColumnRenamed("node", "row")
    members = written(rows.select("row", "size", "doc_id", "content").join(labels, "row"), "members")
    groups = written(members.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.col("size").cast("long") * 8).alias("bytes"))
                     .select("label", _blocks("n", "bytes", block_rows).alias("blocks")), "sizes")
    chosen = (members.join(groups, "label")
              .select("row", "label", "blocks", F.col("doc_id").alias("__doc"), F.col("content").alias("__content")))
    texts = (plain.join(chosen, (F.col("content") == F.col("__content")) & (F.col("doc_id").eqNullSafe(F.col("__doc"))))
             .select("text", "row", "label", "blocks"))
    first = written(_first(texts, n, least), "first")
    large = first.where("label IS NOT NULL").select("label", "row", "linked", "grams")
    links = first.where("a IS NOT NULL").select("a", "b").unionByName(_rest(spark, large, scratch, least, block_rows))
    found = written(components(spark, links, f"{scratch}/links"), "found").withColumnRenamed("node", "row")
    # Rows without links are their own component; the smallest document of all copies names it.
    named = all_rows.select("doc_id", "row", "size").join(found, "row", "left").withColumn("label", F.coalesce("label", "row"))
    names = written(named.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id")), "names")
    named = (named.join(names, "label", "left")
             .withColumn("component_id", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))))
    return named.select("doc_id", F.col("size").cast("long").alias("n_shingles"), "component_id",
                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
