"""Token ids in files, packed by a range asymmetric numeral system with fixed frequencies.

One table of frequencies, counted over all ids, serves all blocks. A block holds whole documents
and is coded alone: its ids go round robin to up to 4,096 interleaved states, so that one numpy
operation codes a step of all of them. The block keeps the states and the place in its words at
every CHECKPOINT-th step, from which decoding can begin as well, and a checksum of all its bytes.

File format, little endian, one Parquet row a block (part, block, start, docs, tokens, payload).
Payload: header of 8 unsigned 32-bit integers (magic, states, documents, tokens, words,
checkpoints, steps between them, 0), document ids (int64), NULL flags (uint8), lengths (uint32),
words before each checkpoint (uint32), states at each checkpoint (uint64; the first is the
start), words (uint32), checksum of all before (uint32).

Documents stand in ascending order of doc_id (NULL first), equal ids by their content. NULL texts
are empty; an empty table gives no blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.llm.tokens import binary
from mercata.llm.words import frees

MAGIC = 0x314E4152
LANES = 4096
BLOCK_TOKENS = 1 << 20
CHECKPOINT = 128
BITS = 20  # frequencies add up to 2 ** BITS
LOW = 31  # states are at least 2 ** LOW
BLOCKS = "part int, block int, start bigint, docs int, tokens bigint, payload binary"


def quantized(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Frequencies that add up to 2 ** bits, at least 1 for every id that occurs."""
    total, seen = int(counts.sum()), counts > 0
    if int(seen.sum()) > 1 << bits:
        raise ValueError("more ids than frequencies")
    out = np.zeros(len(counts), np.int64)
    if not total:
        return out
    spare = (1 << bits) - int(seen.sum())
    out[seen] = 1 + (counts[seen].astype(np.float64) * (spare / total)).astype(np.int64)
    rest = (1 << bits) - int(out.sum())  # what rounding left goes to the most frequent id
    out[int(np.argmax(counts))] += rest
    return out


class Model:
    def __init__(self, freq: np.ndarray, bits: int = BITS) -> None:
        self.bits = np.uint64(bits)
        self.freq = freq.astype(np.uint64)
        self.low = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    def encode(self, ids: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        """Lanes, words before each checkpoint, states at each, words."""
        lanes = int(min(LANES, 1 << max(0, len(ids) // 64).bit_length()))
        steps = -(-len(ids) // lanes)
        x = np.full(lanes, 1 << LOW, np.uint64)
        limit = self.freq << np.uint64(LOW + 32 - int(self.bits))
        out: list[np.ndarray] = []
        states, sizes = [], np.zeros(steps, np.int64)
        for step in range(steps - 1, -1, -1):
            s = ids[step * lanes:(step + 1) * lanes]
            y, f = x[:len(s)], self.freq[s]
            full = y >= limit[s]
            moved = y[full]
            out.append(moved.astype(np.uint32))
            sizes[step] = len(moved)
            y[full] = moved >> np.uint64(32)
            q = y // f
            y[:] = (q << self.bits) + (y - q * f) + self.low[s]
            if step % CHECKPOINT == 0:
                states.append(x.copy())
        before = np.concatenate([[0], np.cumsum(sizes)])[:-1][::CHECKPOINT]
        words = np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)
        return lanes, before.astype(np.uint32), np.array(states[::-1], np.uint64).reshape(-1, lanes), words

    def decode(self, n: int, x: np.ndarray, words: np.ndarray, step: int = 0) -> np.ndarray:
        """Ids from ``step`` on, given the states and the words from there."""
        lanes, x, at = len(x), x.copy(), 0
        out = np.empty(n - step * lanes, np.uint32)
        mask, shift = np.uint64((1 << int(self.bits)) - 1), np.uint64(32)
        for a in range(0, len(out), lanes):
            b = min(a + lanes, len(out))
            y = x[:b - a]
            slot = y & mask
            s = self.symbol[slot]
            out[a:b] = s
            y[:] = self.freq[s] * (y >> self.bits) + slot - self.low[s]
            need = np.flatnonzero(y < np.uint64(1 << LOW))
            y[need] = (y[need] << shift) | words[at:at + len(need)]
            at += len(need)
        return out


def pack_block(model: Model, doc_ids: np.ndarray, missing: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    lanes, before, states, words = model.encode(ids)
    body = b"".join([np.array([MAGIC, lanes, len(sizes), len(ids), len(words), len(before), CHECKPOINT, 0], "<u4").tobytes(),
                     doc_ids.astype("<i8").tobytes(), missing.astype("u1").tobytes(), sizes.astype("<u4").tobytes(),
                     before.astype("<u4").tobytes(), states.astype("<u8").tobytes(), words.astype("<u4").tobytes()])
    return body + np.array([zlib.crc32(body)], "<u4").tobytes()


def unpack_block(model: Model, payload: bytes, checkpoint: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, NULL flags, lengths, and the ids from a checkpoint on."""
    if zlib.crc32(payload[:-4]) != int.from_bytes(payload[-4:], "little"):
        raise ValueError("a block's checksum is wrong")
    magic, lanes, docs, n, n_words, points, every, _ = (int(v) for v in np.frombuffer(payload, "<u4", 8))
    if magic != MAGIC:
        raise ValueError("not a block of this format")
    at = 32
    out = []
    for kind, count in (("<i8", docs), ("u1", docs), ("<u4", docs), ("<u4", points), ("<u8", points * lanes), ("<u4", n_words)):
        out.append(np.frombuffer(payload, kind, count, at))
        at += out[-1].nbytes
    doc_ids, missing, sizes, before, states, words = out
    if not n:
        return doc_ids, missing, sizes, np.zeros(0, np.uint32)
    x = states.reshape(points, lanes)[checkpoint]
    return doc_ids, missing, sizes, model.decode(n, x, words[before[checkpoint]:], checkpoint * every)


def frequencies(ids: DataFrame, vocabulary: int, width: int = 2) -> np.ndarray:
    """Counts of all ids; a task sends a row per id at most, the driver gets as many."""
    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            _, offsets, data = batch["ids"].cast(pa.large_binary()).buffers()
            if data:  # the ids of all documents of the batch in a row
                at = np.frombuffer(offsets, np.int64, batch.num_rows + 1, 8 * batch["ids"].offset)
                total += np.bincount(np.frombuffer(data, np.uint8)[at[0]:at[-1]].view(f"<u{width}"), minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["id", "n"])

    rows = ids.select("ids").mapInArrow(run, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(vocabulary, np.int64)
    for r in rows:
        out[r["id"]] = r["n"]
    return out


def write(spark: SparkSession, ids: DataFrame, path: str, vocabulary: int, width: int = 2) -> None:
    """Write (doc_id, ids) below ``path``: the table of frequencies and the blocks.

    ``ids`` is read more than once (to count, to find the ranges, to code), so it should be a
    written table."""
    freq = quantized(frequencies(ids, vocabulary, width))
    spark.createDataFrame([(int(i), int(freq[i])) for i in np.flatnonzero(freq)], "id int, frequency int") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/model")

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, part = Model(freq), TaskContext.get().partitionId()
        held: list[tuple[int | None, np.ndarray]] = []
        size = block = start = 0

        def flush() -> pa.RecordBatch:
            sizes = np.array([len(x) for _, x in held], np.int64)
            payload = pack_block(model, np.array([d or 0 for d, _ in held], np.int64),
                                 np.array([d is None for d, _ in held]), sizes, np.concatenate([x for _, x in held]))
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()),
                pa.array([len(held)], pa.int32()), pa.array([int(sizes.sum())], pa.int64()),
                pa.array([payload], pa.binary())], ["part", "block", "start", "docs", "tokens", "payload"])

        for batch in batches:
            for doc, value in zip(batch["doc_id"].to_pylist(), batch["ids"], strict=True):
                one = np.frombuffer(value.as_buffer(), f"<u{width}")
                if held and size + len(one) > BLOCK_TOKENS:
                    yield flush()
                    held, start, size, block = [], start + size, 0, block + 1
                held.append((doc, one))
                size += len(one)
        if held:
            yield flush()

    (ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids").mapInArrow(run, BLOCKS)
     .write.mode("overwrite").parquet(f"{path}/blocks"))


def read(spark: SparkSession, path: str, vocabulary: int) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (unsigned 32-bit), from the files."""
    freq = np.zeros(vocabulary, np.int64)
    for r in spark.read.parquet(f"{path}/model").collect():  # as many rows as the vocabulary
        freq[r["id"]] = r["frequency"]
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # A row per written file.
    parts = sorted(blocks.groupBy("part").agg(F.sum("tokens").alias("n")).collect())
    first = dict(zip([p for p, _ in parts], np.cumsum([0] + [n for _, n in parts]).tolist(), strict=False))

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(freq)
        for batch in batches:
            for part, start, payload in zip(batch["part"].to_pylist(), batch["start"].to_pylist(), batch["payload"], strict=True):
                docs, missing, sizes, ids = unpack_block(model, payload.as_py())
                at = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs, mask=missing.astype(bool)), pa.array(at[:-1] + first[part] + start),
                    binary(ids.astype("<u4"), at)], ["doc_id", "start", "ids"])

    return blocks.select("part", "start", "payload").mapInArrow(run, "doc_id bigint, start bigint, ids binary")
