"""Token sequences of fixed length, packed in one pass with a fixed number of open windows.

Every input split is packed alone and in its order. A document's full lengths of ids are
sequences of their own; the rest goes to the open window that it fits best. Where none fits, the
fullest is topped up with the beginning of the rest, emitted, and replaced by an empty window
that takes the remainder. At the end of a split the open windows are merged to full sequences and
one part of a sequence; those parts, at most one a split, are merged again in groups of splits,
and what is left is cut at powers of two, where sequences need no padding. So nothing is padded,
and a task holds the open windows only.

NULL texts are empty (they still have the end id). Repeated rows are packed each; no key moves
rows, so there are no hot keys. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.llm.tokens import encoder, slices
from mercata.llm.words import frees

LENGTH = 4096
OPEN = 32
GROUP = 64  # splits whose last parts are merged together
PIECES = ("doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, ids binary")
STAGED = PIECES + ", part int, left boolean"

Piece = tuple[int | None, int, int, bytes]  # document, start, its tokens, ids


class Windows:
    """Open windows of one split; ``full`` gets the pieces of each sequence that is done."""

    def __init__(self, length: int, count: int) -> None:
        self.length, self.count = length, count
        self.windows: list[list[Piece]] = []
        self.free: list[int] = []
        self.full: list[list[Piece]] = []

    def put(self, piece: Piece) -> None:
        size = len(piece[3]) // 4
        fits = [(f, i) for i, f in enumerate(self.free) if f >= size]
        if fits:
            i = min(fits)[1]
        elif len(self.free) < self.count:
            self.windows.append([])
            self.free.append(self.length)
            i = len(self.free) - 1
        else:
            i = min(range(len(self.free)), key=self.free.__getitem__)
            gap = self.free[i]
            head, piece = cut(piece, gap)
            self.full.append(self.windows[i] + [head])
            self.windows[i], self.free[i] = [], self.length
            size -= gap
        self.windows[i].append(piece)
        self.free[i] -= size
        if not self.free[i]:
            self.full.append(self.windows.pop(i))
            self.free.pop(i)


def cut(piece: Piece, n: int) -> tuple[Piece, Piece]:
    doc, start, total, ids = piece
    return (doc, start, total, ids[:4 * n]), (doc, start + n, total, ids[4 * n:])


def refill(pieces: list[Piece], sizes: Iterator[int]) -> list[list[Piece]]:
    """Pieces in a row, dealt to sequences of the given sizes."""
    out: list[list[Piece]] = []
    line = pieces[::-1]
    for size in sizes:
        out.append([])
        while size:
            piece = line.pop()
            n = len(piece[3]) // 4
            if n > size:
                piece, rest = cut(piece, size)
                line.append(rest)
                n = size
            out[-1].append(piece)
            size -= n
    return out


def _rows(sequences: list[list[Piece]], first: int, part: int, left: bool) -> pa.RecordBatch:
    rows = []
    for k, pieces in enumerate(sequences):
        at = 0
        for doc, start, total, ids in pieces:
            n = len(ids) // 4
            rows.append((doc, start, n, total, first + k, at, ids, part, left))
            at += n
    kinds = (pa.int64(),) * 6 + (pa.binary(), pa.int32(), pa.bool_())
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids", "part", "left"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
        zip(*rows, strict=True) if rows else [()] * len(names), kinds, strict=True)], names)


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, scratch: str, end: int | None = 2,
         length: int = LENGTH, windows: int = OPEN, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens, sequence_id, offset, ids (unsigned 32-bit).

    ``scratch`` is a shared folder for the pieces of the first pass."""
    columns = [c.split()[0] for c in PIECES.split(", ")]

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part = encoder(tokenizer), TaskContext.get().partitionId()
        state, done = Windows(length, windows), 0
        for batch in batches:
            for some in slices(batch, "text"):
                ids, at = tool.encode(some["text"], end)
                for i, doc in enumerate(some["doc_id"].to_pylist()):
                    own = ids[at[i]:at[i + 1]].astype("<u4")
                    whole = len(own) // length * length
                    for a in range(0, whole, length):
                        state.full.append([(doc, a, len(own), own[a:a + length].tobytes())])
                    if len(own) > whole:
                        state.put((doc, whole, len(own), own[whole:].tobytes()))
                yield _rows(state.full, (part << 32) + done, part, False)
                done += len(state.full)
                state.full = []
        rest = [p for w in state.windows for p in w]
        total = sum(len(p[3]) // 4 for p in rest)
        merged = refill(rest, [length] * (total // length) + [total % length] * (total % length > 0))
        last = merged.pop() if total % length else []
        yield _rows(merged, (part << 32) + done, part, False)
        yield _rows([last], 0, part, True)

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("offset", "ascending")])
        pieces = list(zip(*(table[c].to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")), strict=True))
        total = sum(table["length"].to_pylist())
        sizes = [length] * (total // length) + [1 << b for b in range(length.bit_length(), -1, -1)
                                                if total % length >> b & 1]
        first = (1 << 62) + (table["group"][0].as_py() << 32)
        return pa.Table.from_batches([_rows(refill(pieces, sizes), first, 0, False)]).select(columns)

    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    plain.mapInArrow(run, STAGED).write.mode("overwrite").parquet(scratch)
    staged = spark.read.schema(STAGED).parquet(scratch)
    merged = (staged.where("left").withColumn("group", F.floor(F.col("part") / GROUP).cast("long"))
              .groupBy("group").applyInArrow(merge, PIECES))
    return staged.where("NOT left").select(columns).unionByName(merged)
