"""Fill-in-middle texts: the middle of a document moves behind its prefix and suffix.

A text is read as a row of units by one full match of ``(unit)*`` with the regex library, which
keeps the end of every repetition: their number is n, and the two cut offsets are read from the
same list. Two hashes of the document's id choose the cuts, one says whether the text stays plain,
one the order of the parts. Nothing is random, so a task that runs again gives the same rows.

A task holds one batch of texts and the ends of one text, about 100 bytes a unit. Texts of more
than MOST characters are matched in rows of MOST units, each beginning where the last one ended,
so that memory is bounded; units must then not depend on what precedes them, as a character does
not. No shuffle, one pass.

NULL text is empty. An empty text, one that holds a mark, and one that is not a row of units
(n = 0 then) stay plain. A NULL id is hashed as no digits. Repeated rows are transformed alike,
equal texts of different ids are cut differently. An empty table gives no rows. Only the two
columns named are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.llm.tokens import slices

MARKS = ("<P>", "<S>", "<M>")  # before prefix, suffix, middle
UNIT = "(?s:.)"
PLAIN_FROM = 90  # of 100
SUFFIX_FIRST = 20  # of 100
MOST = 1_000_000
SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


class Units:
    """Where the units of a text end."""

    def __init__(self, unit: str = UNIT, most: int = MOST) -> None:
        import regex
        self.whole = regex.compile(f"({unit})*")
        self.part = regex.compile(f"({unit}){{1,{most}}}")
        self.most = most

    def ends(self, text: str) -> list[int] | np.ndarray | None:
        """None: the text is no row of units."""
        if len(text) <= self.most:
            found = self.whole.fullmatch(text)
            return found.ends(1) if found else None
        parts, at = [], 0
        while at < len(text):
            found = self.part.match(text, at)
            if not found or found.end() == at:
                return None
            parts.append(np.array(found.ends(1), np.int64))
            at = found.end()
        return np.concatenate(parts)


def check_marks(marks: tuple[str, str, str]) -> None:
    """The parts can be told apart if no mark begins with what another one ends with."""
    for a in marks:
        for b in marks:
            if not a or any(a.endswith(b[:k]) for k in range(1, len(b) + (a != b))):
                raise ValueError(f"marks overlap: {a!r} and {b!r}")


def rearranged(text: str, h: tuple[int, ...], units: Units, marks: tuple[str, str, str], plain_from: int,
               suffix_first: int) -> tuple[int, str, int | None, int | None, str]:
    """n, form, characters of prefix and of middle, output."""
    ends = units.ends(text)
    n = 0 if ends is None else len(ends)
    if not n or h[2] % 100 >= plain_from or any(m in text for m in marks):
        return n, "plain", None, None, text
    cuts = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = (int(ends[c - 1]) if c else 0 for c in cuts)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = marks
    if h[3] % 100 < suffix_first:
        return n, "spm", a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


def transformed(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = UNIT, seed: str = "1",
                marks: tuple[str, str, str] = MARKS, plain_from: int = PLAIN_FROM,
                suffix_first: int = SUFFIX_FIRST, most: int = MOST) -> DataFrame:
    """doc_id, n (units), form (plain, psm, spm), prefix_chars, middle_chars, output."""
    check_marks(marks)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    hashes = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(unit, most)
        for batch in batches:
            for part in slices(batch, "text"):
                h = zip(*(part[f"h{k}"].to_pylist() for k in range(1, 5)), strict=True)
                rows = [rearranged(t or "", x, units, marks, plain_from, suffix_first)
                        for t, x in zip(part["text"].to_pylist(), h, strict=True)]
                n, form, prefix, middle, output = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([
                    part["doc_id"], pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *hashes).mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that gave ``output``: its parts stand between marks that occur nowhere else."""
    p, s, m = marks

    def between(a: str, b: str | None) -> Column:
        first = F.instr(output, a) + len(a)
        return output.substr(first, F.instr(output, b) - first if b else F.char_length(output))

    return (F.when(form == "psm", F.concat(between(p, s), between(m, None), between(s, m)))
            .when(form == "spm", F.concat(between(p, m), between(m, None), between(s, p)))
            .otherwise(output))
