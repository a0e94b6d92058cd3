"""Benchmark passages in documents, up to a budget of edits, by the q-gram lemma.

Windows of WINDOW characters begin at every place of a benchmark item. A region of a document
that is within k edits of a window of m characters shares at least m - q + 1 - k q of its q-grams,
on diagonals (place in the document less place in the item) no further than k apart. The shortest
verbatim passage that is always found, wherever it begins, has 76 characters: WINDOW less its
edits; items shorter than a window are one. So, per task and slice of documents:

1. Places whose q-gram has a mark in a table of all benchmark q-grams are summed over every
   stretch as long as a window and its edits; stretches below the bound of the least window go.
2. The others look up their q-grams exactly. Shared q-grams are counted per item, window and
   diagonal band; bands are twice as wide as the budget needs and overlap by half, so that one of
   them holds all of a match.
3. Bands that meet the bound are verified by banded alignment, all of them in one set of numpy
   operations, which gives edits and place; matching windows of an item that touch are one region.

Characters are code points, A-Z and accented Latin letters in lower case, blanks alike. Items
shorter than q have no q-gram and are never found; NULL texts are empty. Repeated documents and
items each count. The benchmark is taken in chunks of at most CHUNK_CHARS characters; each chunk is
sent to the tasks and needs one pass over the documents. Equal texts of items are searched once and
told apart by 64 bits of a hash; longer texts are cut into parts that share all but one character of
a window, so that a window is in one part, and regions of parts that touch are put together again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercata.llm.tokens import slices
from mercata.llm.words import FACTORS, frees, mixed

Q = 12
WINDOW = 80
STRIDE = 1  # a passage may begin anywhere in an item
CHARS_PER_EDIT = 20  # a budget of 5 percent
CHUNK_CHARS = 1_000_000
SLICE = 1 << 20  # bytes of text that a task handles at once
MARK_BITS = 22
PAIRS = 1 << 20  # of a place in a text and one in an item, that are held at once
PARTS = 16  # a part of an item has at most this share of a chunk, or a window
BUCKETS = 64  # for each chunk; neighbours are put together as far as they fit
REGIONS = "doc_id bigint, doc bigint, item bigint, part int, start bigint, end bigint, edits int"


def _letters() -> np.ndarray:
    """Lower case for code points below 0x250, if it is one code point; blanks to a space."""
    table = np.arange(0x250, dtype=np.uint32)
    for c in range(0x250):
        low = chr(c).lower()
        if len(low) == 1:
            table[c] = ord(low)
    table[[9, 10, 11, 12, 13, 0xA0]] = 32
    return table


LETTERS = _letters()


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of all texts, and where each begins (one entry more)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    small = flat < len(LETTERS)
    return np.where(small, LETTERS[np.where(small, flat, 0)], flat), np.concatenate([[0], np.cumsum(sizes)])


def qgrams(flat: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q code points from each place on (places near the end wrap into nothing)."""
    n = len(flat) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # Powers of two are put together: h(a + b) = h(a) * M ** b + h(b).
    power, have, out, used = FACTORS[0], flat.astype(np.uint64), None, 0
    length, rest = 1, q
    while rest:
        if rest & 1:
            part = have[used:used + n]
            out = part.copy() if out is None else out * power + part
            used += length
        rest >>= 1
        if rest:
            have = have[:-length] * power + have[length:]
            power, length = np.uint64(int(power) ** 2 % 2**64), length * 2
    return out


def _sums(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of letters times powers before each place, and the inverse power of each place."""
    inverse = np.uint64(pow(int(FACTORS[0]), -1, 1 << 64))
    powers = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(len(flat), FACTORS[0])]))
    back = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(len(flat), inverse)]))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(flat.astype(np.uint64)) * powers[:-1])]), back


def _stretch(sums: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the letters of each stretch, wherever it stands."""
    return (sums[0][end] - sums[0][start]) * sums[1][start]


def _joined(spans: np.ndarray) -> np.ndarray:
    """Spans (two keys, start, end, edits) of one pair of keys that touch, as one."""
    if not spans.shape[1]:
        return spans
    a, b, start, end, edits = spans[:, np.lexsort((spans[3], spans[2], spans[1], spans[0]))]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    # The furthest end so far of the same keys: keys are ranked, so later ones are above all ends.
    rank, far = np.cumsum(new), int(end.max()) + 1
    upto = np.maximum.accumulate(rank * far + end) - rank * far
    new[1:] |= start[1:] > upto[:-1]
    first = np.flatnonzero(new)
    return np.stack([a[first], b[first], start[first], np.maximum.reduceat(end, first), np.maximum.reduceat(edits, first)])


@dataclass
class Index:
    """Windows and q-grams of a chunk of the benchmark."""
    q: int
    flat: np.ndarray
    item: np.ndarray  # of each window
    begin: np.ndarray
    size: np.ndarray
    grams: np.ndarray  # sorted
    place: np.ndarray  # in flat, of each
    owner: np.ndarray  # item number of each place in flat
    base: np.ndarray  # where each item begins in flat
    ids: np.ndarray
    upto: np.ndarray  # windows before each item's, one entry more
    held: np.ndarray  # items that have each window's text, windows in a row
    held_upto: np.ndarray

    @classmethod
    def of(cls, ids: list[int], texts: list[str], q: int, window: int, stride: int) -> Index:
        flat, at = characters(texts)
        begin, size, many = [np.zeros(0, np.int64)], [], np.zeros(len(ids), np.int64)
        for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
            m = min(window, b - a)
            if m < q:
                continue
            places = np.arange(a, b - m + 1, stride)
            begin.append(places if places[-1] == b - m else np.append(places, b - m))
            many[i] = len(begin[-1])
            size.append(np.full(many[i], m))
        begin, size = np.concatenate(begin), np.concatenate([np.zeros(0, np.int64), *size])
        item = np.repeat(np.arange(len(ids)), many)
        # A text that several windows have is searched once, at its first place.
        text = np.zeros(len(begin), np.uint64)
        for m in np.unique(size).tolist():
            text[size == m] = mixed(qgrams(flat, m)[begin[size == m]] + np.uint64(m * int(FACTORS[1]) % 2**64))
        _, first, same = np.unique(text, return_index=True, return_inverse=True)
        kept = np.sort(first)
        number = np.searchsorted(kept, first[same])
        pairs = np.unique(number * max(len(ids), 1) + item)
        held_upto = np.searchsorted(pairs, np.arange(len(kept) + 1) * max(len(ids), 1))
        begin, size, item = begin[kept], size[kept], item[kept]
        many = np.bincount(item, minlength=len(ids))
        owner = np.repeat(np.arange(len(ids)), np.diff(at))
        grams = qgrams(flat, q)
        inside = np.zeros(len(flat) + 1, np.int64)  # places whose q-gram is in a window that is searched
        np.add.at(inside, begin, 1)
        np.add.at(inside, begin + size - q + 1, -1)
        place = np.flatnonzero((owner[:len(grams)] == owner[q - 1:q - 1 + len(grams)]) & (np.cumsum(inside)[:len(grams)] > 0)) \
            if len(grams) else np.zeros(0, np.int64)
        order = place[np.argsort(grams[place], kind="stable")] if len(place) else place
        return cls(q, flat, item, begin, size, grams[order] if len(order) else np.zeros(0, np.uint64), order, owner, at[:-1],
                   np.array(ids, np.int64), np.concatenate([[0], np.cumsum(many)]), pairs % max(len(ids), 1), held_upto)

    def __post_init__(self) -> None:
        self.budget = np.minimum(self.size // CHARS_PER_EDIT, (self.size - self.q) // self.q)
        self.bound = self.size - self.q + 1 - self.budget * self.q
        self.mark = np.zeros(1 << MARK_BITS, bool)
        self.mark[(mixed(self.grams) >> np.uint64(64 - MARK_BITS)).astype(np.int64)] = True
        self.distinct, self.first, self.often = np.unique(self.grams, return_index=True, return_counts=True)

    def hits(self, grams: np.ndarray, reach: int) -> np.ndarray:
        """Places in stretches with enough marked q-grams whose q-gram the benchmark has."""
        marked = self.mark[(mixed(grams) >> np.uint64(64 - MARK_BITS)).astype(np.int64)]
        upto = np.concatenate([[0], np.cumsum(marked, dtype=np.int32)])
        ends = np.minimum(np.arange(len(grams)) + reach, len(grams))
        dense = np.flatnonzero(marked & (upto[ends] - upto[:-1] >= self.bound.min()))
        if not len(dense):
            return dense
        # A dense stretch begins at a marked place; all marked places within its reach belong to it.
        cover = np.zeros(len(grams) + 1, np.int32)
        np.add.at(cover, dense, 1)
        np.add.at(cover, np.minimum(dense + reach, len(grams)), -1)
        near = np.flatnonzero(marked & (np.cumsum(cover[:-1]) > 0))
        at = np.searchsorted(self.distinct, grams[near])
        at[at == len(self.distinct)] = 0
        return near[self.distinct[at] == grams[near]]

    def regions(self, flat: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item number, start, end, edits) of documents' folded code points."""
        if not len(self.size) or len(flat) < self.q:
            return []
        grams = qgrams(flat, self.q)
        text = np.repeat(np.arange(len(at) - 1), np.diff(at))[:len(grams)]
        whole = at[text + 1] - np.arange(len(grams)) >= self.q
        reach = int((self.size + 2 * self.budget).max())
        places = self.hits(np.where(whole, grams, np.uint64(0)), reach)
        places = places[whole[places]] if len(places) else places
        if not len(places):
            return []
        found = np.searchsorted(self.distinct, grams[places])
        upto = np.concatenate([[0], np.cumsum(self.often[found])])
        width = 2 * (int(self.budget.max()) + 1)
        sums = _sums(flat)
        out, a = [np.zeros((5, 0), np.int64)], 0
        # So many places at once that their pairs with places of items fit; a match that begins
        # among them ends within reach.
        while a < len(places):
            b = max(int(np.searchsorted(upto, upto[a] + PAIRS, "right")) - 1, a + 1)
            c = int(np.searchsorted(places, places[b - 1] + reach))
            out.append(self._block(flat, at, text, sums, places[a:c], found[a:c], width))
            a = b
        doc, item, start, end, edits = _joined(np.concatenate(out, axis=1))
        return list(zip(*(x.tolist() for x in (doc, item, start - at[doc], end - at[doc], edits)), strict=True))

    def _block(self, flat: np.ndarray, at: np.ndarray, text: np.ndarray, sums: tuple[np.ndarray, np.ndarray], places: np.ndarray,
               found: np.ndarray, width: int) -> np.ndarray:
        """doc, item, start, end, edits (places in ``flat``) of what bands of these places hold."""
        n = self.often[found]
        i = np.repeat(places, n)
        j = self.place[np.repeat(self.first[found] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        item, doc, diagonal = self.owner[j], text[i], i - j
        least, budget = int(self.bound.min()), int(self.budget.max())
        out = [np.zeros((5, 0), np.int64)]
        # Bands of one parity do not overlap; those of the other are moved by half a width.
        for shift in (0, width // 2):
            band = (diagonal + shift) // width
            order = np.lexsort((j, band, item, doc))
            a, b, c, d = doc[order], item[order], band[order], j[order]
            start = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])]))
            count = np.diff(np.append(start, len(a)))
            total = np.add.reduceat(d, start)
            many = (count >= least) & (self.upto[b[start] + 1] > self.upto[b[start]])
            start, count, total = start[many], count[many], total[many]
            if not len(start):
                continue
            a, b, low = a[start], b[start], c[start] * width - shift
            # Bands that meet the same text alike are looked at once, as those of a long run are.
            last = self.upto[b + 1] - 1
            first, past = self.begin[self.upto[b]] + low - budget, self.begin[last] + self.size[last] + low + width + budget
            lo, hi = np.maximum(first, at[a]), np.minimum(past, at[a + 1])
            alike = np.stack([b, lo - first, past - hi, _stretch(sums, lo, np.maximum(lo, hi)).view(np.int64), count, total])
            _, one, same = np.unique(alike, axis=1, return_index=True, return_inverse=True)
            found = self._bands(flat, at, a[one], b[one], low[one], [d[s:s + k] for s, k in zip(start[one], count[one], strict=True)], width)
            # To all bands that are like the one looked at, moved along with them.
            by = np.argsort(found[0], kind="stable")
            found = found[:, by]
            begin = np.searchsorted(found[0], np.arange(len(one) + 1))
            n_found = np.diff(begin)[same.ravel()]
            group = np.repeat(np.arange(len(a)), n_found)
            row = np.repeat(begin[:-1][same.ravel()] - (np.cumsum(n_found) - n_found), n_found) + np.arange(n_found.sum())
            moved = low[group] - low[one][found[0][row]]
            out.append(np.stack([a[group], found[1][row], found[2][row] + moved, found[3][row] + moved, found[4][row]]))
        return np.concatenate(out, axis=1)

    def _bands(self, flat: np.ndarray, at: np.ndarray, doc: np.ndarray, item: np.ndarray, low: np.ndarray,
               shared: list[np.ndarray], width: int) -> np.ndarray:
        """Number of the band, item, start, end, edits of the regions in some bands."""
        windows: list[tuple[int, int, int, int]] = []
        for g, (a, b, x, j) in enumerate(zip(doc.tolist(), item.tolist(), low.tolist(), shared, strict=True)):
            w = np.arange(self.upto[b], self.upto[b + 1])
            mine = np.unique(j)
            count = (np.searchsorted(mine, self.begin[w] + self.size[w] - self.q, "right")
                     - np.searchsorted(mine, self.begin[w]))
            w = w[count >= self.bound[w]]
            if len(w):
                w = w[self._covered(flat, int(at[a]), int(at[a + 1]), w, x, width)]
                windows += [(g, a, k, x) for k in w.tolist()]
        spans = [np.zeros((5, 0), np.int64)]
        for a in range(0, len(windows), 4096):
            band, text, k, x = (np.array(v, np.int64) for v in zip(*windows[a:a + 4096], strict=True))
            start = self._verbatim(flat, at[text], at[text + 1], k, x, width)
            edits, end = np.zeros(len(k), np.int64), start + self.size[k]
            rest = np.flatnonzero(start < 0)
            if len(rest):
                edits[rest], start[rest], end[rest] = self._align(
                    flat, at[text[rest]], at[text[rest] + 1], k[rest], x[rest], width)
            good = np.flatnonzero(edits <= self.budget[k])
            # A text that several items have is found in all of them.
            n = np.diff(self.held_upto)[k[good]]
            row = np.repeat(good, n)
            held = self.held[np.repeat(self.held_upto[k[good]] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            spans.append(np.stack([band[row], held, start[row], end[row], edits[row]]))
        return _joined(np.concatenate(spans, axis=1))

    def _covered(self, flat: np.ndarray, lo: int, hi: int, windows: np.ndarray, low: int, width: int) -> np.ndarray:
        """Which windows may be within their budget in a band. A match with k edits is k + 1 equal
        stretches at most, each on one diagonal; at most k + 1 + k characters are then not in a
        stretch of two or more."""
        cells = np.arange(width + 2 * int(self.budget.max()))
        a, b = int(self.begin[windows[0]]), int((self.begin[windows] + self.size[windows]).max())
        place = a + low - int(self.budget.max()) + cells[:, None] + np.arange(b - a)
        equal = (place >= lo) & (place < hi)
        equal &= flat[np.clip(place, 0, len(flat) - 1)] == self.flat[a:b]
        run = equal.copy()
        run[:, 1:] &= equal[:, :-1]
        run[:, 0] = False
        run[:, :-1] |= run[:, 1:]
        upto = np.concatenate([[0], np.cumsum(run.any(axis=0))])
        begin, size = self.begin[windows] - a, self.size[windows]
        return size - (upto[begin + size] - upto[begin]) <= 2 * self.budget[windows] + 1

    def _verbatim(self, flat: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: np.ndarray, low: np.ndarray, width: int) -> np.ndarray:
        """Where each window stands letter by letter on the first such diagonal of those that
        ``_align`` tries, -1 if on none."""
        budget, m = int(self.budget.max()), self.size[k]
        out = np.full(len(k), -1, np.int64)
        for c in range(width + 2 * budget):
            first = self.begin[k] + low - budget + c
            live = np.flatnonzero((out < 0) & (first >= lo) & (first + m <= hi))
            for r in range(int(m.max())):
                here = r < m[live]
                live = live[~here | (flat[np.where(here, first[live] + r, 0)] == self.flat[np.where(here, self.begin[k[live]] + r, 0)])]
                if not len(live):
                    break
            out[live] = first[live]
        return out

    def _align(self, flat: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: np.ndarray, low: np.ndarray, width: int):
        """Least edits of each window against its band of the text; where that match lies.

        Cell c of row r stands for the text up to begin + low - budget + c + r; the window has to
        be used up, the text begins and ends freely within the band."""
        budget = int(self.budget.max())
        cells = width + 2 * budget
        first = self.begin[k] + low - budget
        column = np.arange(cells)
        best = np.zeros((len(k), cells), np.int32)
        far = np.int32(1 << 20)
        place = first[:, None] + column
        best[(place < lo[:, None]) | (place > hi[:, None])] = far
        source = place.copy()
        done = np.full(len(k), far, np.int32)
        start, end = np.zeros(len(k), np.int64), np.zeros(len(k), np.int64)
        for r in range(1, int(self.size[k].max()) + 1):
            place = first[:, None] + column + r
            inside = (place > lo[:, None]) & (place <= hi[:, None])
            letter = flat[np.clip(place - 1, 0, len(flat) - 1)]
            own = self.flat[np.minimum(self.begin[k] + r - 1, len(self.flat) - 1)]
            step = np.where(inside, best + (letter != own[:, None]), far)
            down = np.concatenate([best[:, 1:] + 1, np.full((len(k), 1), far, np.int32)], axis=1)
            down[(place < lo[:, None]) | (place > hi[:, None])] = far
            take = down < step
            new = np.where(take, down, step)
            src = np.where(take, np.concatenate([source[:, 1:], source[:, -1:]], axis=1), source)
            for c in range(1, cells):
                more = (new[:, c - 1] + 1 < new[:, c]) & inside[:, c]
                new[more, c] = new[more, c - 1] + 1
                src[more, c] = src[more, c - 1]
            best, source = new, src
            last = np.flatnonzero(self.size[k] == r)
            if len(last):
                c = best[last].argmin(axis=1)
                done[last], start[last] = best[last, c], source[last, c]
                end[last] = first[last] + c + r
        return done, start, end


def regions(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
            item: str = "item_id", item_text: str = "text", q: int = Q, window: int = WINDOW,
            stride: int = STRIDE, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """doc_id, item_id, start, end (code points, end exclusive), edits (the most of a window)."""
    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    items = benchmark.select(F.col(item).cast("long").alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    items = items.where(F.char_length("text") >= q).withColumn("item", F.xxhash64("text"))
    parts, step = _parts(items, window, stride, chunk_chars)
    out = None
    for low, high in _chunks(parts, chunk_chars):
        rows = parts.where(F.col("bucket").between(low, high)).orderBy("item", "part").select("item", "part", "text").collect()
        sent = spark.sparkContext.broadcast(([(r["item"], r["part"]) for r in rows], [r["text"] for r in rows]))

        @frees
        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, texts = sent.value
            index = Index.of(list(range(len(ids))), texts, q, window, stride)
            for batch in batches:
                for part in slices(batch, "text", SLICE):
                    names, own = part["doc_id"].to_pylist(), part["text"].to_pylist()
                    flat, at = characters([t or "" for t in own])
                    found = index.regions(flat, at)
                    if found:
                        yield pa.RecordBatch.from_arrays([
                            pa.array([names[f[0]] for f in found], pa.int64()),
                            pa.array([_named(own[f[0]]) for f in found], pa.int64()),
                            pa.array([ids[f[1]][0] for f in found], pa.int64()),
                            pa.array([ids[f[1]][1] for f in found], pa.int32()),
                            pa.array([f[2] for f in found], pa.int64()), pa.array([f[3] for f in found], pa.int64()),
                            pa.array([f[4] for f in found], pa.int32())],
                            ["doc_id", "doc", "item", "part", "start", "end", "edits"])

        part = plain.mapInArrow(run, REGIONS)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], REGIONS)
    if parts.where("part > 0").limit(1).count():
        out = _whole(out, F.col("length") > window - 1 + step, items.groupBy("item").agg(F.max(F.char_length("text")).alias("length")))
    return out.join(items.select("item_id", "item"), "item").select("doc_id", "item_id", "start", "end", "edits")


def _named(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63


def _parts(items: DataFrame, window: int, stride: int, chunk_chars: int) -> tuple[DataFrame, int]:
    """(item, part, text, bucket) of distinct texts; how far the beginnings of parts are apart."""
    step = -(-max(chunk_chars // PARTS - window, window) // stride) * stride
    size = F.char_length("text")
    total = items.select("item", "text").dropDuplicates(["item"])
    at = total.select("item", "text", F.posexplode(F.sequence(F.lit(0), F.greatest(size - window, F.lit(0)), F.lit(step))))
    parts = at.select("item", F.col("pos").alias("part"),
                      F.col("text").substr(F.col("col") + 1, F.lit(step + window - 1)).alias("text"))
    chars = parts.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    buckets = BUCKETS * (-(-chars // chunk_chars) or 1)
    return parts.withColumn("bucket", F.pmod(F.xxhash64("item", "part"), F.lit(buckets))), step


def _chunks(parts: DataFrame, chunk_chars: int) -> list[tuple[int, int]]:
    """First and last bucket of each chunk; one bucket alone is chunk_chars / BUCKETS on average."""
    out, have = [], 0
    for r in parts.groupBy("bucket").agg(F.sum(F.char_length("text")).alias("chars")).orderBy("bucket").collect():
        if out and have + r["chars"] <= chunk_chars:
            out[-1], have = (out[-1][0], r["bucket"]), have + r["chars"]
        else:
            out.append((r["bucket"], r["bucket"]))
            have = r["chars"]
    return out


def _whole(found: DataFrame, cut: Column, lengths: DataFrame) -> DataFrame:
    """Regions of the parts of one item that touch as one. Copies of a document have equal regions,
    so each is counted and given as often again."""
    named = found.join(lengths, "item")
    spans = (named.where(cut).groupBy("doc_id", "doc", "item", "part", "start", "end", "edits")
             .agg(F.count("*").alias("copies")))
    upto = Window.partitionBy("doc_id", "doc", "item").orderBy("start", "end", "part")
    before = F.max("end").over(upto.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.coalesce((F.col("start") > before).cast("int"), F.lit(1)))
    spans = spans.withColumn("number", F.sum("new").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    joined = (spans.groupBy("doc_id", "doc", "item", "number")
              .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("edits").alias("edits"),
                   F.max("copies").alias("copies"))
              .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))
    columns = ["doc_id", "item", "start", "end", "edits"]
    return named.where(~cut).select(columns).unionByName(joined.select(columns))
