"""A compressed FM-index over integer sequences, searched backward by many queries at once.

Rows of the index are the suffixes of all sequences, ordered by their first ``depth`` symbols.
The column of preceding symbols is a wavelet matrix of packed bits. Queries are vectors, one
numpy operation moves all of them; a step costs as many bit counts as symbols have bits.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """Packed bits with a running count per 64."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros(len(bits) // 64 * 64 + 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int32)
        self.zeros = int(len(bits) - bits.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class Wavelet:
    """Counts of a symbol in a prefix: a bit per level, high bits first, zeros moved before ones."""

    def __init__(self, symbols: np.ndarray) -> None:
        self.height = max(1, int(symbols.max(initial=0)).bit_length())
        self.levels, now = [], symbols
        for shift in range(self.height - 1, -1, -1):
            bit = (now >> shift & 1).astype(np.uint8)
            self.levels.append(Bits(bit))
            now = np.concatenate([now[bit == 0], now[bit == 1]])

    def down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where place i of the first level ends up on the way down to the symbol."""
        for level, shift in zip(self.levels, range(self.height - 1, -1, -1), strict=True):
            ones = level.ones(i)
            i = np.where(symbol >> shift & 1, level.zeros + ones, i - ones)
        return i


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks of pairs of ranks."""
    a, b = keys
    return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1].astype(np.int64)


class FMIndex:
    """``codes``: symbols from 1 on, 0 after each sequence; ``value``: of each suffix, so that
    a search can tell the least value of what it found."""

    def __init__(self, codes: np.ndarray, value: np.ndarray, depth: int) -> None:
        self.depth, n = depth, len(codes)

        def ahead(rank: np.ndarray, by: int) -> np.ndarray:
            return np.concatenate([rank[by:], np.zeros(min(by, n), rank.dtype)])

        # Ranks of the first 1, 2, 4 ... symbols, put together to depth - 1 and depth.
        power, rank, ranks = 1, codes.astype(np.int64) + 1, {}
        ranks[1] = rank
        while power * 2 <= depth:
            rank = _dense(rank, ahead(rank, power)) + 1
            power *= 2
            ranks[power] = rank

        def of(length: int) -> np.ndarray:
            out, have = None, 0
            for p in sorted(ranks, reverse=True):
                while have + p <= length:
                    out = ranks[p] if out is None else _dense(out, ahead(ranks[p], have)) + 1
                    have += p
            return out

        short, full = of(depth - 1), of(depth)
        order = np.argsort(full, kind="stable")
        self.last = Wavelet(np.concatenate([codes[-1:], codes[:-1]])[order])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(codes))]).astype(np.int64)  # rows before a symbol's
        self.base = self.last.down(np.arange(int(codes.max(initial=0)) + 1), np.zeros(int(codes.max(initial=0)) + 1, np.int64))
        self.rows = n

        def groups(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            start = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]]))
            size = np.diff(np.append(start, n))
            return np.repeat(start, size), np.repeat(start + size, size)

        self.low, self.high = groups(short[order])  # rows that share depth - 1 symbols with a row
        start = np.flatnonzero(np.concatenate([[True], np.diff(full[order]) != 0]))
        self.least = np.repeat(np.minimum.reduceat(value[order], start), np.diff(np.append(start, n)))

    def back(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that begin with the symbol and go on like the rows [low, high)."""
        move = self.first[symbol] - self.base[symbol]
        return self.last.down(symbol, low) + move, self.last.down(symbol, high) + move

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of each query (one a line, at most ``depth`` symbols); 0 is no symbol of theirs."""
        low = np.zeros(len(queries), np.int64)
        high = np.full(len(queries), self.rows, np.int64)
        for k in range(queries.shape[1] - 1, -1, -1):
            low, high = self.back(queries[:, k], low, high)
        return low, np.maximum(low, high)

    def statistics(self, lines: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Matching statistics of sequences that the index holds, cut at ``depth``: for each place
        the least value among suffixes that share ``depth`` symbols with what begins there, or the
        greatest int64 if fewer are left. ``lines`` are the sequences, aligned to the right."""
        never = np.iinfo(np.int64).max
        n, width = lines.shape
        out = np.full((n, width), never, np.int64)
        low, high = np.zeros(n, np.int64), np.full(n, self.rows, np.int64)
        for taken in range(1, width + 1):
            k = width - taken
            live = np.flatnonzero(sizes >= taken)
            if not len(live):
                break
            if taken > self.depth:  # let go of the last symbol: all rows with the same depth - 1
                row = low[live]
                low[live], high[live] = self.low[row], self.high[row]
            low[live], high[live] = self.back(lines[live, k], low[live], high[live])
            if taken >= self.depth:
                out[live, k] = self.least[low[live]]
        return out
