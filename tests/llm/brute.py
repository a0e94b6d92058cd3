"""Plain versions of the numbered operators, for small tables held in memory."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
                    r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def secrets(text: str | None) -> tuple[int, int, int, str]:
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    found.sort()
    return *(sum(f[1] == k for f in found) for k in range(3)), sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in found))


def substrings(docs: dict[int, str | None], size: int = 20) -> dict[int, tuple[int, int, str]]:
    words = {d: WORD.findall(t or "") for d, t in docs.items()}
    first: dict[tuple, tuple[int, int]] = {}
    for d in sorted(words):
        for s in range(len(words[d]) - size + 1):
            first.setdefault(tuple(words[d][s:s + size]), (d, s))
    out = {}
    for d, w in words.items():
        gone = set()
        for s in range(len(w) - size + 1):
            if first[tuple(w[s:s + size])] != (d, s):
                gone.update(range(s, s + size))
        out[d] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def quality(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(repeated), failed)


def jaccard(docs: dict[int, str | None], n: int = 4, least: int = 85) -> dict[int, tuple[int, int]]:
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for d, t in docs.items():
        w = WORD.findall((t or "").translate(fold))
        sets[d] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    parent = {d: d for d in docs}

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            by[g].append(d)
    shared = Counter((a, b) for ds in by.values() for a in ds for b in ds if a < b)
    for (a, b), k in shared.items():
        if 100 * k >= least * (len(sets[a]) + len(sets[b]) - k):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), root(d)) for d in docs}


def edits_within(pattern: np.ndarray, text: np.ndarray) -> int:
    """Least edits that turn the pattern into some stretch of the text."""
    best = np.zeros(len(text) + 1, np.int64)
    for r, c in enumerate(pattern, 1):
        new = np.empty_like(best)
        new[0] = r
        new[1:] = np.minimum(best[:-1] + (text != c), best[1:] + 1)
        # An insertion costs one per place to the right.
        best = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return int(best.min())
