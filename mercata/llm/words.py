"""Words of Arrow text columns: runs of characters other than 0x20 and 0x09-0x0D."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Fixed odd multipliers of the hashes.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def fresh(texts: pa.Array) -> pa.Array:
    """The texts of a slice as an array that begins at 0 (string functions of Arrow misread
    slices of large columns); NULL, which holds no bytes, is empty."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    data = (data or pa.py_buffer(b"")).slice(int(at[0]), int(at[-1] - at[0]))
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(at - at[0]), data)


def split(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words (distinct before ``lower``), a code into them for each word, and where each text's words begin (one
    entry more than texts). NULL has no words; ``lower`` maps A-Z to a-z."""
    listed = pc.ascii_split_whitespace(fresh(texts))
    flat = listed.flatten()
    keep = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(listed).to_numpy(zero_copy_only=False))]).astype(np.int64)
    kept = np.concatenate([[0], np.cumsum(keep)])
    coded = flat.filter(pa.array(keep)).dictionary_encode()
    return pc.ascii_lower(coded.dictionary) if lower else coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), kept[bounds]


def hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each distinct word."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words.to_pylist()), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """The hash spread over all bits."""
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * FACTORS[3]
    return x ^ (x >> np.uint64(29))


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def frees(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """The same function of a task, which at its end gives free memory back to the system: a worker
    that waits for its next task else keeps what its last one needed most."""
    @functools.wraps(run)
    def inner(*args: object) -> Iterator:
        yield from run(*args)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # other C libraries have no such call
            pass
    return inner
