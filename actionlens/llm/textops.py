"""Vectorised text helpers shared by the operators (numpy over Arrow batches).

All of them work on the UTF-8 bytes of an Arrow string column, so no Python
object is made per word: a batch of texts is one byte buffer with document
offsets, words are start/end positions in it, and a word is known by a 64-bit
hash.  White space is the six bytes 0x20 and 0x09-0x0D throughout.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 2 << 20      # text handled at once; one longer document is handled alone
LONG_WORD = 64             # longer words are hashed one by one

try:
    _libc = ctypes.CDLL("libc.so.6")
    _libc.malloc_trim
except (OSError, AttributeError):       # another C library: it has no such call
    _libc = None
_rng = np.random.Generator(np.random.PCG64(20240131))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_MULT = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def slices(text: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about ``limit`` bytes of text; null counts as empty."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    text = text.cast(pa.large_binary()) if not pa.types.is_large_binary(text.type) else text
    if text.null_count:
        text = text.fill_null(b"")
    if not len(text):
        return
    off = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = text.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < len(text):
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, b, buf[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b
    give_back()


def give_back() -> None:
    """Returns freed memory to the system: a worker lives on between tasks, and what it once needed would stay its own."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def lowered(buf: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all other bytes as they are."""
    return _LOWER[buf]


def segments(is_gap: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the maximal runs without a gap; a run ends with its document."""
    n = len(is_gap)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~is_gap
    first = inside.copy()
    first[1:] &= is_gap[:-1]
    cut = off[1:-1]
    cut = cut[cut < n]
    first[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= is_gap[1:]
    cut = off[1:-1]
    cut = cut[cut > 0] - 1
    last[cut] = inside[cut]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return segments(_SPACE[buf], off)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: spreads every input bit over the 64 bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every span; equal bytes give equal hashes in every batch and job."""
    length = end - start
    out = np.zeros(len(start), np.uint64)
    short = np.minimum(length, LONG_WORD + 1).astype(np.uint8)
    order = np.argsort(short, kind="stable")[::-1]
    counts = np.bincount(short, minlength=LONG_WORD + 2)
    n_long = int(counts[LONG_WORD + 1])
    for i in order[:n_long]:
        out[i] = xxhash.xxh3_64_intdigest(buf[start[i]:end[i]].tobytes())
    order = order[n_long:]
    at, h = start[order], np.zeros(len(order), np.uint64)
    more = len(order) - np.cumsum(counts[:LONG_WORD + 1])      # spans longer than j
    for j in range(LONG_WORD):
        m = int(more[j])
        if not m:
            break
        h[:m] = h[:m] * _MULT + _BYTE[buf[at[:m] + j]]
    out[order] = h
    return mix(out + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_hash(word: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every k-word window inside a document; a document of fewer than k words gives its whole sequence."""
    n = len(word)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    factor = [mix(np.array([j + 1], np.uint64))[0] | np.uint64(1) for j in range(k)]
    h = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k if len(h) else 0):
        h += word[j:j + len(h)] * factor[j]
    whole = row[:len(h)] == row[k - 1:k - 1 + len(h)] if len(h) else np.zeros(0, bool)
    hs, rs = mix(h[whole]), row[:len(h)][whole]
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    size = np.diff(np.r_[first, n])
    few = first[size < k]
    if len(few):
        extra = []
        for f, m in zip(few, size[size < k]):
            e = np.uint64(0)
            with np.errstate(over="ignore"):
                for j in range(int(m)):
                    e += word[f + j] * factor[j]
                e += np.uint64(m) * np.uint64(0xA24BAED4963EE407)
            extra.append(e)
        hs = np.r_[hs, mix(np.array(extra, np.uint64))]
        rs = np.r_[rs, row[few]]
        order = np.argsort(rs, kind="stable")
        hs, rs = hs[order], rs[order]
    return hs, rs


def distinct_per_row(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash), sorted by both."""
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    if len(h):
        keep = np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])]
        h, row = h[keep], row[keep]
    return h, row
