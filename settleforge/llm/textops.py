"""Vectorised text primitives on Arrow string buffers.

Everything here works on the UTF-8 bytes of a whole Arrow column at once, so that
no Python string is made per document or per word.  Memory is bounded by the
column handed in plus a few arrays per word.
"""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: ASCII white space: 0x20 and 0x09-0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_SPACE = ~SPACE

#: Lower-cases A-Z and nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return x


def column_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(
            [c.cast(pa.large_string()) for c in col.chunks]
        ) if col.num_chunks else pa.array([], pa.large_string())
    if col.type not in (pa.string(), pa.large_string()):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    kind = np.int64 if col.type == pa.large_string() else np.int32
    _, offsets, data = col.buffers()
    if len(col) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(offsets, dtype=kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]], off - off[0]


def spans(buf: np.ndarray, off: np.ndarray, inside: np.ndarray = NOT_SPACE):
    """Start and end of each maximal run of ``inside`` bytes within one row, and the n + 1 run offsets of the rows."""
    n = len(buf)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    mark = inside[buf]
    begins = mark.copy()
    begins[1:] &= ~mark[:-1]
    edges = off[:-1][off[:-1] < off[1:]]
    begins[edges] = mark[edges]
    ends = mark.copy()
    ends[:-1] &= ~mark[1:]
    tails = edges[1:] - 1 if len(edges) else edges
    ends[tails] = mark[tails]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, off)


#: Bits of a lane that belong to a span, by how many of its bytes do; seeds of the independent hashes.
_LANE = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 9)], dtype=np.uint64)
_SEEDS = np.array([0x3C6EF372FE94F82B, 0xA54FF53A5F1D36F1], dtype=np.uint64)
_STEP, _LENGTH = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Lanes that are hashed at a time.
_LANES = 1 << 18


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; equal bytes hash equally wherever they stand.

    A span is read in lanes of eight bytes.  Every lane is mixed with the seed and
    then with its number before the lanes are added, so no linear relation between
    texts survives.  Spans of one lane and one length never collide.  Hashes of
    different seeds are independent; two of them make 128 bits.
    """
    n = len(starts)
    size = ends - starts
    out = np.empty(n, dtype=np.uint64)
    if n == 0:
        return out
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    view = np.ndarray(shape=(len(buf) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    count = np.maximum((size + 7) >> 3, 1)
    upto = np.concatenate(([0], np.cumsum(count)))
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(upto, upto[i] + _LANES, side="right")) - 1)
        c, s, z = count[i:j], starts[i:j], size[i:j]
        first = upto[i:j] - upto[i]
        if int(c.max()) == 1:
            out[i:j] = mix(mix((view[s] & _LANE[z]) + _SEEDS[seed]) + _STEP)
        else:
            k = np.arange(int(upto[j] - upto[i]), dtype=np.int64) - np.repeat(first, c)
            rest = np.repeat(z, c) - 8 * k
            x = view[np.repeat(s, c) + 8 * k] & _LANE[np.clip(rest, 0, 8)]
            out[i:j] = np.add.reduceat(mix(mix(x + _SEEDS[seed]) + (k.astype(np.uint64) + np.uint64(1)) * _STEP), first)
        i = j
    return mix(out + size.astype(np.uint64) * _LENGTH)


def row_of(woff: np.ndarray) -> np.ndarray:
    """The row of each word, from the word offsets of the rows."""
    return np.repeat(np.arange(len(woff) - 1, dtype=np.int32), np.diff(woff))


def fold(x: np.ndarray, width: int, multiplier: int) -> np.ndarray:
    """A hash of every ``width`` consecutive values: ``len(x) - width + 1`` of them, by doubling."""
    if len(x) < width:
        return np.zeros(0, np.uint64)
    acc, have, part, size = None, 0, x, 1
    while True:
        if width & size:
            if acc is None:
                acc, have = part, size
            else:
                m = len(x) - have - size + 1
                acc = acc[:m] * np.uint64(pow(multiplier, size, 2**64)) + part[have : have + m]
                have += size
        if have == width:
            return mix(acc[: len(x) - width + 1])
        m = len(x) - 2 * size + 1
        part = part[:m] * np.uint64(pow(multiplier, size, 2**64)) + part[size : size + m]
        part = part ^ (part >> np.uint64(31))
        size *= 2


def per_row(flags: np.ndarray, woff: np.ndarray) -> np.ndarray:
    """The sum of ``flags`` over each row's words."""
    c = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=c[1:])
    return c[woff[1:]] - c[woff[:-1]]


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n positions lie in ``[s, s + width)`` of some start."""
    d = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(
        np.minimum(starts + width, n), minlength=n + 1
    )[: n + 1]
    return np.cumsum(d[:n]) > 0


def release() -> None:
    """Give freed memory back to the system; Python workers live on after a task, next to other tasks' workers."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not this C library
