"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a maximal run of ASCII letters, ASCII digits and bytes from 0x80 on (so of any non-ASCII
characters); ASCII letters are lowered. The 64-bit word hash is a polynomial over the bytes, taken
from prefix sums, and mixed. No text is cut: a text longer than a chunk makes a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

P = 0x9E3779B97F4A7C15 | 1
PINV = pow(P, -1, 1 << 64)


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets of a string column; nulls count as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
    col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    _, offs, data = col.buffers()
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    o = np.frombuffer(offs, np.int64)[col.offset : col.offset + len(col) + 1]
    d = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return d[o[0] : o[-1]], o - o[0]


def chunks(col, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) for runs of rows of about most bytes."""
    data, offs = utf8(col)
    n, at = len(offs) - 1, 0
    while at < n:
        to = int(np.searchsorted(offs, offs[at] + most, "right")) - 1
        to = min(n, max(to, at + 1), at + 60_000)
        yield at, to, data[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
        at = to


def tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = np.zeros(256, bool)
    word[48:58] = word[65:91] = word[97:123] = word[128:] = True
    return lower, word


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("p", ())) < n:
        n = max(n, 1 << 20)
        for k, x in (("p", P), ("i", PINV)):
            a = np.full(n, x, np.uint64)
            a[0] = 1
            _powers[k] = np.cumprod(a)
    return _powers["p"], _powers["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(member: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the runs where member holds, broken at the offsets."""
    n = len(member)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    full = offs[:-1] < offs[1:]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[1:], after[:-1] = member[:-1], member[1:]
    before[0] = after[-1] = False
    before[offs[:-1][full]] = False
    after[offs[1:][full] - 1] = False
    s = np.flatnonzero(member & ~before)
    e = np.flatnonzero(member & ~after) + 1
    return s, e, np.searchsorted(offs[1:], s, "right")


def hashes(low: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of low[s:e]."""
    p, inv = powers(len(low) + 1)
    total = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * p[: len(low)], out=total[1:])
    return mix((total[e] - total[s]) * inv[s] + (e - s).astype(np.uint64))


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row number, hash) of every word, in text order."""
    lower, word = tables()
    s, e, row = spans(word[data], offs)
    return row, hashes(lower[data], s, e)


def counts(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, low 48 bits of the hash) with how often each occurs, by row. Rows under 65536."""
    key = np.sort((row.astype(np.uint64) << np.uint64(48)) | (h & np.uint64((1 << 48) - 1)))
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(key)))
    key = key[first]
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1), n
