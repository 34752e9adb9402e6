"""Words of many texts at once, as numpy arrays over Arrow's own buffers.

Used inside tasks only: Spark deals out the texts and shuffles the results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Fixed value: odd multiplier of the polynomial hashes, modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
#: Texts are worked on in groups of about so many bytes, cut between texts.
GROUP_BYTES = 4 << 20
#: Words are hashed in pieces of about so many bytes.
PIECE_BYTES = 1 << 20

_tables: dict = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse."""
    have = _tables.get("powers")
    if have is None or len(have[0]) < n:
        size = max(n, PIECE_BYTES * 2)
        with np.errstate(over="ignore"):
            out = []
            for x in (BASE, pow(BASE, -1, 2**64)):
                p = np.full(size, x, np.uint64)
                p[0] = 1
                out.append(np.multiply.accumulate(p))
        have = _tables["powers"] = tuple(out)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_table(fold: bool) -> np.ndarray:
    """A random value for each byte; fold: A-Z as a-z."""
    if ("bytes", fold) not in _tables:
        t = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
        if fold:
            t[65:91] = t[97:123]
        _tables["bytes", fold] = t
    return _tables["bytes", fold]


def _blank_table() -> np.ndarray:
    if "blank" not in _tables:
        t = np.zeros(256, bool)
        t[[9, 10, 11, 12, 13, 32]] = True
        _tables["blank"] = t
    return _tables["blank"]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def groups(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, end, bytes, offsets) for runs of texts of about GROUP_BYTES."""
    data, offs = buffers(column)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + GROUP_BYTES, side="right")) - 1)
        j = min(j, n)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): the words' byte ranges, and the number of words
    before each text (one more than texts)."""
    solid = ~_blank_table()[data]
    begin, stop = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    stop[:-1] &= ~solid[1:]
    cuts = offs[(offs > 0) & (offs < len(data))]
    begin[cuts] = solid[cuts]
    stop[cuts - 1] = solid[cuts - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, offs)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """A 64-bit hash of each word."""
    out = np.empty(len(starts), np.uint64)
    table = _byte_table(fold)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            at = starts[i]
            j = max(i + 1, int(np.searchsorted(ends, at + PIECE_BYTES, side="right")))
            size = int(ends[j - 1] - at)
            up, down = powers(size + 1)
            total = np.zeros(size + 1, np.uint64)
            np.cumsum(table[data[at : ends[j - 1]]] * up[:size], out=total[1:])
            s, e = starts[i:j] - at, ends[i:j] - at
            out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
            i = j
    return out


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every k consecutive values (n - k + 1 of them)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        if k <= 8:
            total = np.zeros(n, np.uint64)
            for i in range(k):
                total *= np.uint64(BASE)
                total += hashes[i : i + n]
            return mix(total)
        out = np.empty(n, np.uint64)
        step = PIECE_BYTES
        for i in range(0, n, step):
            part = hashes[i : min(i + step, n) + k - 1]
            up, down = powers(len(part) + 1)
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * up[: len(part)], out=total[1:])
            m = len(part) - k + 1
            out[i : i + m] = (total[k : k + m] - total[:m]) * down[:m]
        return mix(out)


def give_back() -> None:
    """Return freed memory to the machine. A Python worker that Spark uses again
    would keep it through the tasks of all later stages."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()
