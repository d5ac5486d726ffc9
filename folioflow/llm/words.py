"""Whole columns of text as numpy arrays: words, word hashes, shingle hashes, without a Python step for each word.

A word is a run of bytes outside [\\x20\\x09-\\x0D]; A-Z count as a-z. Hashes are 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once (a longer text is handled alone, whole).
CHUNK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII but letters: with it, words are runs of letters, and all other bytes count as letters.
NOT_LETTERS = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_ROW = [np.uint64(x) for x in (0xD1B54A32D192ED03, 0xABC98388FB8FAC03, 0x8CB92BA72F3D8DD7, 0xDB4F0B9175AE2165, 0xBBE0563303A4615F, 0xA0F2EC75A1FE1575)]


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(cls.up) < n:
            m = len(cls.up)
            cls.up = np.concatenate([cls.up, cls.up * np.uint64(pow(_BASE, m, 1 << 64))])
            cls.down = np.concatenate([cls.down, cls.down * np.uint64(pow(_BASE, -m, 1 << 64))])
        return cls.up[:n], cls.down[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def chunks(text: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets) over a string column, about limit bytes each; null is empty."""
    text = text.cast(pa.large_string())
    if text.null_count:
        text = text.fill_null("")
    n = len(text)
    if not n:
        return
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + n + 1]
    data = np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of each word, its end, first word of each row and the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = separators[data]
    starts, ends = ~space, ~space
    first = offsets[:-1][offsets[:-1] < n]
    last = offsets[1:][offsets[1:] > 0] - 1
    head, tail = starts[first], ends[last]
    starts[1:] &= space[:-1]
    ends[:-1] &= space[1:]
    starts[first], ends[last] = head, tail
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hasher(data: np.ndarray):
    """A function from starts and ends to the hashes of these stretches of data (A-Z as a-z)."""
    up, down = _Powers.of(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LOWER[data] * up[:-1], out=total[1:])
    return lambda starts, ends: mixed((total[ends] - total[starts]) * down[starts])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each row and the end)."""
    starts, ends, first = word_spans(data, offsets)
    return span_hasher(data)(starts, ends), first


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each row."""
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of k words, first run of each row and the end). A row of 1 to k - 1 words is one run."""
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    at = np.zeros(len(first), np.int64)
    np.cumsum(count, out=at[1:])
    out = np.empty(at[-1], np.uint64)
    if len(words) >= k:
        m = len(words) - k + 1
        whole = words[:m] * _ROW[0]
        for j in range(1, k):
            whole = whole + words[j : j + m] * _ROW[j]
        inside = (np.repeat(first[1:], n) - np.arange(len(words))) >= k
        keep = np.repeat(n >= k, count)
        out[keep] = whole[inside[:m]] if m else whole
    for d in np.flatnonzero((n > 0) & (n < k)):
        own = words[first[d] : first[d + 1]]
        total = len(own) * int(_ROW[5])
        for j, w in enumerate(own):
            total += int(w) * int(_ROW[j])
        out[at[d]] = total & _MASK
    return mixed(out), at
