"""Words and fingerprints of whole Arrow columns of text, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  modules here use pa.compute, which pyarrow alone does not load

WORD = r"[^\x20\x09-\x0D]+"

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column, null as empty, and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), at


def pieces(at: np.ndarray, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most this many bytes, or of one row."""
    low, n = 0, len(at) - 1
    while low < n:
        high = int(np.searchsorted(at, at[low] + most, "right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


class Prefix:
    """Fingerprints of any byte range of a buffer, by one subtraction."""

    def __init__(self, buf: np.ndarray):
        power, self.inverse = powers(len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(BYTE[buf] * power[:-1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Not yet mixed; equal ranges agree wherever they lie."""
        return (self.sums[end] - self.sums[start]) * self.inverse[start] + np.asarray(end - start, np.int64).astype(np.uint64)


def lower(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def words(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word; ``at`` are the rows' offsets in ``buf``, from 0 to its length."""
    letter = np.zeros(len(buf) + 2, bool)
    np.logical_not(_SPACE[buf], out=letter[1:-1])
    first = letter[1:] & ~letter[:-1]
    last = letter[:-1] & ~letter[1:]
    inner = at[1:-1]
    inner = inner[(inner > 0) & (inner < len(buf))]
    split = inner[letter[inner] & letter[inner + 1]]
    first[split] = True
    last[split] = True
    start, end = np.flatnonzero(first), np.flatnonzero(last)
    return start, end, np.searchsorted(at, start, "right") - 1


def shingles(buf: np.ndarray, at: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit shingles of lower-cased words: (hash, row, first word's start, last word's end), in text order.

    A row with fewer words than ``size`` but at least one has one shingle, of all its words.
    """
    start, end, row = words(buf, at)
    word = mix(Prefix(lower(buf))(start, end))
    n = len(start)
    total = word.copy()
    factor = 1
    for k in range(1, size):
        factor = factor * _BASE & (1 << 64) - 1
        total[:max(0, n - k)] += word[k:] * np.uint64(factor) if n > k else 0
    whole = np.zeros(n, bool)
    if n >= size:
        whole[:n - size + 1] = row[size - 1:] == row[:n - size + 1]
    keep = np.flatnonzero(whole)
    hashes, rows, first, last = mix(total[keep]), row[keep], start[keep], end[np.minimum(keep + size - 1, max(n - 1, 0))]
    count = np.bincount(row, minlength=len(at) - 1)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        begin = np.cumsum(count) - count
        own = []
        for r in short:
            h = int(count[r])
            for k in range(h):
                h = (h * _BASE + int(word[begin[r] + k])) & (1 << 64) - 1
            own.append(h)
        hashes = np.concatenate([hashes, mix(np.array(own, np.uint64))])
        rows = np.concatenate([rows, short])
        first = np.concatenate([first, start[begin[short]]])
        last = np.concatenate([last, end[begin[short] + count[short] - 1]])
        order = np.argsort(rows, kind="stable")
        hashes, rows, first, last = hashes[order], rows[order], first[order], last[order]
    return hashes, rows, first, last


def sets(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, sorted, and their rows; ``rows`` must not fall."""
    if not len(hashes):
        return hashes, rows
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[new], rows[new]
