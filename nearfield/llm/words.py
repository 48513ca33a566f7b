"""Word hashes and word shingles of Arrow text columns, vectorised; used inside tasks only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SLICE_BYTES = 1 << 19
_MULT = np.uint64(0x9E3779B97F4A7C15)  # odd, so powers of it can be undone modulo 2^64


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising bit mixer on 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _MULT)          # a 64-bit value for each byte
_BYTE[65:91] = _BYTE[97:123]                                     # A-Z hash like a-z
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """MULT^i and its inverse MULT^-i for i < n, modulo 2^64; kept for the next call."""
    global _UP, _DOWN
    if len(_UP) < n:
        inverse = pow(int(_MULT), -1, 1 << 64)
        _UP = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, _MULT)]))
        _DOWN = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, np.uint64(inverse))]))
    return _UP[:n], _DOWN[:n]


_UP = _DOWN = np.ones(1, np.uint64)


def slice_words(data: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and length in bytes of each word; a word ends at a blank and where a text starts."""
    n = len(data)
    solid = ~_BLANK[data]
    edge = np.zeros(n + 1, bool)
    edge[doc_starts[doc_starts < n]] = True
    opens = solid.copy()
    opens[1:] &= ~solid[:-1] | edge[1:n]
    starts = np.flatnonzero(opens)
    closes = solid.copy()
    closes[:-1] &= ~solid[1:] | edge[1:n]
    ends = np.flatnonzero(closes) + 1
    up, down = _powers(n)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[data] * up, out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, starts, ends - starts


def column_words(column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of an Arrow text column (no nulls): first row, row after the last, word hashes, word lengths, and
    the number of the first word of each row (one more entry than rows). Rows are whole in a slice; a slice has
    about SLICE_BYTES, or one long row, whose words are hashed piece by piece."""
    import pyarrow as pa

    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1)
        low, high = offsets[row], offsets[end]
        hashes, starts, sizes = [], [], []
        at = low
        while at < high:
            to = min(high, at + 2 * SLICE_BYTES)
            while to < high and not _BLANK[data[to]]:  # a piece of a long row ends at a blank
                to += 1
            h, s, z = slice_words(data[at:to], offsets[row:end + 1] - at if at == low else np.zeros(0, np.int64))
            hashes.append(h)
            starts.append(s + (at - low))
            sizes.append(z)
            at = to
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        first = np.searchsorted(join(starts, np.int64), offsets[row:end + 1] - low)
        yield row, end, join(hashes, np.uint64), join(sizes, np.int64), first
        row = end


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words, by its first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * _MULT + hashes[k:k + n]
    return mix(out)


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """The distinct shingles of one text, sorted, as signed values; fewer words than ``width`` are one shingle."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    runs = shingles(hashes, width) if len(hashes) >= width else mix(shingles(hashes, len(hashes)) + np.uint64(len(hashes)))
    return np.unique(runs.view(np.int64))
