"""Words of Arrow text columns as NumPy arrays, for use inside Arrow UDFs.

Everything works on UTF-8 bytes. A batch is cut into blocks of a few MB, so that the
memory of a task does not depend on the number of rows in a batch; only a single
text longer than a block is held whole.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 4 << 20
PIECE_BYTES = 1 << 20

_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)

#: Byte to byte: A-Z to a-z, all else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def word_bytes(*not_in: tuple[int, int]) -> np.ndarray:
    """Which of the 256 bytes belong to words, given the ranges that do not."""
    table = np.ones(256, dtype=bool)
    for low, high in not_in:
        table[low : high + 1] = False
    return table


#: ``[^\x20\x09-\x0D]+``
SPACED = word_bytes((0x20, 0x20), (0x09, 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text
ALPHANUMERIC = word_bytes((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and row offsets of successive rows with about ``limit`` bytes; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    values = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        fit = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = max(row + 1, fit)
        yield values[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_bounds(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each word; no word crosses from one row to the next."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = table[data]
    begins = inside[1:-1] & ~inside[:-2]
    stops = inside[1:-1] & ~inside[2:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    begins[cuts] = inside[1:-1][cuts]
    stops[cuts - 1] = inside[1:-1][cuts - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, piece: int = PIECE_BYTES) -> np.ndarray:
    """A 64-bit polynomial hash of ``values[start:end]`` for each pair, equal for equal
    content wherever it stands. ``starts`` and ``ends`` must not fall. Its low bits are
    weak: use the high ones."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, low + piece, "right")))
        n = int(ends[last - 1] - low)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values[low : low + n].astype(np.uint64) * powers(_FACTOR, n), out=sums[1:])
        a, b = starts[first:last] - low, ends[first:last] - low
        out[first:last] = (sums[b] - sums[a]) * powers(_INVERSE, n + 1)[a]
        first = last
    return out


def spread(hashes: np.ndarray) -> np.ndarray:
    """Hashes with their bits mixed, to be hashed again or used as table places."""
    mixed = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(29))
