"""Words of many texts at once, on numpy arrays of their bytes. Used inside tasks, on Arrow batches.

A rule for words is a table of 256 flags, one per byte; in UTF-8 every byte of a non-ASCII character is
128 or more, so rules on code points below 128 are rules on bytes. Hashes are polynomials modulo 2**64
over random byte values, mixed at the end, so that whole blocks are hashed without a loop over words.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of one block; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20
# Bytes whose partial sums are in memory at once.
_SLICE = 1 << 18

_WHITE = frozenset(b"\t\n\x0b\x0c\r ")
NOT_WHITE = np.array([b not in _WHITE for b in range(256)])
ALPHANUMERIC = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])

_random = np.random.default_rng(20240131)
_VALUES = _random.integers(1, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
_VALUES_LOWER = _VALUES.copy()
_VALUES_LOWER[65:91] = _VALUES[97:123]
_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
_LENGTH = np.uint64(0xA0761D6478BD642F)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = _SLICE if n <= _SLICE else n
    if size not in _POWERS:
        tables = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
        if size != _SLICE:
            return tables
        _POWERS[size] = tables
    return _POWERS[size]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole value (the 64-bit finaliser of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and the n + 1 places where texts begin; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(batch: pa.RecordBatch, column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `most` bytes of text each."""
    _, offsets = text_bytes(batch.column(column))
    start = 0
    while start < len(batch):
        end = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
        end = min(max(end, start + 1), len(batch))
        yield batch.slice(start, end - start)
        start = end


def spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and next-after-last byte of every word, and the n + 1 places in them where texts begin."""
    flags = is_word[data]
    first = flags.copy()
    first[1:] &= ~flags[:-1]
    begins = offsets[:-1]
    begins = begins[begins < len(data)]
    first[begins] = flags[begins]
    last = flags
    after = np.ones(len(data), bool)
    after[:-1] = ~flags[1:] | first[1:]
    last = last & after
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of every word, never 0; `lower` takes A-Z as a-z."""
    values = _VALUES_LOWER if lower else _VALUES
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        begin = starts[at]
        to = max(int(np.searchsorted(ends, begin + _SLICE, "right")), at + 1)
        part = data[begin:ends[to - 1]]
        powers, inverse = _power_tables(len(part))
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values[part] * powers[:len(part)], out=sums[1:])
        s, e = starts[at:to] - begin, ends[at:to] - begin
        out[at:to] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * _LENGTH
        at = to
    out = mixed(out)
    out[out == 0] = 1
    return out


def windows(words: np.ndarray, size: int, base: int = 0) -> np.ndarray:
    """A hash of every run of `size` consecutive words; different `base` give independent hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factor = _WORD_BASE + np.uint64(2 * base)
    out = words[:n].copy() + np.uint64(base)
    for k in range(1, size):
        out *= factor
        out += words[k:k + n]
    return mixed(out)


def inside(bounds: np.ndarray, n_words: int, size: int) -> np.ndarray:
    """Which of the runs of `size` words starting at each word lie within one text."""
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n_words)
    return left >= size


def pack(values: np.ndarray) -> bytes:
    """Compressed bytes of an array, plane by plane, which suits small and slowly growing numbers."""
    import zstandard

    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(packed: bytes, dtype) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(dtype)
