"""Numpy helpers over many byte strings held as one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash

MULTIPLIER = 0x9E3779B97F4A7C15
_M = np.uint64(MULTIPLIER)
_INVERSE = np.uint64(pow(MULTIPLIER, -1, 1 << 64))
# a random 64-bit value for every byte
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def joined(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values and their offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit hash over all."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


def prefix_sums(data: np.ndarray, raised: np.ndarray | None = None) -> np.ndarray:
    """Sums from which ``span_hashes`` takes the hash of any span; ``raised`` are the powers of
    the multiplier, if they are at hand."""
    out = np.zeros(len(data) + 1, np.uint64)
    terms = _BYTE[data]
    terms *= powers(_M, len(data)) if raised is None else raised[: len(data)]
    np.cumsum(terms, out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, inverse: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each span, the same wherever its bytes stand. Cheap for windows that
    overlap; some texts are known to share it, so it only picks places, and tells nothing apart."""
    inverse = powers(_INVERSE, len(sums)) if inverse is None else inverse
    h = (sums[ends] - sums[starts]) * inverse[starts]
    h += (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return mixed(h)


def window_hashes(sums: np.ndarray, size: int, inverse: np.ndarray) -> np.ndarray:
    """``span_hashes`` of all spans of one size, in order."""
    h = sums[size:] - sums[:-size]
    h *= inverse[: len(h)]
    h += np.uint64(size * 0xC2B2AE3D27D4EB4F % (1 << 64))
    return mixed(h)


# spans up to so many bytes are hashed all at once, a register of eight bytes at a time
SHORT = 64
# the lowest n bytes of a register
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _registers(data: np.ndarray, lengths: np.ndarray, starts: np.ndarray):
    """For every eight bytes of short spans: which spans have any there, and what they have."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    at = np.ndarray((len(data) + 1,), "<u8", padded.data, 0, (1,))
    for c in range(-(-min(SHORT, int(lengths.max(initial=0))) // 8)):
        some = np.flatnonzero((lengths > 8 * c) & (lengths <= SHORT))
        yield some, at[starts[some] + 8 * c].astype(np.uint64) & _LOW[np.minimum(lengths[some] - 8 * c, 8)]


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, the same wherever they stand.

    Every eight bytes are mixed in before the next ones come, so that, unlike with sums of
    powers, no family of texts is known to share a hash.
    """
    lengths = ends - starts
    h = mixed(lengths.astype(np.uint64) + np.uint64(0xC2B2AE3D27D4EB4F))
    for some, values in _registers(data, lengths, starts):
        h[some] = mixed(h[some] * _M + values)
    for i in np.flatnonzero(lengths > SHORT).tolist():
        h[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), 42)
    return h


def same_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether each span has the bytes of the span of another number."""
    lengths = ends - starts
    same = lengths == lengths[other]
    values = np.empty(len(starts), np.uint64)
    for some, mine in _registers(data, lengths, starts):
        values[some] = mine
        some = some[same[some]]
        same[some] = values[some] == values[other[some]]
    for i in np.flatnonzero(same & (lengths > SHORT) & (other != np.arange(len(other)))).tolist():
        j = other[i]
        same[i] = np.array_equal(data[starts[i] : ends[i]], data[starts[j] : ends[j]])
    return same


def raised_powers(n: int) -> np.ndarray:
    return powers(_M, n)


def inverse_powers(n: int) -> np.ndarray:
    return powers(_INVERSE, n)


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The spans of ``flat`` one after another."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the first word of every text (one more at the end).

    Words are runs of other bytes than space and tab to carriage return.
    """
    blank = np.ones(len(data) + 1, bool)
    blank[:-1] = (data == 32) | ((data >= 9) & (data <= 13))
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    inside = ~blank
    starts = inside.copy()
    starts[1:] &= blank[:-1] | first[1:]
    ends = np.zeros(len(data) + 1, bool)
    ends[1:] = inside[:-1] & (blank[1:] | first[1:])
    s, e = np.flatnonzero(starts), np.flatnonzero(ends)
    return s, e, np.searchsorted(s, offsets)


def portions(batch: pa.RecordBatch, column: str, work_bytes: int):
    """Slices of a batch with up to so many bytes in a column, or one longer value."""
    values = batch[column].cast(pa.large_binary())
    ends = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(values), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + work_bytes, "right")))
        yield batch.slice(at, to - at)
        at = to
