"""Words and hashes of UTF-8 text columns, vectorised over Arrow buffers.

Tasks work on groups of whole rows of about ``GROUP_BYTES`` of text, so the
memory of a task follows the group and the longest single text, never the
number of rows of a batch.  All hashes are 64-bit polynomial hashes over a
fixed random byte table, finished by an avalanche step; equal byte strings
always have equal hashes, and callers that need certainty compare the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 20
_SEGMENT = 1 << 21
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_M64 = (1 << 64) - 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(*ranges: tuple[int, int] | int) -> np.ndarray:
    """A 256-entry boolean table that is true for the given bytes and inclusive ranges."""
    out = np.zeros(256, dtype=bool)
    for r in ranges:
        lo, hi = r if isinstance(r, tuple) else (r, r)
        out[lo : hi + 1] = True
    return out


SPACE = byte_set(0x20, (0x09, 0x0D))
NOT_SPACE = ~SPACE
#: 0-9, a-z and every byte of a non-ASCII character (texts are lower-cased first)
ALNUM = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null counts as an empty text."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, off.astype(np.int64)


def row_groups(offsets: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes each, or one longer row."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def text_groups(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of each row group of a batch."""
    raw, off = utf8(batch.column(batch.schema.get_field_index(column)))
    for lo, hi in row_groups(off):
        yield lo, hi, raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]


def mix(h: np.ndarray) -> np.ndarray:
    """Avalanche step, so that any bits of the result can be used as a hash."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"], _POWERS["down"]


def _long_hash(b: np.ndarray, start: int, end: int) -> int:
    acc = 0
    for k in range(start, end, _SEGMENT):
        part = b[k : min(end, k + _SEGMENT)]
        up, _ = _powers(len(part))
        acc += int((_TABLE[part] * up[: len(part)]).sum(dtype=np.uint64)) * pow(_BASE, k - start, 1 << 64)
    return acc & _M64


def span_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end), which must be ordered and must not overlap."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + _SEGMENT, side="right"))
        if j <= i:  # one span longer than a segment
            out[i] = _long_hash(b, int(starts[i]), int(ends[i]))
            i += 1
            continue
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _powers(hi - lo)
        c = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_TABLE[b[lo:hi]] * up[: hi - lo], out=c[1:])
        s = starts[i:j] - lo
        # an empty span may start at the very end of the group, where no inverse power is needed
        out[i:j] = (c[ends[i:j] - lo] - c[s]) * down[np.minimum(s, max(hi - lo - 1, 0))]
        i = j
    return mix(out)


def runs(flag: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the true runs, cut at row ends, and the run index where each row begins."""
    n = len(flag)
    row_starts, row_ends = offsets[:-1], offsets[1:]
    before = np.zeros(n, bool)
    before[1:] = flag[:-1]
    before[row_starts[row_starts < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = flag[1:]
    after[row_ends[row_ends > 0] - 1] = False
    starts = np.flatnonzero(flag & ~before)
    ends = np.flatnonzero(flag & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(raw: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray, lower: bool = True):
    """(lower-cased bytes, starts, ends, hashes, index of each row's first word)."""
    b = LOWER[raw] if lower else raw
    starts, ends, first = runs(word_bytes[b], offsets)
    return b, starts, ends, span_hashes(b, starts, ends), first


_STEP = [pow(0xD6E8FEB86659FD93, j + 1, 1 << 64) for j in range(64)]


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, row, hash) of every window of ``k`` consecutive words of one row."""
    n = len(hashes) - k + 1
    counts = np.diff(first)
    row = np.repeat(np.arange(len(counts)), counts)
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc += hashes[j : j + n] * np.uint64(_STEP[j])
    at = np.flatnonzero(row[:n] == row[k - 1 :])
    return at, row[at], mix(acc[at])


def per_row(key: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hashes that tell equal keys of different rows apart."""
    return mix(key + (row.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA24BAED4963EE407))


def code_points(b: np.ndarray) -> np.ndarray:
    """True at the first byte of each character."""
    return (b & 0xC0) != 0x80


def prefix(x: np.ndarray) -> np.ndarray:
    """Prefix sums with a leading zero: the sum over [i, j) is p[j] - p[i]."""
    out = np.zeros(len(x) + 1, np.int64)
    np.cumsum(x, out=out[1:])
    return out
