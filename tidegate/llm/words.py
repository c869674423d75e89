"""Words of whole Arrow text batches as numpy arrays: bounds, owners and 64-bit hashes.

Everything works on the bytes of a batch at once. Large batches are cut between
rows into slices of a few megabytes, and hashing walks a slice in blocks that end
between words, so temporary memory does not follow the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_BLOCK = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _byte_set(*ranges) -> np.ndarray:
    found = np.zeros(256, bool)
    for low, high in ranges:
        found[low:high + 1] = True
    return found


#: White space that separates words: blank and \x09-\x0D.
SPACES = _byte_set((0x20, 0x20), (0x09, 0x0D))
#: ASCII bytes of lower-cased text that are neither letter nor digit.
NOT_ALNUM = _byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on every bit."""
    out = values ^ (values >> np.uint64(30))
    out *= _MIX1
    out ^= out >> np.uint64(27)
    out *= _MIX2
    return out ^ (out >> np.uint64(31))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` text bytes; one longer text is a run of its own."""
    _, bounds = text_bytes(batch.column(batch.schema.get_field_index(column)))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + limit, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def hash_prefixes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: tuple[int | None, ...]) -> list[np.ndarray]:
    """64-bit hashes of the first ``size`` bytes (None: all) of ascending, non-overlapping spans, one array a size."""
    out = [np.empty(len(starts), np.uint64) for _ in sizes]
    if not len(starts):
        return out
    table = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    longest = int((ends - starts).max())
    up, down = _powers(max(_BLOCK, longest) + 1)
    first = 0
    while first < len(starts):
        origin = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, origin + max(_BLOCK, longest), "right")))
        block = data[origin:ends[last - 1]]
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(table[block] * up[:len(block)], out=sums[1:])
        low, high = starts[first:last] - origin, ends[first:last] - origin
        for made, size in zip(out, sizes):
            stop = high if size is None else np.minimum(high, low + size)
            made[first:last] = mix((sums[stop] - sums[low]) * down[low] + (stop - low).astype(np.uint64))
        first = last
    return out


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every ascending, non-overlapping span of bytes."""
    return hash_prefixes(data, starts, ends, (None,))[0]


class Words:
    """Words of the rows of one text column.

    ``row`` owns each word (ascending), ``start`` and ``end`` are its byte bounds in
    ``data``; ``first[i]:first[i + 1]`` are the words of row ``i``.
    """

    def __init__(self, column, separators: np.ndarray = SPACES, lower: bool = True):
        raw, self.offsets = text_bytes(column)
        self.data = _LOWER[raw] if lower else raw
        self.rows = len(self.offsets) - 1
        gap = separators[self.data]
        edge = np.zeros(len(raw) + 1, bool)
        edge[self.offsets] = True
        before = edge[:-1].copy()
        before[1:] |= gap[:-1]
        after = edge[1:].copy()
        after[:-1] |= gap[1:]
        self.start = np.flatnonzero(before & ~gap)
        self.end = np.flatnonzero(after & ~gap) + 1
        self.row = np.searchsorted(self.offsets, self.start, "right") - 1
        self.first = np.searchsorted(self.row, np.arange(self.rows + 1))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.start, self.end)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def windows(hashes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``n``-word windows that stay inside a row, and the index of their first word."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[i:len(hashes) - n + 1 + i]
    inside = np.flatnonzero(row[:len(out)] == row[n - 1:])
    return mix(out[inside]), inside


def char_counts(data: np.ndarray) -> np.ndarray:
    """Running number of code points: entry ``i`` counts those that start before byte ``i``."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
