"""Text columns as flat byte arrays, and hashes of their words and windows.

The functions work on whole Arrow batches with numpy, so Python costs a few
calls per batch and not per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2**20
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
WORD = ~SPACE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE_VALUES = np.random.default_rng(12345).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PER_PLACE = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text; a longer text is alone."""
    _, offsets = utf8(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; NULL is empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    buffers = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.zeros(0, np.uint8) if buffers[2] is None else np.frombuffer(buffers[2], np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of ``inside`` bytes within each text, and first span per text."""
    n = len(data)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each non-empty, disjoint span."""
    lengths = ends - starts
    if not len(starts):
        return np.zeros(0, np.uint64)
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    at = place + np.repeat(starts, lengths)
    value = _BYTE_VALUES[data[at]] * powers(int(lengths.max()), _PER_PLACE)[place]
    return mix64(np.add.reduceat(value, first) + lengths.astype(np.uint64))


def window_hashes(items: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive items, at its first one."""
    n = len(items) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = items[:n].copy()
    for place in range(1, size):
        out = out * _ODD + items[place : place + n]
    return mix64(out)


def windows_inside(firsts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Whether the window of ``size`` items at each place stays within its text.

    ``firsts`` holds the first item of every text and, last, the number of items.
    """
    counts = np.diff(firsts)
    last = np.repeat(firsts[1:], counts)
    return (np.arange(len(last)) + size <= last)[:n]


def owners(firsts: np.ndarray) -> np.ndarray:
    """The text of each item."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))


def covered(starts: np.ndarray, sizes: np.ndarray | int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in any span."""
    change = np.zeros(n + 1, dtype=np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + sizes, -1)
    return np.cumsum(change)[:n] > 0


def sums(flags: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each text."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[firsts[1:]] - total[firsts[:-1]]
