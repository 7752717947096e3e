"""Whole-batch reading of text columns: words, lines and their 64-bit hashes by numpy.

An Arrow string column is one UTF-8 buffer with offsets.  Words, lines and
windows of words of a whole slice of rows are found with array operations on
that buffer, so no text is split into Python strings.  All helpers treat a null
text as empty and never let a word or window run from one row into the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_RNG = np.random.default_rng(20240229)
_BYTE_VALUES = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[str, np.ndarray] = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


class Texts(NamedTuple):
    """UTF-8 bytes of consecutive rows; row ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def row(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


class Spans(NamedTuple):
    """Byte spans with the row each lies in, in text order."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray


def texts(column: pa.Array) -> Texts:
    """Bytes and offsets of a string column; nulls become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return Texts(data[offsets[0]:offsets[-1]], offsets - offsets[0])


def sliced(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``most`` bytes of text, one row at least."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_string())), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(size) // most
        edges = np.flatnonzero(np.diff(group, prepend=-1)).tolist() + [batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of 64-bit hashes: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(kind: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, 2 * SLICE_BYTES)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 4 * SLICE_BYTES:
            _powers[kind] = have
    return have[:n]


def words(t: Texts) -> Spans:
    """Maximal runs of bytes other than space and tab to carriage return."""
    n = len(t.data)
    if not n:
        return Spans(*(np.zeros(0, np.int64),) * 3)
    inside = ~SPACE[t.data]
    edge = np.zeros(n + 1, bool)
    edge[t.offsets] = True
    first = inside & edge[:n]
    first[1:] |= inside[1:] & ~inside[:-1]
    last = inside & edge[1:]
    last[:-1] |= inside[:-1] & ~inside[1:]
    start = np.flatnonzero(first)
    return Spans(start, np.flatnonzero(last) + 1, np.searchsorted(t.offsets, start, "right") - 1)


def lines(t: Texts) -> Spans:
    """Pieces between line feeds; a row with text has one line at least, an empty row none."""
    n = len(t.data)
    if not n:
        return Spans(*(np.zeros(0, np.int64),) * 3)
    feed = np.flatnonzero(t.data == 10)
    full = t.offsets[:-1][np.diff(t.offsets) > 0]
    start = np.union1d(full, (feed + 1)[feed + 1 < n])
    # A feed at the end of a row opens an empty last line, which holds no word and may be left out.
    stop = np.append(full, n)[np.searchsorted(full, start, "right")]
    feeds = np.append(feed, n)
    end = np.minimum(feeds[np.searchsorted(feed, start, "left")], stop)
    return Spans(start, end, np.searchsorted(t.offsets, start, "right") - 1)


def hashes(data: np.ndarray, s: Spans) -> np.ndarray:
    """64-bit hash of each span's bytes, alike wherever the span lies."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _power("inverse", _INVERSE, n), out=total[1:])
    raw = (total[s.end] - total[s.start]) * _power("base", _BASE, n)[np.minimum(s.start, max(n - 1, 0))] if len(s.start) else np.zeros(0, np.uint64)
    return mix(raw ^ ((s.end - s.start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def windows(h: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Position of the first word and hash of every run of ``width`` words within one row."""
    if len(h) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    m = len(h) - width + 1
    acc = h[:m].copy()
    for k in range(1, width):
        acc = acc * np.uint64(_BASE) + h[k:k + m]
    at = np.flatnonzero(row[:m] == row[width - 1:])
    return at, mix(acc[at])


def repeats(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each (row, key) is found twice or more, and whether it has come before in its row."""
    mixed = mix(key ^ mix(row.astype(np.uint64)))
    order = np.argsort(mixed, kind="stable")
    ranked = mixed[order]
    same = ranked[1:] == ranked[:-1]
    many, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    many[order[1:][same]] = True
    many[order[:-1][same]] = True
    later[order[1:][same]] = True
    return many, later


def per_row(row: np.ndarray, n: int) -> np.ndarray:
    """Number of entries by row."""
    return np.bincount(row, minlength=n).astype(np.int64)


def running(mask: np.ndarray) -> np.ndarray:
    """How many are set before each position, one entry longer than ``mask``."""
    out = np.zeros(len(mask) + 1, np.int32)
    np.cumsum(mask, out=out[1:])
    return out


def in_rows(t: Texts, count: np.ndarray) -> np.ndarray:
    """Differences of a running count over the rows of ``t``."""
    at = count[t.offsets]
    return (at[1:] - at[:-1]).astype(np.int64)
