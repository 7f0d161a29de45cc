"""Hashes of words, word windows and byte windows, computed by arrays over blocks of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text is a block of its own.
BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


#: A number for each byte.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64, at least n of them."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 12), base, dtype=np.uint64)
        known[0] = 1
        known = _POWERS[base] = np.cumprod(known, dtype=np.uint64)
    return known[:n]


def spans(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of values[start:stop] for every span, equal for equal contents wherever they lie."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _powers(_BASE, len(values)), out=total[1:])
    hashed = (total[stops] - total[starts]) * _powers(_INVERSE, len(values) + 1)[starts]
    return mix(hashed + (stops - starts).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def byte_values(data: np.ndarray) -> np.ndarray:
    """A 64-bit number for each byte."""
    return _BYTE[data]


def text_blocks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows' texts in the bytes) of a string column."""
    array = batch.column(column)
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    if not len(array):
        return
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset :][: len(array) + 1]
    at = at.astype(np.int64)
    content = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(array):
        end = max(row + 1, int(np.searchsorted(at, at[row] + BLOCK, side="right")) - 1)
        yield row, end, content[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


class Words:
    """The words of a block: first and end byte, document number and hash of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = (data != 32) & ((data < 9) | (data > 13))
        before, after = np.empty_like(inside), np.empty_like(inside)
        if len(data):
            before[0], before[1:] = False, inside[:-1]
            after[-1], after[:-1] = False, inside[1:]
            edges = offsets[:-1][np.diff(offsets) > 0]
            before[edges] = False
            after[edges[1:] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.stops = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=len(offsets) - 1)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.hashes = spans(_BYTE[data], self.starts, self.stops)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first word and hash of every window of so many words of one document."""
        n = len(self.starts) - size + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        place = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        return place, spans(self.hashes, place, place + size)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every run of ``width`` neighbouring values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    pad = -len(values) % width
    padded = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)])
    rows = padded.reshape(-1, width)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 :][:n])
