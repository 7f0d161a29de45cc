"""Removal of repeated byte strings by threshold-bounded interval expansion.

For the passages of a shard the Burrows-Wheeler transform is built. Starting with the interval of
the empty string, intervals are extended backward by one byte at a time, breadth first, and each
boundary between neighbouring suffixes gets the length of their common prefix, by increasing
value. The expansion stops at the minimum length: boundaries without a value then separate
suffixes that share at least so many bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortscope.llm.jaccard import whole_groups
from cohortscope.llm.regions import (
    Shape, covered, mask_ranges, text_blocks, with_recurring_ranges,
)

#: Bytes of a string, and bytes whose smallest hash deals strings out.
LENGTH, GRAM = 200, 64
#: Bytes of passages whose transform is built at once.
SHARD = 1 << 20


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of at least their first ``depth`` symbols, by prefix doubling.

    Symbols are below 2^16. In each round only suffixes that still share their place are sorted.
    """
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(3, symbols.dtype)]).astype(np.uint64)
    packed = np.zeros(n, dtype=np.uint64)
    for i in range(4):
        packed = (packed << np.uint64(16)) | padded[i : i + n]
    order = np.argsort(packed, kind="stable")
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = packed[order[1:]] != packed[order[:-1]]
    head = np.flatnonzero(fresh)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(head, np.diff(np.append(head, n)))
    known = 4
    while known < depth:
        fresh_end = np.append(fresh[1:], True)
        tied = np.flatnonzero(~(fresh & fresh_end))
        if not len(tied):
            break
        at = order[tied]
        later = at + known
        second = np.where(later < n, rank[np.minimum(later, n - 1)] + 1, 0)
        first = rank[at]
        inner = np.lexsort((second, first))
        at, first, second = at[inner], first[inner], second[inner]
        order[tied] = at
        new = np.ones(len(at), dtype=bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        fresh[tied] = new
        head = np.flatnonzero(new)
        rank[at] = np.repeat(tied[head], np.diff(np.append(head, len(at))))
        known *= 2
    return order


def shared_prefixes(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and for each whether it shares ``length`` symbols with the one before.

    The last symbol must occur once.
    """
    n = len(symbols)
    order = suffix_order(symbols, length)
    before = symbols[order - 1].astype(np.int64)  # the transform
    by_symbol = np.argsort(before, kind="stable")
    ranked = before[by_symbol] * (n + 1) + by_symbol
    previous = np.full(n, -1, dtype=np.int64)
    same = before[by_symbol[1:]] == before[by_symbol[:-1]]
    previous[by_symbol[1:][same]] = by_symbol[:-1][same]
    valued = np.zeros(n + 1, dtype=bool)  # boundaries whose common prefix is known
    valued[0] = valued[n] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        size = high - low
        owner = np.repeat(np.arange(len(low)), size)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size - low, size)
        first = previous[place] < low[owner]  # each symbol of an interval once
        symbol, owner = before[place[first]] * (n + 1), owner[first]
        new_low = np.searchsorted(ranked, symbol + low[owner])
        new_high = np.searchsorted(ranked, symbol + high[owner])
        fresh = ~valued[new_high]
        low, high = new_low[fresh], new_high[fresh]
        valued[high] = True
        if not len(low):
            break
    return order, ~valued[:n]


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece, whether each of its strings of that length starts anywhere else in the pieces."""
    sizes = np.array([len(p) for p in pieces])
    symbols = np.empty(int(sizes.sum()) + len(pieces), dtype=np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = np.ones(len(symbols), dtype=bool)
    text[starts + sizes] = False
    symbols[text] = np.frombuffer(b"".join(pieces), np.uint8)
    symbols[~text] = 256 + np.arange(len(pieces))  # an end of its own for each piece
    order, shared = shared_prefixes(symbols, length)
    both = shared | np.append(shared[1:], False)
    marked = np.zeros(len(symbols), dtype=bool)
    marked[order[both]] = True
    return [marked[a : a + max(n - length + 1, 0)] for a, n in zip(starts.tolist(), sizes.tolist())]


def compare_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of bytes that recurring strings cover, from whole anchor groups."""
    for table in whole_groups(batches, ["anchor"]):
        pieces, anchor = table.column("piece").to_pylist(), table.column("anchor").to_numpy()
        number: dict[bytes, int] = {}
        of_row = np.array([number.setdefault(p, len(number)) for p in pieces], dtype=np.int64)
        distinct = list(number)
        times = np.bincount(of_row, minlength=len(distinct))
        marks = _marks(distinct, times, anchor, of_row)
        key, part = table.column("key").to_numpy(), table.column("part").to_numpy()
        at = table.column("at").to_numpy()
        rows, lows, highs = [], [], []
        for row, piece in enumerate(of_row.tolist()):
            low, high = mask_ranges(marks[piece], int(at[row]), LENGTH)
            rows += [row] * len(low)
            lows.append(low)
            highs.append(high)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[rows]), pa.array(part[rows]), *(pa.array(np.concatenate(x)) for x in (lows, highs))],
            ["key", "part", "low", "high"],
        )


def _marks(distinct: list[bytes], times: np.ndarray, anchor: np.ndarray, of_row: np.ndarray) -> list[np.ndarray]:
    """For each different piece, whether each of its strings recurs.

    A piece that occurs twice recurs as a whole. The transform is built of all pieces of a group but
    where a group is one piece that occurs twice or more, which has nothing to be compared with.
    """
    group = np.empty(len(distinct), dtype=np.int64)
    group[of_row] = np.unique(anchor, return_inverse=True)[1]
    alone = np.bincount(group)[group] == 1
    marks = [np.ones(max(len(p) - LENGTH + 1, 0), dtype=bool) for p in distinct]
    todo = np.flatnonzero(~(alone & (times > 1)))
    todo = todo[np.argsort(group[todo], kind="stable")]
    start = 0
    while start < len(todo):
        stop, size = start, 0
        while stop < len(todo) and (
            size < SHARD and stop - start < 60_000 or group[todo[stop]] == group[todo[stop - 1]]
        ):
            size += len(distinct[todo[stop]])
            stop += 1
        chosen = todo[start:stop].tolist()
        for piece, found in zip(chosen, repeated_starts([distinct[i] for i in chosen], LENGTH)):
            if times[piece] == 1:
                marks[piece] = found
        start = stop
    return marks


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in text_blocks(batch, "text"):
            removed = covered(batch, row, end, offsets, LENGTH)
            edge = np.zeros(len(data), dtype=bool)
            edge[offsets[:-1][np.diff(offsets) > 0]] = True
            begins = removed.copy()
            begins[1:] &= ~removed[:-1] | edge[1:]
            total = np.concatenate([[0], np.cumsum(removed)])[offsets]
            runs = np.concatenate([[0], np.cumsum(begins)])[offsets]
            kept = data[~removed].tobytes()
            at = offsets - total
            digests = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(row, end - row),
                    pa.array(np.diff(offsets)),
                    pa.array(np.diff(total).astype(np.int64)),
                    pa.array(np.diff(runs).astype(np.int64)),
                    pa.array(digests),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )


def remove_repeated_strings(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte is removed when a string of 200 bytes covers it that also starts anywhere else, in any
    text or at another place of the same one; strings never cross texts. They are judged on the
    input. n_spans counts the maximal removed runs; kept_sha256 is that of the remaining bytes.

    Null text: empty. Null and repeated ids: a row each, and rows with equal texts remove each
    other's strings, as any two texts do. Empty table: no rows. Other columns are ignored. A text
    is worked on whole, in memory of about a hundred times its bytes.
    """
    found = with_recurring_ranges(
        docs, Shape(LENGTH, GRAM, words=False),
        apart="times > 1", again="times > 1", whole="TRUE", compare=compare_pieces,
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(
        _kept, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
