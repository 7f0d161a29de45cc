"""Regions of texts that occur more than once: what substring deduplication has to look at.

A window is a number of consecutive units (words or bytes). Its anchor is the smallest hash of
the shorter grams in it, so equal windows have equal anchors wherever they occur, and the windows
that share an anchor form short runs. Only anchors that recur anywhere can hold windows that
recur; the texts' runs with such anchors are dealt out by anchor and compared exactly there, by
the method of the caller. Nothing is sampled: every window has an anchor.

Anchors that occur very often are not gathered in one task. Their windows are told apart by
128-bit hashes instead, with counts summed before each exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.grams import Words, byte_values, mix, sliding_min, spans, text_blocks
from cohortscope.llm.texts import whole_text

#: Occurrences of an anchor that one task compares at most; the windows of other anchors are
#: compared by hash. An occurrence brings less than two windows' bytes, so a group has at most about
#: three megabytes, for which the largest comparison needs some hundred megabytes of memory.
FREQUENT = 8_000
NO_ID = (1 << 63) - 1


@dataclass(frozen=True)
class Shape:
    """Units of a window and of the grams in it; words or bytes."""

    window: int
    gram: int
    words: bool


class Windows:
    """Anchors of all windows of a block, and the byte spans of runs of units."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, shape: Shape):
        self.shape, self.data = shape, data
        if shape.words:
            words = Words(data, offsets)
            self.values, self.doc, self.first = words.hashes, words.doc, words.first
            self.starts, self.stops = words.starts, words.stops
        else:
            self.values = byte_values(data)
            self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            self.first = offsets
            self.starts, self.stops = None, None
        n = len(self.values)
        at = np.arange(max(n - shape.gram + 1, 0))
        self.grams = spans(self.values, at, at + shape.gram) | np.uint64(1)
        anchor = sliding_min(self.grams, shape.window - shape.gram + 1)
        ends = len(anchor)
        inside = self.doc[:ends] == self.doc[n - ends :]
        #: The anchor of the window that starts at each unit, 0 where it would leave the text.
        self.anchor = np.where(inside, anchor, np.uint64(0))

    def occurrences(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, anchor and number of places of each anchor of each text."""
        if not len(self.anchor):  # no window fits
            return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
        reach = self.shape.window - self.shape.gram
        pad = np.zeros(reach, np.uint64)
        covering = ~sliding_min(~np.concatenate([pad, self.anchor, pad]), reach + 1)
        place = np.flatnonzero((covering == self.grams[: len(covering)]) & (covering != 0))
        doc, anchor = self.doc[place], self.grams[place]
        order = np.lexsort((anchor, doc))
        doc, anchor = doc[order], anchor[order]
        fresh = np.ones(len(doc), dtype=bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])
        start = np.flatnonzero(fresh)
        return doc[start], anchor[start], np.diff(np.append(start, len(doc)))

    def starts_with(self, anchors: np.ndarray) -> np.ndarray:
        """Whether a window starts at each unit that has one of the anchors."""
        return np.isin(self.anchor, anchors) & (self.anchor != 0)

    def runs(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end window of every run of wanted windows of one text and anchor."""
        place = np.flatnonzero(wanted)
        if not len(place):
            return place, place
        fresh = np.ones(len(place), dtype=bool)
        fresh[1:] = (
            (np.diff(place) != 1)
            | (self.anchor[place[1:]] != self.anchor[place[:-1]])
            | (self.doc[place[1:]] != self.doc[place[:-1]])
        )
        start = np.flatnonzero(fresh)
        return place[start], place[np.append(start[1:], len(place)) - 1] + 1

    def pieces(self, first: np.ndarray, end: np.ndarray) -> list[bytes]:
        """The bytes of the units that each run of windows covers."""
        last = end - 1 + self.shape.window
        if self.shape.words:
            first, last = self.starts[first], self.stops[last - 1]
        content = self.data.tobytes()
        return [content[a:b] for a, b in zip(first.tolist(), last.tolist())]


def keyed(docs: DataFrame) -> DataFrame:
    """key, part, doc_id, text: key and part name a row's id and text; the key is never null."""
    text = whole_text()
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("key"),
        F.xxhash64(text, F.col("doc_id").isNull()).alias("part"),
        "doc_id",
        text.alias("text"),
    )


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """key, part and the order of the id, null last."""
    order = batch.column("doc_id").cast(pa.int64()).fill_null(NO_ID)
    return tuple(
        c.to_numpy(zero_copy_only=False) for c in (batch.column("key"), batch.column("part"), order)
    )


def _occurrences(shape: Shape) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, _, order = _ids(batch)
            for row, _, data, offsets in text_blocks(batch, "text"):
                doc, anchor, places = Windows(data, offsets, shape).occurrences()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[row + doc]), pa.array(order[row + doc]), _signed(anchor), pa.array(places)],
                    ["key", "id", "anchor", "places"],
                )

    return work


def _segments(shape: Shape) -> Callable:
    """Runs of windows with a recurring anchor, with their bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, part, order = _ids(batch)
            for row, end, data, offsets in text_blocks(batch, "text"):
                anchors = batch.column("anchors").slice(row, end - row).flatten().to_numpy()
                found = Windows(data, offsets, shape)
                first, stop = found.runs(found.starts_with(anchors.view(np.uint64)))
                doc = found.doc[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(found.anchor[first]),
                        pa.array(key[row + doc]),
                        pa.array(part[row + doc]),
                        pa.array(order[row + doc]),
                        pa.array((first - found.first[doc]).astype(np.int64)),
                        pa.array(found.pieces(first, stop), pa.binary()),
                    ],
                    ["anchor", "key", "part", "id", "at", "piece"],
                )

    return work


def _frequent(shape: Shape) -> Callable:
    """Different windows with a frequent anchor, by two hashes.

    A row is a window of a text with the units that its places cover and their number; places
    that overlap make one row, so a text that repeats a phrase has few.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, part, order = _ids(batch)
            for row, end, data, offsets in text_blocks(batch, "text"):
                anchors = batch.column("frequent").slice(row, end - row).flatten().to_numpy()
                found = Windows(data, offsets, shape)
                at = np.flatnonzero(found.starts_with(anchors.view(np.uint64)))
                one = spans(found.values, at, at + shape.window)
                two = spans(mix(found.values + np.uint64(1)), at, at + shape.window)
                sorting = np.lexsort((at, two, one, found.doc[at]))
                at, one, two = at[sorting], one[sorting], two[sorting]
                doc = found.doc[at]
                fresh = np.ones(len(at), dtype=bool)
                fresh[1:] = (
                    (doc[1:] != doc[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
                    | (np.diff(at) > shape.window)
                )
                first = np.flatnonzero(fresh)
                last = np.append(first[1:], len(at))[: len(first)] - 1
                doc, begin = doc[first], found.first[doc[first]]
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(one[first]),
                        _signed(two[first]),
                        pa.array(key[row + doc]),
                        pa.array(part[row + doc]),
                        pa.array(order[row + doc]),
                        pa.array((at[first] - begin).astype(np.int64)),
                        pa.array((at[last] - begin + shape.window).astype(np.int64)),
                        pa.array((last - first + 1).astype(np.int64)),
                    ],
                    ["one", "two", "key", "part", "id", "low", "high", "places"],
                )

    return work


def copies(texts: DataFrame) -> DataFrame:
    """key, members (part, first): rows whose text other rows have as well.

    ``first`` marks the row with the smallest id, null last. One copy of a text stands for all
    when windows are compared.
    """
    narrow = texts.select(
        "key", "part", F.md5(F.col("text").cast("binary")).alias("digest"),
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"),
    )
    shared = narrow.groupBy("digest").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    members = narrow.join(shared.where("n > 1"), "digest")
    return members.groupBy("key").agg(
        F.collect_set(F.struct("part", F.expr("id = least").alias("first"))).alias("members")
    )


RANGES = "key long, part long, low long, high long"


def with_recurring_ranges(
    docs: DataFrame, shape: Shape, *, apart: str, again: str, whole: str, compare: Callable,
    frequent: int = FREQUENT,
) -> DataFrame:
    """Rows of docs as key, part, doc_id, text, ranges (part, low, high) and whole.

    The ranges are the units that recurring windows of the text cover. Of equal texts one takes
    part; ``whole`` is true for the copies m of which the condition of that name holds: all
    their windows recur. The texts are shuffled once, by key, and joined with narrow tables.

    ``apart`` says of an anchor's rows (id, places) whether it can recur, ``again`` of a frequent
    window whether it does (columns least_id, times, and its own id). ``compare`` turns batches of
    whole anchor groups, sorted by anchor, into rows of RANGES.
    """
    texts = keyed(docs)
    equal = copies(texts)
    once = "NOT coalesce(exists(members, m -> m.part = part AND NOT m.first), FALSE)"
    seen = texts.join(equal.hint("shuffle_hash"), "key", "left").where(once).mapInArrow(
        _occurrences(shape), "key long, id long, anchor long, places long"
    )
    recurring = (
        seen.groupBy("anchor")
        .agg(F.min("id").alias("least_id"), F.max("id").alias("most_id"), F.sum("places").alias("times"))
        .where(apart)
        .select("anchor", (F.col("times") > frequent).alias("often"))
    )
    lists = (
        seen.select("key", "anchor").join(recurring.hint("shuffle_hash"), "anchor")
        .groupBy("key")
        .agg(
            F.expr("collect_set(CASE WHEN NOT often THEN anchor END)").alias("anchors"),
            F.expr("collect_set(CASE WHEN often THEN anchor END)").alias("frequent"),
        )
    )
    chosen = texts.join(lists.hint("shuffle_hash"), "key")
    pieces = chosen.where("size(anchors) > 0").drop("frequent").mapInArrow(
        _segments(shape), "anchor long, key long, part long, id long, at long, piece binary"
    )
    compared = pieces.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(compare, RANGES)
    single = chosen.where("size(frequent) > 0").drop("anchors").mapInArrow(
        _frequent(shape),
        "one long, two long, key long, part long, id long, low long, high long, places long",
    )
    counts = single.groupBy("one", "two").agg(
        F.min("id").alias("least_id"), F.sum("places").alias("times")
    )
    often = single.join(counts, ["one", "two"]).where(again).select("key", "part", "low", "high")
    ranges = compared.unionByName(often).groupBy("key").agg(
        F.collect_list(F.struct("part", "low", "high")).alias("ranges")
    )
    known = ranges.join(equal, "key", "full")
    return texts.join(known.hint("shuffle_hash"), "key", "left").selectExpr(
        "key", "part", "doc_id", "text", "ranges",
        f"coalesce(exists(members, m -> m.part = part AND {whole}), FALSE) AS whole",
    )


def mask_ranges(mask: np.ndarray, at: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Units that the marked windows cover, as ranges; windows start at ``at`` on."""
    place = np.flatnonzero(mask)
    if not len(place):
        return place, place
    cut = np.flatnonzero(np.diff(place) > 1)
    return at + place[np.append(0, cut + 1)], at + place[np.append(cut, len(place) - 1)] + window


def covered(batch: pa.RecordBatch, row: int, end: int, first: np.ndarray, window: int) -> np.ndarray:
    """Whether each unit of rows row..end is covered by a recurring window; first: units before each row."""
    change = np.zeros(int(first[-1]) + 1, dtype=np.int64)
    ranges = batch.column("ranges").slice(row, end - row)
    parts = batch.column("part").to_numpy(zero_copy_only=False)[row:end]
    lengths = np.array([0 if n is None else n for n in _list_lengths(ranges)], dtype=np.int64)
    flat = ranges.flatten()
    if len(flat):
        owner = np.repeat(np.arange(end - row), lengths)
        part, low, high = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        own = part == parts[owner]
        np.add.at(change, first[owner[own]] + low[own], 1)
        np.add.at(change, first[owner[own]] + high[own], -1)
    whole = batch.column("whole").to_numpy(zero_copy_only=False)[row:end].astype(bool)
    whole &= np.diff(first) >= window
    np.add.at(change, first[:-1][whole], 1)
    np.add.at(change, first[1:][whole], -1)
    return np.cumsum(change[:-1]) > 0


def _list_lengths(ranges: pa.Array) -> list:
    import pyarrow.compute as pc

    return pc.list_value_length(ranges).to_pylist()
