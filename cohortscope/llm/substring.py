"""Substring deduplication by repeated-phrase automata.

Passages that recur between documents are confirmed by their anchors and windows. The windows that
different passages of a shard share are its phrases; an Aho-Corasick automaton of a shard's
phrases then reads all passages of the shard and finds every occurrence. An occurrence is
removed where its phrase also starts in a document with a smaller id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortscope.llm.grams import Words
from cohortscope.llm.jaccard import whole_groups
from cohortscope.llm.regions import (
    Shape, covered, mask_ranges, text_blocks, with_recurring_ranges,
)

#: Words of a phrase, and words whose smallest hash deals phrases out.
PHRASE, GRAM = 13, 4


class Passages:
    """The different passages of a shard, as sequences of word numbers."""

    def __init__(self, pieces: list[bytes], ids: np.ndarray):
        number: dict[bytes, int] = {}
        self.of_row = np.array([number.setdefault(p, len(number)) for p in pieces], dtype=np.int64)
        content = b"".join(number)
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in number])]).astype(np.int64)
        words = Words(np.frombuffer(content, np.uint8), offsets)
        self.first = words.first
        self.numbers = np.unique(words.hashes, return_inverse=True)[1]
        self.place, self.hashes = words.windows(PHRASE)
        self.doc = words.doc[self.place]
        least = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(least, self.of_row, ids)
        #: For each window of each passage, the smallest id of the documents that hold it.
        self.owner = least[self.doc]
        self._locate(least)

    def _locate(self, least: np.ndarray) -> None:
        """Lowers the owners of phrases that different passages share."""
        distinct, which, times = np.unique(self.hashes, return_inverse=True, return_counts=True)
        shared = np.flatnonzero(times[which] > 1)
        if not len(shared):
            return
        numbers = self.numbers.tolist()
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        owners: list[int] = []
        for at, owner in zip(self.place[shared].tolist(), self.owner[shared].tolist()):
            phrase = tuple(numbers[at : at + PHRASE])
            known = automaton.get(phrase, None)
            if known is None:
                automaton.add_word(phrase, len(owners))
                owners.append(owner)
            elif owner < owners[known]:
                owners[known] = owner
        automaton.make_automaton()
        window_at = np.full(len(numbers), -1, dtype=np.int64)
        window_at[self.place] = np.arange(len(self.place))
        for passage in np.unique(self.doc[shared]).tolist():
            start = int(self.first[passage])
            for last, phrase in automaton.iter(tuple(numbers[start : int(self.first[passage + 1])])):
                window = window_at[start + last - PHRASE + 1]
                self.owner[window] = min(self.owner[window], owners[phrase])


def compare_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of words that phrases of earlier documents cover, from whole anchor groups."""
    for table in whole_groups(batches, ["anchor"]):
        ids, at = table.column("id").to_numpy(), table.column("at").to_numpy()
        key, part = table.column("key").to_numpy(), table.column("part").to_numpy()
        passages = Passages(table.column("piece").to_pylist(), ids)
        begin = np.searchsorted(passages.doc, np.arange(len(passages.first)))
        rows, lows, highs = [], [], []
        for row, passage in enumerate(passages.of_row.tolist()):
            owner = passages.owner[begin[passage] : begin[passage + 1]]
            low, high = mask_ranges(owner < ids[row], int(at[row]), PHRASE)
            rows += [row] * len(low)
            lows.append(low)
            highs.append(high)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[rows]), pa.array(part[rows]), *(pa.array(np.concatenate(x)) for x in (lows, highs))],
            ["key", "part", "low", "high"],
        )


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in text_blocks(batch, "text"):
            words = Words(data, offsets)
            removed = covered(batch, row, end, words.first, PHRASE)
            counts = np.bincount(words.doc[removed], minlength=end - row)
            kept = np.flatnonzero(~removed)
            # A kept word's bytes, and one blank after it unless it is its text's last.
            edge = np.zeros(len(data) + 1, dtype=np.int64)
            np.add.at(edge, words.starts[kept], 1)
            np.add.at(edge, words.stops[kept], -1)
            inside = np.cumsum(edge[:-1]) > 0
            after = words.stops[kept[:-1]][words.doc[kept[:-1]] == words.doc[kept[1:]]]
            out = data.copy()
            out[after] = 32
            inside[after] = True
            total = np.concatenate([[0], np.cumsum(inside)])[offsets]
            text = out[inside].tobytes()
            digests = [hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(total[:-1], total[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(row, end - row),
                    pa.array(words.counts.astype(np.int64)),
                    pa.array(counts.astype(np.int64)),
                    pa.array(digests),
                ],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )


def remove_repeated_phrases(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept_sha256.

    A word is removed when a window of 13 consecutive words covers it whose words also start in a
    document with a smaller id. Windows are judged on the input. kept_sha256 is that of the kept
    words, joined by one blank.

    Null text: no words; so is an empty one. A null id is larger than any other, and not larger
    than another null one. Rows that share an id do not remove from each other. Empty table: no
    rows. Other columns are ignored. A text is worked on whole, in memory of about forty
    times its bytes.
    """
    found = with_recurring_ranges(
        docs, Shape(PHRASE, GRAM, words=True),
        apart="least_id < most_id", again="least_id < id", whole="NOT m.first", compare=compare_passages,
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(
        _kept, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string"
    )
