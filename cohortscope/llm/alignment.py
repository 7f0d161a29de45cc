"""Alignment of two tokenizations of the same texts by lockstep merging.

The tokens of both tokenizers are runs of the same bytes. A state vector holds a pointer into
either list of tokens for every document of a block; one step moves the pointers of all of them,
emits the pair of tokens that each points at as a link, and a cut where both tokens end. A long
document takes several places in the vector, so a block's steps do not grow with its longest text.

Where both tokenizers always begin anew at blanks between words, the alignment of a word is the same
in any text: a process keeps those of the words that it has met, and merges new words only.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, count, islice
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.scratch import Scratch
from cohortscope.llm.texts import whole_text

#: Bytes of text merged at once, and bytes of texts whose links are counted together before a shuffle.
BLOCK, CHUNK = 1 << 19, 1 << 23
#: Tokens of the first tokenizer that one place of the state vector walks over.
LANE = 256
#: Characters of words whose ids a process keeps; with more it starts anew.
KEPT = 1 << 22
#: Characters and links of words whose alignments a process keeps; with more it gives up the less used half.
HELD = 6 << 20
#: Words encoded as one text.
MANY = 1 << 10
#: A blank between two characters that are white space in no version of Unicode, and a word between such blanks.
BETWEEN = re.compile(r" (?=[\w!-~])(?<=[\w!-~] )")
INNER = re.compile(r"[\w!-~](?:.*[\w!-~])?", re.DOTALL)


class Words:
    """Ids of a blank and each text, by a tokenizer whose tokens always begin anew at ``BETWEEN``.

    The ids between two such blanks are then the same in any text: those of a word are kept, and
    new words are encoded as a few texts, which costs far less than a text for each.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], size: np.ndarray):
        self.encode, self.bytes_of = encode, size
        self.kept, self.chars = {}, 0

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        words = [BETWEEN.split(text) for text in texts]
        new = [*set(chain.from_iterable(words)).difference(self.kept)]
        ids, n = self.of(new, _spelt(new))
        ids, start = ids.tobytes(), 0
        for word, end in zip(new, (4 * np.cumsum(n)).tolist()):
            self.kept[word] = ids[start:end]
            start = end
        out = [np.frombuffer(b"".join(map(self.kept.__getitem__, w)), dtype=np.int32) for w in words]
        self.chars += sum(map(len, new))
        if self.chars > KEPT:
            self.kept, self.chars = {}, 0
        return out

    def of(self, words: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a blank and each of these words, word after word, and their numbers.

        ``sizes`` are the bytes of a blank and each word. The words hold no ``BETWEEN``.
        """
        # Beginnings and ends of texts may be white space; a .model writes a blank as U+2581.
        text = " ".join(words)
        inner = np.ones(len(words), dtype=bool)
        if "\u2581" in text or BETWEEN.split(text) != words:
            inner = np.array(["\u2581" not in w and INNER.fullmatch(w) is not None for w in words], dtype=bool)
        of_inner = words if inner.all() else [w for w, i in zip(words, inner.tolist()) if i]
        parts = [" ".join(of_inner[i : i + MANY]) for i in range(0, len(of_inner), MANY)]
        ids = np.fromiter(chain.from_iterable(self.encode(parts)), dtype=np.int32)
        upto = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(sizes[inner]), side="right")
        if inner.all():
            return ids, np.diff(upto, prepend=0)
        edges = self.encode([w for w, i in zip(words, inner.tolist()) if not i])
        n = np.empty(len(words), dtype=np.int64)
        n[inner], n[~inner] = np.diff(upto, prepend=0), [len(x) for x in edges]
        start = np.empty(len(words), dtype=np.int64)
        start[inner] = upto - n[inner]
        start[~inner] = len(ids) + np.cumsum(n[~inner]) - n[~inner]
        return np.append(ids, np.fromiter(chain.from_iterable(edges), dtype=np.int32))[_runs(start, n)], n


def _spelt(texts: list[str]) -> np.ndarray:
    """Bytes of a blank and each text."""
    return np.array([1 + len(text.encode()) for text in texts], dtype=np.int64)


def _runs(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places of all runs, run after run."""
    return np.arange(length.sum()) + np.repeat(start - (np.cumsum(length) - length), length)


class Vocabulary:
    """Ids and bytes of a tokenizer's tokens, without special tokens."""

    def __init__(self, kind: str, model: bytes):
        if kind == "sentencepiece":
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_proto=model)
            self.bytes = [
                bytes([int(p[3:-1], 16)]) if processor.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in ((i, processor.id_to_piece(i)) for i in range(processor.get_piece_size()))
            ]
            self.encode = lambda texts: processor.encode(texts, num_threads=1)  # puts a blank before each
            self.spells = False  # it may normalise, and writes blanks as a letter that texts may hold
            by_words = _begins_anew(model)
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            from tokenizers.models import BPE

            tokenizer = Tokenizer.from_str(model.decode("utf-8"))
            tokenizer.no_truncation()
            tokenizer.no_padding()
            tokenizer.encode_special_tokens = True  # their strings in a text are text
            letters = _byte_letters()
            self.bytes = [b""] * tokenizer.get_vocab_size()
            for piece, i in tokenizer.get_vocab().items():
                known = all(c in letters for c in piece)
                self.bytes[i] = bytes(letters[c] for c in piece) if known else piece.encode()
            self.encode = lambda texts: [
                e.ids for e in tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
            ]
            # A byte-level vocabulary with every byte spells any text that nothing rewrites first.
            self.spells = (
                tokenizer.normalizer is None
                and type(tokenizer.pre_tokenizer).__name__ == "ByteLevel"
                and {b for b in self.bytes if len(b) == 1} == {bytes([b]) for b in range(256)}
            )
            # Its pattern takes a blank to the word behind it. Added tokens may hold blanks, dropout
            # cuts a word differently each time, and marks on pieces are no bytes of the text.
            by_words = (
                self.spells
                and tokenizer.pre_tokenizer.use_regex
                and all(t.special for t in tokenizer.get_added_tokens_decoder().values())
                and isinstance(bpe := tokenizer.model, BPE)
                and not (bpe.dropout or bpe.continuing_subword_prefix or bpe.end_of_word_suffix)
            )
        self.size = np.array([len(b) for b in self.bytes], dtype=np.int64)
        if by_words:
            self.encode = Words(self.encode, self.size)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The tokens of a blank and the text; none where their bytes are not those."""
        out = []
        for text, ids in zip(texts, self.encode(texts)):
            found = np.asarray(ids, dtype=np.int64)
            whole = b" " + text.encode()
            same = len(whole) > 1 and self.size[found].sum() == len(whole)
            if same and not self.spells:
                same = b"".join(map(self.bytes.__getitem__, found.tolist())) == whole
            out.append(found if same else found[:0])
        return out

    def flat(self, texts: list[str], *, words: bool) -> tuple[np.ndarray, np.ndarray]:
        """``ids`` of all texts, text after text, and their numbers. ``words``: of different words, not to be kept."""
        if not words:
            found = self.ids(texts)
            return np.concatenate([np.empty(0, dtype=np.int64), *found]), np.array([len(x) for x in found])
        sizes = _spelt(texts)
        ids, n = self.encode.of(texts, sizes)
        ends = np.cumsum(np.append(0, n))
        same = (sizes > 1) & (np.diff(np.append(0, np.cumsum(self.size[ids]))[ends]) == sizes)
        if not self.spells:
            tokens = [*map(self.bytes.__getitem__, ids.tolist())]
            if not same.all() or b"".join(tokens) != (" " + " ".join(texts)).encode():
                for i in np.flatnonzero(same).tolist():
                    same[i] = b"".join(tokens[ends[i] : ends[i + 1]]) == b" " + texts[i].encode()
        return ids[np.repeat(same, n)].astype(np.int64), np.where(same, n, 0)


def _begins_anew(model: bytes) -> bool:
    """Whether a .model has a token begin at each blank behind another character, whatever the text.

    Merges of pairs (BPE) do so if no piece holds a blank behind another character. All texts must
    also spell themselves behind one more blank: no rule rewrites them, and a character that is no
    piece becomes its bytes. The best sum of scores (unigram) may be rounded otherwise in a longer text.
    """
    try:
        from sentencepiece import sentencepiece_model_pb2
    except ImportError:  # it needs protobuf, the library itself does not
        return False
    spec = sentencepiece_model_pb2.ModelProto.FromString(model)
    training, rules = spec.trainer_spec, spec.normalizer_spec
    return (
        training.model_type == training.BPE
        and training.byte_fallback
        and not training.treat_whitespace_as_suffix
        and rules.add_dummy_prefix
        and rules.escape_whitespaces
        and not (rules.remove_extra_whitespaces or rules.precompiled_charsmap)
        and not any(re.search("[^\u2581 ][\u2581 ]", p.piece) for p in spec.pieces)
    )


def _byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: itself if it prints, else a spare one."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + n): b for n, b in enumerate(spare)}


@lru_cache(maxsize=2)
def vocabulary(kind: str, model: bytes) -> Vocabulary:
    return Vocabulary(kind, model)


@lru_cache(maxsize=1)
def _alignments(first: tuple[str, bytes], second: tuple[str, bytes]) -> Alignments:
    return Alignments(vocabulary(*first), vocabulary(*second))


@lru_cache(maxsize=2)
def _digits(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers below n as rows of ASCII digits and a comma, their lengths, and which bytes they use."""
    texts = [f"{i}," for i in range(n)]
    length = np.array([len(t) for t in texts])
    table = np.array(texts, dtype=f"S{length.max()}").view(np.uint8).reshape(n, -1)
    return table, length, np.arange(table.shape[1]) < length[:, None]


def merge(
    ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of the linked tokens (a, b), and of the pairs that end together (a, b).

    ``ends_a`` and ``ends_b`` are the bytes at which the tokens of all documents of a block end,
    counted from the block's first byte; ``first_a`` is the place of each document's first token.
    """
    total = len(ends_a)
    none = np.empty(0, dtype=np.int64)
    if not total:
        return none, none, none, none
    # A lane starts at every document and after every LANE tokens of one.
    sizes = np.diff(np.append(first_a, total))
    lanes = -(-sizes // LANE)
    number = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    a = np.repeat(first_a, lanes) + number * LANE
    stop = np.append(a[1:], total)
    starts = np.concatenate([[0], ends_a[:-1]])
    b = np.searchsorted(ends_b, starts[a], side="right")  # the token over the lane's first byte
    link_a, link_b, cut_a, cut_b = [], [], [], []
    while len(a):
        link_a.append(a)
        link_b.append(b)
        end_a, end_b = ends_a[a], ends_b[b]
        both = end_a == end_b
        cut_a.append(a[both])
        cut_b.append(b[both])
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        left = a < stop
        if not left.all():  # lanes at their end leave the vector
            a, b, stop = a[left], b[left], stop[left]
    cut_a, cut_b = np.concatenate(cut_a), np.concatenate(cut_b)
    return np.concatenate(link_a), np.concatenate(link_b), np.sort(cut_a), np.sort(cut_b)


def group_texts(
    va: Vocabulary, vb: Vocabulary, ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray
) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;`` of all groups in order, and the byte after each group's."""
    size_a = np.diff(np.concatenate([[-1], cut_a]))
    size_b = np.diff(np.concatenate([[-1], cut_b]))
    # Tokens in the order of the text: those of a group's first tokenizer, then of its second.
    place_a = np.arange(len(ids_a)) + np.repeat(cut_b - size_b + 1, size_a)
    place_b = np.arange(len(ids_b)) + np.repeat(cut_a + 1, size_b)
    ids = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
    ids[place_a], ids[place_b] = ids_a, ids_b
    table, length, used = _digits(max(len(va.bytes), len(vb.bytes)))
    size = length[ids]
    ends = np.cumsum(size)
    out = table[ids]
    for places, mark in ((place_a[cut_a], b"|"), (place_b[cut_b], b";")):
        out[places, size[places] - 1] = ord(mark)
    return out[used[ids]].tobytes(), ends[place_b[cut_b]]


class Aligned:
    """The alignments of a block of texts; ``words``: of different words, as in ``Vocabulary.flat``."""

    def __init__(self, va: Vocabulary, vb: Vocabulary, texts: list[str], *, words: bool = False):
        (ids_a, n_a), (ids_b, n_b) = (v.flat(texts, words=words) for v in (va, vb))
        whole = (n_a > 0) & (n_b > 0)
        ids_a, ids_b = ids_a[np.repeat(whole, n_a)], ids_b[np.repeat(whole, n_b)]
        n = len(texts)
        self.n_a, self.n_b = n_a * whole, n_b * whole
        ends_a, ends_b = np.cumsum(va.size[ids_a]), np.cumsum(vb.size[ids_b])
        first = (np.cumsum(self.n_a) - self.n_a)[self.n_a > 0]
        link_a, link_b, cut_a, cut_b = merge(ends_a, ends_b, first)
        text = np.repeat(np.arange(n), self.n_a)
        self.n_links = np.bincount(text[link_a], minlength=n)
        self.n_groups = np.bincount(text[cut_a], minlength=n)
        pieces, upto = group_texts(va, vb, ids_a, ids_b, cut_a, cut_b)
        ends = np.concatenate([[0], upto])[np.cumsum(self.n_groups)]
        self.groups = []
        start = 0
        for end in ends.tolist():
            self.groups.append(pieces[start : max(start, end - 1)])
            start = end
        #: Linked ids of each text's links, text after text, as one number.
        pair = ids_a[link_a] * len(vb.bytes) + ids_b[link_b]
        self.pairs = pair[np.argsort(text[link_a], kind="stable")]


class Growing:
    """An array to whose end rows are put."""

    def __init__(self, rows: np.ndarray):
        self.rows, self.n = rows, len(rows)

    def extend(self, rows: np.ndarray) -> None:
        n = self.n + len(rows)
        if n > len(self.rows):
            longer = np.empty((n + n // 2, *rows.shape[1:]), dtype=rows.dtype)
            longer[: self.n] = self.rows[: self.n]
            self.rows = longer
        self.rows[self.n : n] = rows
        self.n = n


class Alignments:
    """The alignments of documents, put together from those of their words.

    Both tokenizers that begin anew at ``BETWEEN`` end before it too, so no group or link goes
    across. A document has no tokens if one of its words has none. With other tokenizers a
    document is one word, and no word is kept.
    """

    def __init__(self, va: Vocabulary, vb: Vocabulary):
        self.va, self.vb = va, vb
        self.by_words = isinstance(va.encode, Words) and isinstance(vb.encode, Words)
        self.width = len(va.bytes) * len(vb.bytes)
        self.place, self.groups = {}, []
        #: Of each word: n_a, n_b, n_groups, n_links, and the place of its first link in ``pairs``.
        self.numbers = Growing(np.empty((0, 5), dtype=np.int64))
        self.pairs = Growing(np.empty(0, dtype=np.int64))
        self._keep([])

    def _keep(self, places: list[int]) -> None:
        """Gives up all words but those at these places."""
        words = [*self.place]
        kept = [words[p] for p in places]
        self.place = defaultdict(count(len(kept)).__next__, zip(kept, count()))  # a new word takes the next place
        self.groups = [self.groups[p] for p in places]
        numbers = self.numbers.rows[np.array(places, dtype=np.int64)]
        self.pairs = Growing(self.pairs.rows[_runs(numbers[:, 4], numbers[:, 3])])
        numbers[:, 4] = np.cumsum(numbers[:, 3]) - numbers[:, 3]
        self.numbers = Growing(numbers)
        self.uses, self.chars = np.zeros(len(kept), dtype=np.int64), sum(map(len, kept))

    def _add(self, words: list[str]) -> None:
        found = Aligned(self.va, self.vb, words, words=self.by_words)
        first = self.pairs.n + np.cumsum(found.n_links) - found.n_links
        self.numbers.extend(np.stack([found.n_a, found.n_b, found.n_groups, found.n_links, first], axis=1))
        self.pairs.extend(found.pairs)
        self.groups += found.groups
        self.chars += sum(map(len, words))

    def __call__(self, texts: list[str]) -> SimpleNamespace:
        words = [BETWEEN.split(text) if self.by_words else [text] for text in texts]
        known = len(self.place)
        flat = [*map(self.place.__getitem__, chain.from_iterable(words))]
        if new := len(self.place) - known:
            self._add([*islice(reversed(self.place), new)][::-1])
        n_words = np.array([len(w) for w in words])
        ends = np.cumsum(n_words)
        place, doc = np.array(flat), np.repeat(np.arange(len(texts)), n_words)
        uses = np.bincount(place, minlength=len(self.place))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        numbers = self.numbers.rows[place]
        whole = np.minimum.reduceat(numbers[:, 0], ends - n_words) > 0
        groups = [
            b";".join(map(self.groups.__getitem__, flat[end - n : end])) if w else b""
            for end, n, w in zip(ends.tolist(), n_words.tolist(), whole.tolist())
        ]
        numbers[~whole[doc]] = 0
        sums = np.add.reduceat(numbers, ends - n_words, axis=0)
        # Distinct linked ids of each document, as one number, and how many links of it hold them.
        pair = self.pairs.rows[_runs(numbers[:, 4], numbers[:, 3])]
        keys, times = np.unique(np.repeat(doc, numbers[:, 3]) * self.width + pair, return_counts=True)
        if not self.by_words:
            self._keep([])
        elif self.chars + self.pairs.n > HELD:
            self._keep(np.sort(np.argsort(-self.uses, kind="stable")[: len(self.uses) // 2]).tolist())
        return SimpleNamespace(
            n_a=sums[:, 0], n_b=sums[:, 1], n_groups=sums[:, 2], n_links=sums[:, 3], groups=groups,
            pairs=keys % self.width, times=times, n_pairs=np.bincount(keys // self.width, minlength=len(texts)),
        )


DOCUMENT = (
    "n_a long, n_b long, n_groups long, n_links long, {groups}, chunk long, "
    "pairs array<int>, times array<int>, ids array<long>, total array<long>"
)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of blocks of a batch; a text longer than a block is one of its own."""
    first, texts, size = 0, [], 0
    for row, text in enumerate(batch.column("text").to_pylist()):
        if texts and size + len(text) > BLOCK:
            yield first, texts
            first, texts, size = row, [], 0
        texts.append(text)
        size += len(text)
    if texts:
        yield first, texts


def _align(models, column: str, digest: Callable[[bytes], str]):
    """Rows of documents, and after some MB of them a row with the linked ids of all of them.

    A document's row has its linked ids as places in the ``ids`` of its chunk's row.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligned = _alignments(*models)
        chunk, done, size = TaskContext.get().partitionId() << 32, [], 0

        def flush(schema: pa.Schema) -> pa.RecordBatch:
            pairs = np.concatenate([x.pairs for _, x in done])
            ids, place = np.unique(pairs, return_inverse=True)
            times = np.concatenate([x.times for _, x in done])
            total = np.bincount(place, weights=times, minlength=len(ids)).astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum(np.concatenate([x.n_pairs for _, x in done]))])
            offsets = pa.array(np.append(offsets, offsets[-1]), pa.int32())
            n = len(offsets) - 2
            numbers = {
                name: pa.array(np.append(np.concatenate([getattr(x, name) for _, x in done]), 0), pa.int64())
                for name in ("n_a", "n_b", "n_groups", "n_links")
            }
            doc = pa.concat_arrays([x for x, _ in done])
            of_chunk = [[]] * n
            return pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([doc, pa.nulls(1, doc.type)]),
                    *numbers.values(),
                    pa.array([digest(g) for _, x in done for g in x.groups] + [None], pa.string()),
                    pa.array(np.full(n + 1, chunk), pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(place, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
                    pa.array([*of_chunk, ids], pa.list_(pa.int64())),
                    pa.array([*of_chunk, total], pa.list_(pa.int64())),
                ],
                ["doc_id", *numbers, column, "chunk", "pairs", "times", "ids", "total"],
            )

        for batch in batches:
            for row, texts in _blocks(batch):
                done.append((batch.column("doc_id").slice(row, len(texts)), aligned(texts)))
                size += sum(map(len, texts))
                if size >= CHUNK:
                    yield flush(batch.schema)
                    chunk, done, size = chunk + 1, [], 0
        if done:
            yield flush(batch.schema)

    return align


def _score(documents: pa.Table, linked: pa.Table) -> pa.Table:
    """n_best and count_sum of the documents of a chunk from the corpus-wide counts of its ids."""
    order = np.argsort(linked.column("place").to_numpy())
    count = linked.column("count").to_numpy()[order]
    best = linked.column("best").to_numpy(zero_copy_only=False)[order]
    pairs = documents.column("pairs").combine_chunks()
    offsets = pairs.offsets.to_numpy()
    offsets = offsets - offsets[0]
    place = pairs.flatten().to_numpy()
    times = documents.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
    sums = {}
    for name, values in (("n_best", best[place] * times), ("count_sum", count[place] * times)):
        upto = np.concatenate([[0], np.cumsum(values)])
        sums[name] = pa.array(upto[offsets[1:]] - upto[offsets[:-1]], pa.int64())
    out = documents.drop_columns(["chunk", "pairs", "times"])
    for name, values in sums.items():
        out = out.append_column(name, values)
    return out


def align_tokens(docs: DataFrame, first: str, second: str, *, digest: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum.

    ``first`` and ``second`` are paths of .json (byte-level) or .model files on the driver; their
    content goes to the tasks. The tokenizers encode a blank and the whole text, special strings
    as text. Two tokens are linked where they share a byte, and tokens between two bytes at which
    both end are a group; ``groups`` lists them as ``a1,a2|b1;a3|b2,b3`` (with ``digest`` instead
    groups_sha256, its SHA-256 in hex, '' for no tokens). The count of a pair of ids is the number of
    links of all documents that hold it; ``n_best`` are the links whose count is the largest of
    their second id, ``count_sum`` is the sum of the counts over the links.

    Null and empty texts, and texts whose tokens do not spell the blank and the text: zeros and
    no groups. Null and repeated ids: each row has its own. Empty table: no rows. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "alignment")
    models = []
    for path in (first, second):
        with open(path, "rb") as file:
            models.append(("sentencepiece" if path.endswith(".model") else "tokenizers", file.read()))
    width = len(vocabulary(*models[1]).bytes)
    column = "groups_sha256" if digest else "groups"
    doc = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"
    texts = docs.select("doc_id", whole_text().alias("text"))
    encode = _align(models, column, _sha256 if digest else bytes.decode)
    schema = f"{doc}, {DOCUMENT.format(groups=column + ' string')}"
    rows = scratch.store(texts.mapInArrow(encode, schema), "documents")
    # Ids of a chunk are counted there, so a pair that every document holds is one row per chunk.
    of_chunk = rows.where(f"{column} IS NULL").select("chunk", F.posexplode(F.arrays_zip("ids", "total")).alias("place", "x"))
    linked = scratch.store(of_chunk.select("chunk", "place", "x.ids", "x.total"), "linked")
    counts = linked.groupBy("ids").agg(F.sum("total").alias("count"))
    counts = scratch.store(counts.withColumn("b", F.pmod("ids", F.lit(width))), "counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    known = counts.join(most, "b").select("ids", "count", (F.col("count") == F.col("most")).alias("best"))
    scored = linked.select("chunk", "place", "ids").join(scratch.store(known, "known"), "ids").drop("ids")
    documents = rows.where(f"{column} IS NOT NULL").drop("ids", "total")
    out = [c for c in documents.columns if c not in ("chunk", "pairs", "times")]
    kinds = ", ".join(f"{c} {documents.schema[c].dataType.simpleString()}" for c in out)
    return (
        documents.groupBy("chunk").cogroup(scored.groupBy("chunk"))
        .applyInArrow(_score, f"{kinds}, n_best long, count_sum long")
    )


def _sha256(groups: bytes) -> str:
    return hashlib.sha256(groups).hexdigest() if groups else ""
