"""Line deduplication, alignment of tokenizers and spelling variants against plain versions."""

from __future__ import annotations

import brute
import numpy as np
import pytest
from samples import awkward_rows, prose

from cohortscope.llm import alignment, lines
from cohortscope.llm.alignment import align_tokens
from cohortscope.llm.lines import PerfectHash, drop_repeated_lines
from cohortscope.llm.spelling import count_words, spelling_variants

public_tokenizers = pytest.importorskip("public_tokenizers")
MODELS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def sorted_rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# Lines


def test_perfect_hash_numbers_every_key_once():
    keys = np.random.default_rng(1).integers(0, 2**64, (20_000, 2), dtype=np.uint64)
    index = PerfectHash.of(keys)
    again = PerfectHash(index.sizes, index.bits)
    assert sorted(again.numbers(keys)) == list(range(len(keys)))
    assert len(index.bits) < len(keys)  # fewer than 8 bits a key
    assert PerfectHash.of(keys[:0]).numbers(keys).max() == -1


def line_rows():
    shared = ["A line of forty code points or more, shared", "ñandú " * 7, "x" * 39]
    rows = []
    for doc in range(9):
        text = "\n".join(prose(doc * 10 + i, 12) for i in range(3))
        text = f" {shared[0].upper()}\t\n{text}\n{shared[0]}\r\n{shared[1]}\n{shared[2]}\n\n"
        rows.append((doc, text if doc != 4 else text.replace(shared[1], "other")))
    rows += [(20, shared[0]), (20, shared[1]), (None, shared[0] + "\n"), (None, "end"), (3, shared[1])]
    four = prose(99, 20)
    return rows + [(d, four) for d in (30, 31, 32, 33, 33)] + [(40, None), (41, ""), (42, "\n\n")]


@pytest.mark.parametrize("limits", [(500_000, 1_000_000), (3, 5)])
def test_lines(spark, monkeypatch, limits):
    monkeypatch.setattr(lines, "SHARD_LINES", limits[0])
    monkeypatch.setattr(lines, "TASK_LINES", limits[1])
    rows = line_rows()
    found = drop_repeated_lines(documents(spark, rows))
    expected = brute.repeated_lines(rows)
    assert sorted_rows(found, "doc_id", "n_lines", "n_dropped", "text") == expected
    assert sum(r[2] for r in expected) > 12


def test_lines_of_few_documents_and_short_ones(spark):
    rows = line_rows()
    found = drop_repeated_lines(documents(spark, rows), min_chars=1, min_docs=2)
    assert sorted_rows(found, "doc_id", "n_lines", "n_dropped", "text") == brute.repeated_lines(rows, 1, 2)


def test_awkward_lines(spark, awkward, nothing):
    found = drop_repeated_lines(awkward, min_docs=2)
    expected = brute.repeated_lines([(d, t) for d, t, _ in awkward_rows()], 40, 2)
    assert sorted_rows(found, "doc_id", "n_lines", "n_dropped", "text") == expected
    assert drop_repeated_lines(nothing).count() == 0
    named = spark.createDataFrame([("a", "l" * 50), ("b", "l" * 50)], "doc_id string, text string")
    assert sorted_rows(drop_repeated_lines(named, min_docs=2), "doc_id", "text") == [("a", ""), ("b", "l" * 50)]


# Tokens


def token_rows():
    return [(d, t) for d, t, _ in awkward_rows()] + [
        (50, "a  b\n\x00 c é 漢🙂 <|endoftext|> <s>x</s>"),
        (51, "▁ a blank of the vocabulary"),
        (52, "lead\r\n\tand   trailing  "),
        (53, "=" * 3000 + " 12345678901234567890 don't"),
        (54, "漢字" * 400 + "🙂" * 200),
        (55, " "),
    ]


def test_alignment(spark, monkeypatch):
    rows = token_rows()
    expected = brute.alignment(rows, *MODELS)
    assert [r for r in expected if r[0] == 51][0][1:5] == (0, 0, 0, 0)
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    assert sorted_rows(align_tokens(documents(spark, rows), *MODELS), *columns) == expected
    # Blocks, lanes and chunks of a few tokens, as if the texts were much longer.
    for name, value in (("BLOCK", 700), ("LANE", 5), ("CHUNK", 2000)):
        monkeypatch.setattr(alignment, name, value)
    merged = [r for batch in _locally(rows) for r in batch]
    assert sorted(merged, key=repr) == sorted(((r[0], *r[1:5], r[7]) for r in expected), key=repr)


def _locally(rows):
    """Documents' rows of the first pass, run here, where the sizes above are changed."""
    import pyarrow as pa
    from pyspark import TaskContext

    class Task:
        def partitionId(self):
            return 0

    known, TaskContext.get = TaskContext.get, lambda: Task()
    try:
        models = [
            (kind, open(path, "rb").read()) for kind, path in zip(("tokenizers", "sentencepiece"), MODELS)
        ]
        batch = pa.RecordBatch.from_pydict(
            {"doc_id": pa.array([d for d, _ in rows], pa.int64()), "text": [t or "" for _, t in rows]}
        )
        found = list(alignment._align(models, "groups", bytes.decode)([batch]))
    finally:
        TaskContext.get = known
    assert len(found) > 3
    for part in found:
        yield [
            (r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups"])
            for r in part.to_pylist() if r["groups"] is not None
        ]


class Counted:
    """The library's tokenizer, and the characters that it is given."""

    def __init__(self, tokenizer):
        self.__dict__.update(tokenizer=tokenizer, given=0)

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def __setattr__(self, name, value):
        setattr(self.tokenizer, name, value)

    def encode_batch_fast(self, texts, **options):
        self.__dict__["given"] += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_words_are_encoded_once(monkeypatch):
    import tokenizers

    made, from_str = [], tokenizers.Tokenizer.from_str

    class Library:
        @staticmethod
        def from_str(text):
            made.append(Counted(from_str(text)))
            return made[-1]

    monkeypatch.setattr(tokenizers, "Tokenizer", Library)
    with open(MODELS[0], "rb") as file:
        known = alignment.Vocabulary("tokenizers", file.read())
    words = [f"word{i}" for i in range(40)]
    texts = [" ".join(words[i:] + words[:i]) for i in range(40)]
    found = [known.ids(texts[:20]), known.ids(texts[20:])]
    assert made[0].given == sum(1 + len(w) for w in words)
    expected = [e.ids for e in made[0].tokenizer.encode_batch([" " + t for t in texts])]
    assert [ids.tolist() for part in found for ids in part] == expected


def test_ids_by_words_are_those_of_whole_texts(monkeypatch):
    import random

    from tokenizers import Tokenizer

    monkeypatch.setattr(alignment, "KEPT", 500)  # kept words are given up between texts
    draw = random.Random(7)
    parts = [*"  abz'sS.!_~9\n\t\r\x00\x1c\x85\xa0é漢🙂٣½ª\u0301\u180e\u200b\u2028\u3000\ufeff"]
    parts += [" ", " ", " the", "don't", "'ll 's", "<|endoftext|>", " x  y"]
    texts = ["", " ", "a", " a ", "a b", "\n a"]
    texts += ["".join(draw.choices(parts, k=draw.randrange(1, 40))) for _ in range(3000)]
    plain = Tokenizer.from_file(MODELS[0])
    added, unsplit, dropping = (Tokenizer.from_file(MODELS[0]) for _ in range(3))
    added.add_tokens(["the x", "b <"])
    unsplit.pre_tokenizer.use_regex = False
    dropping.model.dropout = 0.5
    for tokenizer, by_words in ((plain, True), (added, False), (unsplit, False), (dropping, False)):
        known = alignment.Vocabulary("tokenizers", tokenizer.to_str().encode())
        assert isinstance(known.encode, alignment.Words) == by_words
        if tokenizer is dropping:  # no two calls agree
            continue
        tokenizer.encode_special_tokens = True
        expected = [e.ids for e in tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)]
        found = [ids.tolist() for i in range(0, len(texts), 50) for ids in known.ids(texts[i : i + 50])]
        assert found[1:] == expected[1:] and found[0] == []


def changed(**fields):
    """The .model with other fields, such as ``normalizer_spec__add_dummy_prefix``; ``piece`` is put at its end."""
    from sentencepiece import sentencepiece_model_pb2

    with open(MODELS[1], "rb") as file:
        spec = sentencepiece_model_pb2.ModelProto.FromString(file.read())
    if piece := fields.pop("piece", None):
        spec.pieces.add(piece=piece, score=1.0)
    for field, value in fields.items():
        part, name = field.split("__")
        setattr(getattr(spec, part), name, value)
    if not spec.trainer_spec.byte_fallback:  # the library then takes no pieces of bytes
        pieces = [p for p in spec.pieces if p.type != p.BYTE]
        del spec.pieces[:]
        spec.pieces.extend(pieces)
    return spec.SerializeToString()


def test_words_are_aligned_once(monkeypatch):
    import pyarrow as pa
    import sentencepiece
    from pyspark import TaskContext

    given = []

    class Library(sentencepiece.SentencePieceProcessor):
        def encode(self, texts, **options):
            given.extend(texts)
            return super().encode(texts, **options)

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Library)
    monkeypatch.setattr(TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    monkeypatch.setattr(alignment, "BLOCK", 2000)
    words = [f"word{i}" for i in range(40)]
    texts = [" ".join(words[i:] + words[:i]) for i in range(40)]
    with open(MODELS[0], "rb") as file:  # no process knows a .model of another name
        models = ("tokenizers", file.read()), ("sentencepiece", changed(trainer_spec__model_prefix="counted"))
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(40), pa.int64()), "text": texts})
    found = [r for part in alignment._align(models, "groups", bytes.decode)([batch]) for r in part.to_pylist()]
    assert sum(map(len, given)) <= sum(1 + len(w) for w in words)
    expected = brute.alignment([*enumerate(texts)], *MODELS)
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")
    assert [tuple(r[c] for c in columns) for r in found[:40]] == sorted((*r[:5], r[7]) for r in expected)


def test_alignments_by_words_are_those_of_whole_texts(monkeypatch):
    import random

    monkeypatch.setattr(alignment, "HELD", 600)  # kept words are given up between texts
    monkeypatch.setattr(alignment, "MANY", 3)
    draw = random.Random(8)
    parts = [*"  abz'sS.!_~9\n\t\r\x00\x1c\x85\xa0é漢🙂٣½ª\u0301\u180e\u200b\u2028\u3000\ufeff"]
    parts += [" ", " ", " the", "don't", "'ll 's", "<|endoftext|>", " <s>", "<0x0A>", "<unk>", " x  y", "1234"]
    texts = ["", " ", "a", " a ", "a b", "\n a", "\u2581", "a \u2581", "b\u2581a c", "a b\u2581 c", "c\u2581"]
    texts += ["".join(draw.choices(parts, k=draw.randrange(1, 40))) for _ in range(3000)]
    draw.shuffle(texts)
    models = [(k, open(p, "rb").read()) for k, p in zip(("tokenizers", "sentencepiece"), MODELS)]
    words, whole = (alignment.Alignments(*(alignment.Vocabulary(*m) for m in models)) for _ in range(2))
    assert words.by_words
    whole.by_words = False
    for vocabulary in (whole.va, whole.vb):
        vocabulary.encode = vocabulary.encode.encode  # the libraries, without their words
    for i in range(0, len(texts), 50):
        known = set(words.place)
        found, expected = (vars(x(texts[i : i + 50])) for x in (words, whole))
        assert {k: [*v] for k, v in found.items()} == {k: [*v] for k, v in expected.items()}
        assert 0 < found["n_a"].astype(bool).sum()
    assert known and known - set(words.place)


def test_models_that_do_not_begin_anew():
    from sentencepiece import SentencePieceProcessor

    with open(MODELS[0], "rb") as file:
        byte_level = file.read()
    text = "the top  of the top\n the top "
    for fields in (
        {"piece": "e\u2581t"},
        {"trainer_spec__model_type": 1},
        {"trainer_spec__byte_fallback": False},
        {"normalizer_spec__add_dummy_prefix": False},
        {"normalizer_spec__remove_extra_whitespaces": True},
    ):
        model = changed(**fields)
        assert not alignment._begins_anew(model)
        vocabularies = alignment.Vocabulary("tokenizers", byte_level), alignment.Vocabulary("sentencepiece", model)
        aligned = alignment.Alignments(*vocabularies)
        ids = SentencePieceProcessor(model_proto=model).encode(text)
        spells = b"".join(map(vocabularies[1].bytes.__getitem__, ids)) == b" " + text.encode()
        assert not aligned.by_words and aligned([text]).n_b.tolist() == [len(ids) if spells else 0]
        assert not aligned.place


def test_awkward_alignment(awkward, nothing):
    assert align_tokens(awkward, *MODELS).count() == len(awkward_rows())
    assert align_tokens(nothing, *MODELS).count() == 0


def test_digest_of_groups(spark):
    rows = [(1, "some words"), (2, ""), (3, "▁")]
    found = align_tokens(documents(spark, rows), *MODELS, digest=True)
    assert "groups" not in found.columns
    assert sorted_rows(found, "doc_id", "groups_sha256")[1:] == [(2, ""), (3, "")]


# Words


def word_rows():
    rows = [(d, t) for d, t, _ in awkward_rows()]
    rows += [(n, " ".join(prose(n % 7, 30, "aab") for _ in range(4))) for n in range(60, 90)]
    rows += [(n, "banana bananas banan anana Bananá baanna banbana banana banana ÀÉbcde àÉbcde") for n in range(5)]
    rows += [(n, "z" * 300 + " " + "z" * 301 + " " + "z" * 150 + "y" + "z" * 149) for n in range(100, 104)]
    return rows + [(200 + n, "a" * (5 + n % 9)) for n in range(40)]


@pytest.mark.parametrize("typos", [97, 5, None])
def test_spelling(spark, typos):
    rows = word_rows()
    found = spelling_variants(count_words(documents(spark, rows), typos=typos))
    expected = brute.spelling(rows, typos)
    assert sorted_rows(found, "word", "form", "root", "n", "n_near", "form_n") == expected
    assert sum(r[1] is not None for r in expected) > 3


def test_roots_follow_forms_to_the_last(spark):
    chain = [("a" * (5 + n), 3 * 2**n) for n in range(9)] + [("b" * 6, 4), ("c" + "b" * 5, 8)]
    found = spelling_variants(spark.createDataFrame(chain, "word string, n long"))
    roots = {r.word: (r.form, r.root) for r in found.collect()}
    assert roots["aaaaa"] == ("a" * 6, "a" * 13) and roots["a" * 13] == (None, "a" * 13)
    assert roots["bbbbbb"] == ("cbbbbb", "cbbbbb")


def test_short_and_rare_words(spark):
    rows = word_rows()[:40]
    found = spelling_variants(count_words(documents(spark, rows)), min_length=3, min_count=1, ratio=1.5)
    expected = brute.spelling(rows, None, 3, 1, 1.5)
    assert sorted_rows(found, "word", "form", "root", "n", "n_near", "form_n") == expected
    with pytest.raises(ValueError):
        spelling_variants(count_words(documents(spark, rows)), min_length=2)


def test_awkward_words(spark, awkward, nothing):
    known = spelling_variants(count_words(awkward), min_count=1)
    assert sorted_rows(known, "word", "form", "root", "n", "n_near", "form_n") == brute.spelling(
        [(d, t) for d, t, _ in awkward_rows()], None, 5, 1
    )
    assert spelling_variants(count_words(nothing)).count() == 0
    words = [("apple", 5, "x"), ("apple", 4, "y"), ("appel", 2, None), ("applee", 3, None), (None, 7, None), ("apples", None, None)]
    table = spark.createDataFrame(words, "word string, n long, root string")
    assert sorted_rows(spelling_variants(table, min_count=1), "word", "form", "n") == [
        ("appel", None, 2), ("apple", None, 9), ("applee", "apple", 3),
    ]
