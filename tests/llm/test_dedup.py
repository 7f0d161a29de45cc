"""Exact, near and substring duplicates against plain versions."""

from __future__ import annotations

import brute
import numpy as np
import pytest
from samples import awkward_rows, prose

from cohortscope.llm import regions, suffixes
from cohortscope.llm.components import components
from cohortscope.llm.exact_dedup import drop_exact_copies, exact_dedup
from cohortscope.llm.jaccard import keep_one_of_similar, needed, similar_documents
from cohortscope.llm.scratch import Scratch
from cohortscope.llm.substring import remove_repeated_phrases
from cohortscope.llm.suffixes import remove_repeated_strings

SF_DIR = "/root/testdata/sf0.001"
PAIRS = [(d, t) for d, t, _ in awkward_rows()]


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
PHRASES = ("doc_id", "n_words", "n_removed", "kept_sha256")
STRINGS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("keep, pick", [("smallest", min), ("largest", max)])
def test_exact(awkward, keep, pick):
    assert rows(exact_dedup(awkward, keep), *EXACT) == brute.exact_dedup(PAIRS, pick)


def test_exact_rows_that_stay(awkward):
    kept = drop_exact_copies(awkward, "largest")
    assert kept.columns == awkward.columns
    texts = [brute.ascii_lower(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({brute.ascii_lower(t) for _, t in PAIRS})


def test_equal_hashes_of_different_texts_stay_apart(spark, monkeypatch):
    from cohortscope.llm import exact_dedup as module

    class Same:
        def __getattr__(self, name):
            from pyspark.sql import functions as F

            return (lambda _: F.lit("same")) if name == "md5" else getattr(F, name)

    monkeypatch.setattr(module, "F", Same())
    found = exact_dedup(spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id long, text string"))
    assert rows(found, "doc_id", "keep_id", "group_size") == [(1, 1, 2), (2, 2, 1), (3, 1, 2)]


def test_phrases(awkward):
    assert rows(remove_repeated_phrases(awkward), *PHRASES) == brute.repeated_phrases(PAIRS)


def test_strings(awkward):
    assert rows(remove_repeated_strings(awkward), *STRINGS) == brute.repeated_strings(PAIRS)


def test_frequent_windows_give_the_same(awkward, monkeypatch):
    """Every anchor that occurs twice is compared by hashes instead of in one task."""
    original = regions.with_recurring_ranges

    def often(*args, **options):
        return original(*args, **options, frequent=1)

    from cohortscope.llm import substring

    monkeypatch.setattr(substring, "with_recurring_ranges", often)
    monkeypatch.setattr(suffixes, "with_recurring_ranges", often)
    assert rows(remove_repeated_phrases(awkward), *PHRASES) == brute.repeated_phrases(PAIRS)
    assert rows(remove_repeated_strings(awkward), *STRINGS) == brute.repeated_strings(PAIRS)


def test_substrings_of_the_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows(remove_repeated_phrases(docs), *PHRASES) == brute.repeated_phrases(pairs)
    assert rows(remove_repeated_strings(docs), *STRINGS) == brute.repeated_strings(pairs)


def test_interval_expansion_against_sorted_suffixes():
    pick = np.random.default_rng(5)
    for n, kinds, length in ((1, 2, 3), (60, 2, 4), (400, 3, 8), (900, 4, 5)):
        pieces = [bytes(pick.integers(97, 97 + kinds, size=int(pick.integers(0, n)) + 1, dtype=np.uint8))
                  for _ in range(5)]
        strings = [p[i : i + length] for p in pieces for i in range(len(p) - length + 1)]
        found = suffixes.repeated_starts(pieces, length)
        flat = [bool(x) for marks in found for x in marks]
        assert flat == [strings.count(s) > 1 for s in strings]


def test_similar(awkward):
    found = similar_documents(awkward)
    columns = ("doc_id", "class_id", "n_links", "n_text_links")
    expected = brute.similar(PAIRS)
    # A text without words is a class of its own even where rows share its id.
    assert rows(found, *columns) == expected
    kept = keep_one_of_similar(awkward)
    assert kept.columns == awkward.columns
    assert found.where("kept").count() == kept.count() == 17


def test_similar_blocks_and_chains(spark, monkeypatch):
    """A cluster over several blocks, whose ends are linked by others only."""
    from cohortscope.llm import jaccard

    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 4)
    texts, current = [], prose(1, 104).split()
    for i in range(30):
        texts.append((i, " ".join(current)))
        current[(i * 7) % 104] = f"new{i}"
    df = spark.createDataFrame(texts, "doc_id long, text string")
    columns = ("doc_id", "class_id", "n_links", "n_text_links")
    assert rows(similar_documents(df), *columns) == brute.similar(texts)


def test_posterior_limits_rise():
    least = needed(0.8, 1e-5)
    assert list(least) == sorted(least) and 70 < least[-1] < 90 and least[0] < 10


def test_components(spark):
    path = [(i, i + 1) for i in range(100, 140)] + [(7, 9), (9, 7), (5, 5), (8, 7)]
    found = components(spark.createDataFrame(path, "a long, b long"), Scratch(spark, "test"))
    assert rows(found, "node", "label") == sorted(
        [(i, 100) for i in range(100, 141)] + [(7, 7), (8, 7), (9, 7)], key=repr
    )


def test_empty_tables(nothing):
    assert exact_dedup(nothing).count() == 0 and drop_exact_copies(nothing).count() == 0
    assert remove_repeated_phrases(nothing).count() == 0
    assert remove_repeated_strings(nothing).count() == 0
    assert similar_documents(nothing).count() == 0 and keep_one_of_similar(nothing).count() == 0


@pytest.mark.parametrize("text", ["", "one two three", "one two three four five six seven"])
def test_only_texts_shorter_than_a_window(spark, text):
    docs = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string").coalesce(1)
    for remove in (remove_repeated_phrases, remove_repeated_strings):
        assert [r.n_removed for r in remove(docs).collect()] == [0, 0]


def test_components_end_only_when_nothing_changes(spark, monkeypatch):
    import sys

    module = sys.modules["cohortscope.llm.components"]
    monkeypatch.setattr(module, "range", lambda n: [0], raising=False)  # no bound on the rounds
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)], "a long, b long").coalesce(1)
    labels = components(edges, Scratch(spark, "test")).collect()
    assert sorted((r.node, r.label) for r in labels) == [(i, 0) for i in range(31)]
