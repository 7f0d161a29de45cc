"""Toxicity: a linear-chain conditional random field tags toxic words.

Labels are of documents, so words are labelled first: a word is a marker when its contexts
are significantly more often those of toxic documents. A field with two tags learns the markers by
features of the words' shape, start and end, so it also finds forms that no label showed. The
forward-backward marginals of a document's words give its score and the offending offsets.
"""

from __future__ import annotations

import pickle
import re
import warnings
from collections.abc import Iterator
from math import exp, log

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.scratch import Scratch
from cohortscope.llm.texts import crc_fold, whole_text

#: Bounds on what the field is fitted on: labelled documents, marker words, and training segments
#: with and without markers. All are taken by hash or by strength, the same ones on every run.
FIT_DOCS, FIT_MARKERS, FIT_SEGMENTS, SEGMENT = 20_000, 20_000, 3_000, 100
STEPS, RATE, DECAY = 80, 0.3, 1e-5
#: Smaller weights are left out of the fitted field.
LEAST = 0.02
#: Distinct words whose scores a worker remembers before it starts anew.
REMEMBERED = 200_000
#: Characters of text that a worker splits into words at once; a longer text is split whole.
CHUNK = 3_000_000
EDGES = ".,;:!?\"'()[]{}*#$%&|<>"
RESULT = "hits double, top double, spans array<struct<start:int,stop:int,marginal:double>>"


def features(word: str) -> list[str]:
    """A normalised word, its beginnings and its ends; the empty feature is in every word."""
    return [
        "", "=" + word, "<" + word[:2], "<" + word[:3], "<" + word[:4], "<" + word[:5], "<" + word[:6],
        word[-2:] + ">", word[-3:] + ">", word[-4:] + ">",
    ]


class Field:
    """Weights of the field: of features for the toxic tag, and between tags."""

    def __init__(self, weights: dict[str, float] | None = None, pairs: np.ndarray | None = None):
        self.weights = weights or {}
        self.pairs = np.zeros((2, 2)) if pairs is None else pairs

    def odds(self, word: str) -> float:
        weight = self.weights.get
        return exp(min(max(sum([weight(f, 0.0) for f in set(features(word))]), -60.0), 60.0))

    def marginals(self, odds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The toxic tag's marginal for every word; sequence k is offsets[k] to offsets[k + 1].

        Forward and backward run over all sequences at once, as ratios of toxic to clean.
        """
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        starts, sizes = offsets[:-1][order], lengths[order]
        (t00, t01), (t10, t11) = np.exp(self.pairs)
        longest = int(sizes[0]) if len(sizes) else 0
        active = np.searchsorted(-sizes, -np.arange(longest), side="left")
        forward, backward = np.empty(len(odds)), np.empty(len(odds))
        ratio = np.empty(0)
        for t in range(longest):
            at = starts[: active[t]] + t
            before = ratio[: active[t]]
            ratio = odds[at] * ((t01 + before * t11) / (t00 + before * t10) if t else 1.0)
            ratio = np.clip(ratio, 1e-100, 1e100)
            forward[at] = ratio
        after = np.ones(len(sizes))
        for t in range(longest - 1, -1, -1):
            at = starts[: active[t]] + t
            after[len(at) :] = 1.0
            backward[at] = after[: len(at)]
            onward = np.clip(odds[at] * after[: len(at)], 1e-100, 1e100)
            after[: len(at)] = (t10 + onward * t11) / (t00 + onward * t01)
        product = forward * backward
        return product / (1 + product)

    def fit(self, sequences: list[list[str]], tags: list[list[bool]]) -> Field:
        """Maximum likelihood by full-batch steps with per-weight rates; few, bounded sequences."""
        words = sorted({w for s in sequences for w in s})
        place = {w: i for i, w in enumerate(words)}
        flat = np.array([place[w] for s in sequences for w in s], dtype=np.int64)
        gold = np.array([t for s in tags for t in s], dtype=np.float64)
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sequences])]).astype(np.int64)
        number: dict[str, int] = {}
        listed = [[number.setdefault(f, len(number)) for f in set(features(w))] for w in words]
        owner = np.repeat(np.arange(len(words)), [len(x) for x in listed])
        feature = np.array([f for x in listed for f in x], dtype=np.int64)
        weights = np.zeros(len(number))
        inner = np.ones(len(flat), dtype=bool)
        inner[offsets[:-1][np.diff(offsets) > 0]] = False  # words that have one before them
        now = np.flatnonzero(inner)
        seen = np.zeros((2, 2))
        np.add.at(seen, (gold[now - 1].astype(int), gold[now].astype(int)), 1)
        mean_w, mean_p = np.zeros(len(number)), np.zeros((2, 2))
        for _ in range(STEPS):
            scores = np.bincount(owner, weights[feature], len(words))
            odds = np.exp(np.clip(scores, -60, 60))[flat]
            marginal, expected = self._expect(odds, offsets, now)
            word_slope = np.bincount(flat, gold - marginal, len(words))
            slope = np.bincount(feature, word_slope[owner], len(number)) - DECAY * len(flat) * weights
            pair_slope = seen - expected - DECAY * len(flat) * self.pairs
            mean_w += slope**2
            mean_p += pair_slope**2
            weights += RATE * slope / (np.sqrt(mean_w) + 1e-6)
            self.pairs += RATE * pair_slope / (np.sqrt(mean_p) + 1e-6)
        self.weights = {f: float(weights[i]) for f, i in number.items() if abs(weights[i]) >= LEAST}
        return self

    def _expect(self, odds, offsets, now) -> tuple[np.ndarray, np.ndarray]:
        """Marginals, and expected counts of tag pairs."""
        marginal = self.marginals(odds, offsets)
        pair = np.exp(self.pairs)
        # Given the marginals of two neighbours, their joint differs from the product by the
        # association that the pair weights put on it; a 2 x 2 table with these margins.
        left, right = marginal[now - 1], marginal[now]
        cross = pair[0, 0] * pair[1, 1] / (pair[0, 1] * pair[1, 0])
        if abs(cross - 1) < 1e-9:
            both = left * right
        else:
            a = 1 + (left + right) * (cross - 1)
            both = (a - np.sqrt(np.maximum(a * a - 4 * cross * (cross - 1) * left * right, 0))) / (
                2 * (cross - 1)
            )
        table = [[(1 - left - right + both).sum(), (right - both).sum()], [(left - both).sum(), both.sum()]]
        return marginal, np.array(table)


class _Odds(dict):
    """Odds of raw words by the field; forgets all when it holds too many."""

    def __init__(self, field: Field):
        super().__init__()
        self.field = field

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        odds = self[word] = self.field.odds(word.lower().strip(EDGES))
        return odds


def marker_words(sample: DataFrame, scratch: Scratch) -> DataFrame:
    """word, strength: words whose distinct contexts are significantly those of toxic documents.

    A context is the word with its two neighbours and counts once however many copies of a
    document hold it. The test is a likelihood ratio whose limit grows with the number of words.
    The odds of a marker's contexts are above 1 and above three times those of all contexts, which
    can be reached whatever the share of toxic documents.
    """
    around = """transform(w, (x, i) -> named_struct('word', x,
        'before', CASE WHEN i > 0 THEN w[i - 1] END,
        'after', CASE WHEN i + 1 < size(w) THEN w[i + 1] END))"""
    contexts = (
        sample.selectExpr("toxic", "transform(words, x -> trim(BOTH edges FROM lower(x))) AS w")
        .selectExpr("toxic", f"explode({around}) AS context")
        .where("context.word != ''")
        .groupBy("context")
        .agg(F.max("toxic").alias("toxic"))
    )
    words = contexts.groupBy("context.word").agg(
        F.sum("toxic").cast("double").alias("t"), F.count("*").cast("double").alias("n")
    )
    words = scratch.store(words, "words")
    total = words.agg(F.sum("t").alias("t"), F.sum("n").alias("n"), F.count("*").alias("v")).first()
    if not total["t"] or total["t"] == total["n"]:
        return words.selectExpr("word", "0D AS strength").limit(0)
    p, limit = total["t"] / total["n"], 2 * log(total["v"]) + 6
    ratio = (
        f"2 * (t * ln(t / n / {p!r}D) + "
        f"CASE WHEN n > t THEN (n - t) * ln((1 - t / n) / {(1 - p)!r}D) ELSE 0D END)"
    )
    return words.where("t > 1").selectExpr("word", "t", "n", f"{ratio} AS strength").where(
        f"t > {max(1.0, 3 * p / (1 - p))!r}D * (n - t) AND strength > {limit!r}D"
    )


def _train(segments: DataFrame, markers: frozenset[str]) -> Field:
    """The field, fitted in one task on the bounded segments."""

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [(list(w), bool(t)) for b in batches for w, t in zip(b["words"], b["toxic"])]
        sequences = [[w.lower().strip(EDGES) for w in words] for words, _ in rows]
        tags = [[toxic and w in markers for w in s] for s, (_, toxic) in zip(sequences, rows)]
        field = Field().fit(sequences, tags)
        yield pd.DataFrame({"field": [pickle.dumps((field.weights, field.pairs))]})

    found = segments.coalesce(1).mapInPandas(fit, "field binary").collect()
    return Field(*pickle.loads(bytes(found[0]["field"]))) if found else Field()


def tag_documents(texts: DataFrame, field: Field) -> DataFrame:
    """doc_id, hits, top and spans of every document, by the field's marginals.

    hits: sum of the marginals of at least 0.1; top: the largest marginal; spans: character
    offsets of the words whose marginal is at least 0.5.
    """

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds_of = _Odds(field)
        for batch in batches:
            column = batch.column("text")
            size = np.cumsum(pc.utf8_length(column).to_numpy(zero_copy_only=False)) // CHUNK
            edges = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(column)]
            for start, stop in zip(edges, edges[1:]):
                yield _tagged(batch.slice(start, stop - start), field, odds_of)

    rows = texts.select("doc_id", whole_text().alias("text"))
    return rows.mapInArrow(tag, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {RESULT}")


def _tagged(batch: pa.RecordBatch, field: Field, odds_of: _Odds) -> pa.RecordBatch:
    texts = batch.column("text").to_pylist()
    split = [t.split() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in split])]).astype(np.int64)
    odds = np.fromiter((odds_of[w] for s in split for w in s), np.float64, offsets[-1])
    p = field.marginals(odds, offsets)
    hits, top = np.zeros(len(split)), np.zeros(len(split))
    found = np.flatnonzero(p >= 0.1)
    np.add.at(hits, np.searchsorted(offsets, found, side="right") - 1, p[found])
    filled = np.diff(offsets) > 0
    if len(p):
        top[filled] = np.maximum.reduceat(p, offsets[:-1][filled])
    spans = [
        _spans(text, p[a:b]) if y >= 0.5 else []
        for text, a, b, y in zip(texts, offsets[:-1], offsets[1:], top)
    ]
    one = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("marginal", pa.float64())])
    # The ids as they came: a column of numbers with nulls would become inexact elsewhere.
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(hits), pa.array(top), pa.array(spans, pa.list_(one))],
        ["doc_id", "hits", "top", "spans"],
    )


def _spans(text: str, marginals: np.ndarray) -> list[dict]:
    words = [m.span() for m in re.finditer(r"\S+", text)]
    if len(words) != len(marginals):  # split() knows a few more kinds of white space
        words, at = [], 0
        for word in text.split():
            at = text.index(word, at)
            words.append((at, at + len(word)))
            at += len(word)
    return [
        {"start": words[i][0], "stop": words[i][1], "marginal": float(marginals[i])}
        for i in np.flatnonzero(marginals >= 0.5)
    ]


def score_toxicity(
    docs: DataFrame, labels: DataFrame, *, folds: int = 4, held: int = 2, limit: float = 0.3,
    fit_docs: int = FIT_DOCS, fit_markers: int = FIT_MARKERS, fit_segments: int = FIT_SEGMENTS,
) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted, n_spans, spans.

    Labels of ids whose crc32 fold is ``held`` are never learnt from. The field is fitted on at
    most ``fit_docs`` labelled documents, with at most ``fit_markers`` marker words, the strongest, and
    ``fit_segments`` different segments of either kind; every document's whole text is tagged.

    Null text: empty; an empty text has no words and gets the score of a text without toxic
    words. Null ids have no label and keep a null doc_id. Null labels are left out. Without labels
    of both kinds the score is the share of toxic labels, 0 if there are none. Empty table: no
    rows. Repeated rows are scored each. Ids of any type come back as they are. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        (crc_fold("doc_id", folds) != held) & F.col("toxic").isNotNull()
    )
    # At most fit_docs rows, so the broadcast is bounded; distinct, as labels may repeat.
    chosen = known.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(fit_docs)
    texts = docs.select("doc_id", whole_text().alias("text"))
    words = F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), x -> x != '')")
    sample = scratch.store(
        texts.join(F.broadcast(chosen), "doc_id").select(
            "doc_id", "toxic", words.alias("words"), F.lit(EDGES).alias("edges")
        ),
        "sample",
    )
    found = marker_words(sample, scratch).orderBy(F.desc("strength"), "word").limit(fit_markers).collect()
    markers = frozenset(r["word"] for r in found)
    if not markers:
        warnings.warn("no word marks toxic documents; scores do not depend on the words", stacklevel=2)
    segments = sample.selectExpr(
        "doc_id",
        "toxic",
        f"explode(transform(sequence(0, greatest(size(words) - 1, 0), {SEGMENT}), "
        f"i -> slice(words, i + 1, {SEGMENT}))) AS words",
    ).where("size(words) > 0")
    field = _train(_chosen_segments(segments, markers, fit_segments), markers)
    tagged = scratch.store(tag_documents(texts, field), "tagged")
    return _calibrated(tagged, chosen, limit, folds, held)


def _chosen_segments(segments: DataFrame, markers: frozenset[str], most: int) -> DataFrame:
    """Different segments: at most so many with a marker of a toxic document, and as many of clean ones."""

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            marked = [any(w.lower().strip(EDGES) in markers for w in s) for s in b["words"]]
            yield b.assign(marked=marked)

    schema = "toxic int, words array<string>, marked boolean"
    rows = segments.select("toxic", "words").distinct().mapInPandas(mark, schema)
    order = F.xxhash64("words")
    with_markers = rows.where("marked AND toxic = 1").orderBy(order, "words").limit(most)
    without = rows.where("toxic = 0").orderBy(order, "words").limit(most)
    return with_markers.unionByName(without).select("words", "toxic")


def _calibrated(tagged: DataFrame, chosen: DataFrame, limit: float, folds: int, held: int) -> DataFrame:
    """Scores by a logistic curve over hits and top, fitted on the chosen labels."""
    inputs = {"x_hits": "ln(1 + hits)", "x_top": "top"}
    rows = tagged.selectExpr("*", *[f"{sql} AS {name}" for name, sql in inputs.items()])
    labelled = rows.join(F.broadcast(chosen), "doc_id").select(
        *inputs, F.col("toxic").cast("double").alias("label")
    )
    share = labelled.agg(F.avg("label")).collect()[0][0] or 0.0
    score = f"{share!r}D"
    if 0 < share < 1:
        vectors = VectorAssembler(inputCols=list(inputs), outputCol="features")
        curve = LogisticRegression(regParam=1e-4, maxIter=60).fit(
            vectors.transform(labelled).select("label", "features")
        )
        terms = [f"{float(w)!r}D * {x}" for w, x in zip(curve.coefficients, inputs)]
        score = f"1 / (1 + exp(-({' + '.join([f'{float(curve.intercept)!r}D', *terms])})))"
    return rows.selectExpr("*", f"{score} AS score").select(
        "doc_id",
        (crc_fold("doc_id", folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= limit).cast("int").alias("predicted"),
        F.size("spans").cast("long").alias("n_spans"),
        "spans",
    )
