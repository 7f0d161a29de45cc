"""Spelling variants by a relational trie and a frontier of states.

The edges of a trie of all words are a table. A state is a word, a position in it, a node of the
trie and the edits made so far; joining the states with the edges moves them a level on, exactly or
by the one edit. States that reach the end of their word at the end of another one are neighbours.

One edit leaves the first or the second half of a word as it is. So there is a trie of the words
and one of the words turned round, states start at the nodes of their own word from half of it on,
and the upper, widest levels are not walked. Chains of nodes without a branch are one edge, whose
label is compared as a whole, so the number of joins does not grow with the length of the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.grams import mix, spans
from cohortscope.llm.scratch import Scratch
from cohortscope.llm.texts import ascii_lower, whole_text

#: Fixed by the contract: runs of these letters are words.
LETTERS = r"[A-Za-zÀ-ÿ]+"
#: A word as its trie spells it.
_SPELT = "if(turned, reverse(word), word)"


def count_words(docs: DataFrame, *, typos: int | None = None) -> DataFrame:
    """word, n: the runs of letters of all texts with A-Z lower-cased, and how often each occurs.

    With ``typos`` a run whose crc32 of ``<doc_id>:<run>`` that number divides loses the code point
    at the crc32 modulo its length: errors for tests that every run makes alike. Counts are made
    before the shuffle, so a word in every document is one row per task.

    Null text: no words. Null id: as empty text. Empty table: no rows. Other columns are ignored.
    """
    runs = F.explode(F.regexp_extract_all(whole_text(), F.lit(LETTERS), F.lit(0)))
    words = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), runs.alias("run"))
    words = words.select("doc", ascii_lower(F.col("run")).alias("word"))
    if typos:
        words = words.withColumn("h", F.crc32(F.concat_ws(":", "doc", "word"))).selectExpr(
            f"""CASE WHEN h % {int(typos)} = 0 THEN concat(substring(word, 1, CAST(h % length(word) AS INT)),
                    substring(word, CAST(h % length(word) AS INT) + 2)) ELSE word END AS word"""
        )
    return words.where("word != ''").groupBy("word").agg(F.count("*").alias("n"))


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The prefixes of words and of words turned round, from nearly half of their length on.

    id, turned, depth, node (the prefix's hash), next (the code point after it, -1 at the end), and
    anchor: whether half of the word ends here, where its states start.
    """
    for batch in batches:
        words = batch.column("word").to_pylist()
        for turned in (False, True):
            spelt = [w[::-1] for w in words] if turned else words
            points = np.frombuffer("".join(spelt).encode("utf-32-le"), np.uint32).astype(np.int64)
            size = np.array([len(w) for w in spelt], dtype=np.int64)
            half = size - size // 2 if turned else size // 2
            least = size // 2 if turned else (size - 1) // 2  # a neighbour one shorter starts here
            count = size - least + 1
            row = np.repeat(np.arange(len(words)), count)
            depth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + least[row]
            start = (np.cumsum(size) - size)[row]
            values = mix((points * 2 + turned + 1).astype(np.uint64))
            node = spans(values, start, start + depth) ^ np.uint64(turned)
            at_end = depth == size[row]
            after = np.where(at_end, -1, np.append(points, -1)[start + depth])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(row)),
                    pa.array(np.full(len(row), turned)),
                    pa.array(depth, pa.int32()),
                    pa.array(node.view(np.int64)),
                    pa.array(after, pa.int32()),
                    pa.array(depth == half[row]),
                ],
                ["id", "turned", "depth", "node", "next", "anchor"],
            )


def _paths(words: DataFrame, scratch: Scratch) -> DataFrame:
    """For each word and direction its nodes that branch, end a word or are a half, and the node after."""
    steps = scratch.store(
        words.select("id", "word").mapInArrow(
            _steps, "id long, turned boolean, depth int, node long, next int, anchor boolean"
        ),
        "steps",
    )
    nodes = steps.groupBy("node").agg(
        F.min("next").alias("least"), F.max("next").alias("most"), F.max("anchor").alias("anchor")
    )
    nodes = scratch.store(nodes.where("least != most OR least = -1 OR anchor").select("node"), "nodes")
    own = "PARTITION BY id, turned ORDER BY depth"
    kept = steps.join(nodes, "node", "left_semi").selectExpr(
        "id", "turned", "depth", "node", f"lead(depth) OVER ({own}) AS child_depth",
        f"lead(node) OVER ({own}) AS child",
        f"max(CASE WHEN anchor THEN depth END) OVER (PARTITION BY id, turned) AS half",
    )
    return scratch.store(kept.join(words.select("id", "word"), "id"), "paths")


#: Whether a state that read so much more of its word can go on from the edge's child, or is at its end.
_GOES_ON = """if(position + {0} = length(spelt), size(ends) > 0,
    instr(after, substring(spelt, position + {0} + 1, 1)) > 0)"""


def _advance(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states after one edge: along it exactly, or with the one edit on the way.

    States that no edge leads on from are left out at once. ``ends`` is null but at a word's end.
    """
    exact = (
        states.where("edits = 1").withColumn("first", F.expr("substring(spelt, position + 1, 1)"))
        .join(edges, ["node", "first"])
        .withColumn("taken", F.expr("length(label)"))
        .where(f"substring(spelt, position + 1, taken) = label AND {_GOES_ON.format('taken')}")
    )
    # A part of the word that is one longer lost a letter, one shorter got one, as long changed one.
    edited = states.where("edits = 0").drop("edits").join(edges, "node").selectExpr(
        "*", "explode(filter(sequence(length(label) - 1, length(label) + 1), m -> "
        f"position + m <= length(spelt) AND {_GOES_ON.format('m')} AND "
        "levenshtein(label, substring(spelt, position + 1, m), 1) = 1)) AS taken",
    )
    columns = [
        "spelt", "turned", "position + taken AS position", "child AS node", "1 AS edits",
        "if(position + taken = length(spelt), ends, null) AS ends",
    ]
    return exact.selectExpr(*columns).unionByName(edited.selectExpr(*columns))


def neighbours(words: DataFrame, scratch: Scratch) -> DataFrame:
    """word, near: all pairs of words, each way, that differ by one inserted, deleted or replaced code point."""
    paths = _paths(words, scratch)
    edges = scratch.store(
        paths.where("child IS NOT NULL")
        .selectExpr(
            "node", "child", f"substring({_SPELT}, depth + 1, child_depth - depth) AS label",
            "CASE WHEN child_depth = length(word) THEN word END AS word",
        )
        .groupBy("node", "child", "label").agg(F.collect_set("word").alias("ends"))
        .selectExpr("node", "substring(label, 1, 1) AS first", "label", "child", "ends"),
        "edges",
    )
    # The letters that follow a node are at most those of the alphabet.
    after = edges.groupBy("node").agg(F.array_join(F.collect_set("first"), "").alias("after"))
    edges = scratch.store(
        edges.join(after.withColumnRenamed("node", "child"), "child", "left").fillna("", "after"), "edges"
    )
    states = paths.where("depth >= half").selectExpr(
        f"{_SPELT} AS spelt", "turned", "depth AS position", "node", "0 AS edits"
    )
    met = []
    while True:
        moved = scratch.store(_advance(states, edges), "moved")
        at_end = moved.where("ends IS NOT NULL").selectExpr(
            "if(turned, reverse(spelt), spelt) AS word", "explode(ends) AS near"
        )
        met.append(at_end.where("levenshtein(word, near, 1) = 1"))
        states = moved.where("ends IS NULL").drop("ends")
        if states.isEmpty():
            break
    found = met[0]
    for more in met[1:]:
        found = found.unionByName(more)
    return scratch.store(found.distinct(), "neighbours")


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """word, root: the last of the forms that follow each other; each round doubles the way."""
    roots = scratch.store(forms.selectExpr("word", "form AS root", "true AS moved"), "roots")
    while not roots.where("moved").isEmpty():
        up = roots.selectExpr("word AS root", "root AS further")
        roots = scratch.store(
            roots.join(up, "root", "left").selectExpr(
                "word", "coalesce(further, root) AS root", "further IS NOT NULL AS moved"
            ),
            "roots",
        )
    return roots.drop("moved")


def spelling_variants(
    words: DataFrame, *, min_length: int = 5, min_count: int = 3, ratio: float = 2.0
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``words`` has word and n (see ``count_words``). Words of at least ``min_length`` code points (3 or
    more) and ``min_count`` occurrences take part. Two are near if one inserted, deleted or
    replaced code point makes them equal. A word's form is its near word of largest n, the smallest
    of several in code-point order, if that n is at least ``ratio`` (above 1) times its own; root
    follows forms to the last, and is the word itself without one. n_near counts near words.

    Null words or counts: left out. Repeated words: their counts are added. Empty table: no rows.
    Other columns are ignored.
    """
    if min_length < 3 or ratio <= 1:
        raise ValueError("words of three code points at least, and a ratio above 1")
    scratch = Scratch(words.sparkSession, "spelling")
    known = words.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    known = known.where((F.length("word") >= min_length) & (F.col("n") >= min_count))
    known = scratch.store(known.withColumn("id", F.monotonically_increasing_id()), "words")
    near = neighbours(known, scratch).join(known.selectExpr("word AS near", "n AS near_n"), "near")
    best = scratch.store(
        near.groupBy("word").agg(
            F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), F.col("near"))).alias("best")
        ).selectExpr("word", "n_near", "best.near AS form", "-best.col1 AS form_n"),
        "best",
    )
    judged = scratch.store(
        known.drop("id").join(best, "word", "left").selectExpr(
            "word", "n", "coalesce(n_near, 0L) AS n_near",
            f"CASE WHEN form_n >= {float(ratio)}D * n THEN form END AS form",
            f"CASE WHEN form_n >= {float(ratio)}D * n THEN form_n END AS form_n",
        ),
        "judged",
    )
    roots = _roots(judged.where("form IS NOT NULL").select("word", "form"), scratch)
    return judged.join(roots, "word", "left").selectExpr(
        "word", "form", "coalesce(root, word) AS root", "n", "n_near", "form_n"
    )
