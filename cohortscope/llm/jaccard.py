"""N-gram Jaccard join with Bayesian candidate pruning.

Documents with the same set of five-word shingles form one class, so copies are never
paired. Classes that agree in a band of their MinHash values are candidates. A candidate pair's
MinHash values are compared a few at a time; the pair is dropped as soon as the posterior
probability that its similarity reaches the threshold falls below a tolerance. The rest is
verified on the shingle sets. Tasks see blocks of a bucket or cluster and return link counts
and spanning trees, so nothing is emitted per pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.components import components
from cohortscope.llm.grams import Words, mix, spans, text_blocks
from cohortscope.llm.scratch import Scratch
from cohortscope.llm.texts import keep_rows, whole_text

#: Words of a shingle and the similarity from which two documents are linked.
SHINGLE, THRESHOLD = 5, 0.8
#: MinHash values, values of a band, values compared at a time, and the posterior probability
#: below which a pair is dropped. At similarity 0.8 all 32 bands miss with probability 5e-8.
HASHES, ROWS, STEP, TOLERANCE = 128, 4, 16, 1e-5
#: Members of a block; a task sees two blocks of a bucket or cluster at most.
BLOCK_ROWS = 256
#: Pairs compared at once.
PAIRS = 1 << 17

_NUMBERS = np.arange(1, HASHES + 1, dtype=np.uint64)
_FACTORS = mix(_NUMBERS) | np.uint64(1)
_MASKS = mix(_NUMBERS + np.uint64(1 << 32))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' distinct shingles, sorted within each text, and the texts' offsets.

    A text of fewer words than a shingle has one shingle of all its words, an empty one none.
    """
    words = Words(data, offsets)
    place, hashes = words.windows(SHINGLE)
    doc = words.doc[place]
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    if len(short):
        whole = spans(words.hashes, words.first[short], words.first[short + 1])
        doc, hashes = np.concatenate([doc, short]), np.concatenate([hashes, whole])
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    fresh = np.ones(len(doc), dtype=bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    doc, hashes = doc[fresh], hashes[fresh]
    return hashes, np.searchsorted(doc, np.arange(len(offsets)))


def signatures(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash values (16 bits each) of every text that has shingles; rows of zeros elsewhere."""
    filled = np.diff(offsets) > 0
    found = np.zeros((len(offsets) - 1, HASHES), dtype=np.uint16)
    if filled.any():
        starts = offsets[:-1][filled]
        for k in range(HASHES):
            least = np.minimum.reduceat((hashes ^ _MASKS[k]) * _FACTORS[k], starts)
            found[filled, k] = (mix(least) >> np.uint64(48)).astype(np.uint16)
    return found


@lru_cache
def needed(threshold: float, tolerance: float) -> np.ndarray:
    """Equal values that a pair needs after each step to stay.

    With a uniform prior the posterior of the similarity after n comparisons and m equal values
    is Beta(m + 1, n - m + 1); its tail above t is the chance of at most m successes in n + 1
    trials of probability t.
    """
    least = []
    for n in range(STEP, HASHES + 1, STEP):
        tail = m = 0
        while True:
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
            m += 1
        least.append(m)
    return np.array(least)


def surviving(left: np.ndarray, right: np.ndarray, threshold: float, tolerance: float) -> np.ndarray:
    """Places of the pairs (rows of two signature arrays) that the posterior does not drop."""
    alive, equal = np.arange(len(left)), np.zeros(len(left), dtype=np.int64)
    for k, least in enumerate(needed(threshold, tolerance)):
        part = slice(k * STEP, (k + 1) * STEP)
        equal = equal + (left[alive, part] == right[alive, part]).sum(axis=1)
        keep = equal >= least
        alive, equal = alive[keep], equal[keep]
    return alive


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number that each of 0..n-1 is connected to by the pairs (a, b)."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        fresh = label.copy()
        np.minimum.at(fresh, a, least)
        np.minimum.at(fresh, b, least)
        fresh = fresh[fresh]
        if np.array_equal(fresh, label):
            return label
        label = fresh


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches that are sorted by the keys."""
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        change[0] = last is not None and any(c[0] != x for c, x in zip(columns, last))
        last = [c[-1] for c in columns]
        if change.any():
            cut = int(np.flatnonzero(change)[-1])
            yield pa.Table.from_batches([*kept, batch.slice(0, cut)], batch.schema)
            kept, batch = [], batch.slice(cut)
        kept.append(batch)
    if kept:
        yield pa.Table.from_batches(kept)


def group_pairs(key: np.ndarray, block: np.ndarray, one: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of rows of one group, i before j, some at a time.

    ``key`` numbers the groups in order. Where ``one`` is false the group is two blocks, whose
    members were or will be paired with their own block elsewhere, and only pairs across count.
    """
    end = np.searchsorted(key, key, side="right")
    count = end - np.arange(len(key)) - 1
    total = np.cumsum(count)
    start = 0
    while start < len(key):
        done = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, done + PAIRS, side="right")))
        rows = np.arange(start, stop)
        a = np.repeat(rows, count[rows])
        first = np.repeat(np.cumsum(count[rows]) - count[rows], count[rows])
        b = a + 1 + np.arange(len(a)) - first
        keep = one[a] | (block[a] != block[b])
        yield a[keep], b[keep]
        start = stop


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _group_ids(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(table.num_rows, dtype=np.int64)
    for k in keys:
        c = _numbers(table, k)
        change[1:] |= c[1:] != c[:-1]
    return np.cumsum(change)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in text_blocks(batch, "text"):
            hashes, at = shingle_sets(data, offsets)
            filled = np.diff(at) > 0
            total = np.zeros(end - row, dtype=np.uint64)
            if filled.any():
                total[filled] = np.add.reduceat(mix(hashes), at[:-1][filled])
            values = signatures(hashes, at)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(row, end - row),
                    batch.column("digest").slice(row, end - row),
                    pa.array(np.diff(at).astype(np.int32)),
                    pa.array(mix(total + np.diff(at).astype(np.uint64)).view(np.int64)),
                    pa.array([x.tobytes() for x in values], pa.binary()),
                ],
                ["doc_id", "digest", "shingles", "class", "signature"],
            )


def _blocks(members: DataFrame, group: str, node: str, size: str) -> DataFrame:
    """Members of groups of the given size, once for each pair of blocks that holds their own."""
    return (
        members.withColumn("blocks", F.expr(f"CAST(ceil({size} / {BLOCK_ROWS}) AS INT)"))
        .withColumn("block", F.expr(f"CAST(pmod(xxhash64({node}, 7), blocks) AS INT)"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("blocks", "other", size)
    )


def _per_group(rows: DataFrame, keys: list[str], work: Callable, schema: str) -> DataFrame:
    """The work on whole groups; groups are small, so many share a task."""
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(work, schema)


_KEYS = ["bucket", "low", "high"]


def _likely(threshold: float, tolerance: float) -> Callable:
    """Spanning trees (a, b) of the pairs in a bucket that the posterior does not drop."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, _KEYS):
            node, block = _numbers(table, "class"), _numbers(table, "block")
            one = _numbers(table, "low") == _numbers(table, "high")
            joined = b"".join(table.column("signature").to_pylist())
            values = np.frombuffer(joined, np.uint16).reshape(-1, HASHES)
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for i, j in group_pairs(_group_ids(table, _KEYS), block, one):
                keep = surviving(values[i], values[j], threshold, tolerance)
                a.append(i[keep])
                b.append(j[keep])
            label = spanning(table.num_rows, np.concatenate(a), np.concatenate(b))
            linked = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[linked]), pa.array(node[label[linked]])], ["a", "b"]
            )

    return work


def _verified(threshold: float, tolerance: float) -> Callable:
    """Link counts of the members of a cluster's blocks, and spanning trees of the links."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, _KEYS):
            node, block = _numbers(table, "class"), _numbers(table, "block")
            one, copies = _numbers(table, "low") == _numbers(table, "high"), _numbers(table, "copies")
            texts = table.select(["text"]).combine_chunks().to_batches()[0]
            sets, values = [], []
            for _, _, data, offsets in text_blocks(texts, "text"):
                hashes, at = shingle_sets(data, offsets)
                sets += [hashes[x:y] for x, y in zip(at[:-1], at[1:])]
                values.append(signatures(hashes, at))
            values = np.concatenate(values)
            linked = [(np.empty(0, np.int64), np.empty(0, np.int64))]
            for i, j in group_pairs(_group_ids(table, _KEYS), block, one):
                distinct = node[i] != node[j]  # a repeated row is not a second text
                i, j = i[distinct], j[distinct]
                keep = surviving(values[i], values[j], threshold, tolerance)
                similar = [_similarity(sets[x], sets[y]) >= threshold for x, y in zip(i[keep], j[keep])]
                linked.append((i[keep][similar], j[keep][similar]))
            a, b = (np.concatenate(x) for x in zip(*linked))
            n = table.num_rows
            documents = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
            texts_linked = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
            label = spanning(n, a, b)
            some = np.flatnonzero(texts_linked)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(node[some]),
                    pa.array(node[label[some]]),
                    pa.array(documents[some].astype(np.int64)),
                    pa.array(texts_linked[some].astype(np.int64)),
                ],
                ["a", "b", "documents", "texts"],
            )

    return work


def _similarity(x: np.ndarray, y: np.ndarray) -> float:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def similar_documents(
    docs: DataFrame, *, threshold: float = THRESHOLD, tolerance: float = TOLERANCE
) -> DataFrame:
    """One row per row of docs: doc_id, class_id, n_links, n_text_links, kept.

    class_id: the smallest doc_id of the documents that links connect; a link is a Jaccard
    similarity of the sets of five-word shingles of at least ``threshold``. n_links: linked
    documents, copies included; n_text_links: linked different shingle sets. kept: whether this
    row is the one that stays of its class, the one with the smallest id.

    A text of one to four words has one shingle of all its words. Empty and null texts have no
    shingle and no links: each is a class of its own, with its own id, and stays. Rows that
    share an id are told apart by their text; repeated rows are copies, and one of them stays.
    Null ids count as largest; a class of null ids has a null class_id. Empty table: no rows.
    Other columns are ignored. Shingles are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    text = whole_text()
    rows = docs.select("doc_id", F.md5(text.cast("binary")).alias("digest"), text.alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    sketches = scratch.store(
        rows.mapInArrow(
            _sketch, f"doc_id {kind}, digest string, shingles int, class long, signature binary"
        ),
        "sketches",
    )
    first = "named_struct('no', doc_id IS NULL, 'id', doc_id, 'digest', digest)"
    classes = scratch.store(
        sketches.where("shingles > 0").groupBy("class").agg(
            F.count("*").alias("copies"), F.expr(f"min({first})").alias("first")
        ).select("class", "copies", "first.id", "first.digest"),
        "classes",
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("own") == F.col("digest"))
    values = scratch.store(
        sketches.withColumnRenamed("digest", "own").drop("class")
        .join(classes, same).select("class", "signature"),
        "signatures",
    )
    clusters = scratch.store(
        components(_candidates(values, scratch, threshold, tolerance), scratch), "clusters"
    )
    links = scratch.store(_links(rows, classes, clusters, threshold, tolerance), "link-counts")
    labels = components(links.select("a", "b"), scratch)
    return _judged(sketches, classes, links, labels)


def _candidates(values: DataFrame, scratch: Scratch, threshold: float, tolerance: float) -> DataFrame:
    """Edges between classes that share a band's bucket and are not dropped."""
    width = ROWS * 2
    keys = ", ".join(
        f"xxhash64({b}, substring(signature, {b * width + 1}, {width}))" for b in range(HASHES // ROWS)
    )
    bands = values.select("class", F.explode(F.expr(f"array({keys})")).alias("bucket"))
    filled = (
        bands.groupBy("bucket")
        .agg(
            F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("size"),
            F.expr("sum(pmod(xxhash64(class), 1099511627776))").alias("members"),
        )
        .where("low != high")
    )
    # Bands that gather the same classes give the same pairs; one of them is enough.
    buckets = scratch.store(
        filled.groupBy("low", "high", "size", "members").agg(F.min("bucket").alias("bucket"))
        .select("bucket", "size"),
        "buckets",
    )
    members = _blocks(bands.join(buckets, "bucket"), "bucket", "class", "size")
    found = members.join(values, "class")
    return _per_group(found, _KEYS, _likely(threshold, tolerance), "a long, b long")


def _links(rows: DataFrame, classes: DataFrame, clusters: DataFrame, threshold, tolerance) -> DataFrame:
    """a, b, documents, texts: link counts of class a in one pair of blocks, and a tree edge."""
    sizes = clusters.groupBy("label").agg(F.count("*").alias("size"))
    wanted = (
        classes.join(clusters.join(sizes, "label"), F.col("class") == F.col("node"))
        .select(F.col("label").alias("bucket"), "class", "copies", "size", "id", F.col("digest").alias("own"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("own") == F.col("digest"))
    texts = rows.join(wanted.hint("shuffle_hash"), same).drop("id", "own", "doc_id", "digest")
    schema = "a long, b long, documents long, texts long"
    return _per_group(_blocks(texts, "bucket", "class", "size"), _KEYS, _verified(threshold, tolerance), schema)


def _judged(sketches: DataFrame, classes: DataFrame, links: DataFrame, labels: DataFrame) -> DataFrame:
    counts = links.groupBy(F.col("a").alias("class")).agg(
        F.sum("documents").alias("documents"), F.sum("texts").alias("texts")
    )
    labelled = (
        classes.join(counts, "class", "left")
        .join(labels, F.col("class") == F.col("node"), "left")
        .withColumn("label", F.coalesce("label", "class"))
    )
    first = "named_struct('no', id IS NULL, 'id', id, 'digest', digest)"
    best = labelled.groupBy("label").agg(F.expr(f"min({first})").alias("best"))
    info = labelled.join(best, "label").select(
        F.col("class").alias("of_class"),
        F.expr("coalesce(documents, 0) + copies - 1").alias("n_links"),
        F.expr("coalesce(texts, 0)").alias("n_text_links"),
        "best",
    )
    stays = F.col("doc_id").eqNullSafe(F.col("best.id")) & (F.col("digest") == F.col("best.digest"))
    alone = F.col("of_class").isNull()
    narrow = sketches.select(
        "doc_id", "digest", F.expr("CASE WHEN shingles > 0 THEN class END").alias("class")
    )
    # Repeated rows become one row with a number before one of them is marked to stay.
    numbered = narrow.groupBy("doc_id", "digest", "class").agg(F.count("*").alias("times"))
    every = numbered.withColumn("copy", F.explode(F.expr("sequence(1L, times)")))
    return every.join(info, F.col("class") == F.col("of_class"), "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_text_links", F.lit(0)).cast("long").alias("n_text_links"),
        (alone | (stays & (F.col("copy") == 1))).alias("kept"),
        "digest",
    )


def keep_one_of_similar(docs: DataFrame, **options) -> DataFrame:
    """Rows of docs that stay, one of each class, with all their columns."""
    kept = similar_documents(docs, **options).where("kept").select("doc_id", "digest")
    text = F.md5(whole_text().cast("binary"))
    return keep_rows(docs, kept, {"doc_id": F.col("doc_id"), "digest": text})
